"""Writers of parquet tables. Every write can be repeated without changing the result."""
