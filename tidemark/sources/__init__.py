"""Readers: change feeds, extract files, stored tables and literal rows."""
