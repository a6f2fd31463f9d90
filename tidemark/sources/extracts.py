"""CSV extracts with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.temporal import day_text
from tidemark.schemas import ShopTable


def read_extract(spark: SparkSession, path: str, table: ShopTable) -> DataFrame:
    """The extract as text columns, taken by name from the header.

    ``enforceSchema=false`` makes Spark check the header against the schema, so a
    file with other columns fails instead of being read shifted.
    """
    return (
        spark.read.schema(table.text_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def rows_of_day(extract: DataFrame, day: str, column: str = "updated_at") -> DataFrame:
    """Rows whose text timestamp starts with ``day`` (``yyyy-MM-dd``)."""
    return extract.where(day_text(F.col(column)) == day)


def typed(extract: DataFrame, table: ShopTable) -> DataFrame:
    """Cast text straight to the declared types; money never passes through a float."""
    return extract.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema)
    )
