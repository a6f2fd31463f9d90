"""Change feeds: one record per row change, in the columns of ``FEED_RECORD``.

A broker subscription and a folder of files give the same columns, so everything
after the read is shared. ``decode_*`` turns records into change rows:

    op          c (insert), u (update), r (snapshot read) or d (delete)
    row_key     the row's key, present for deletes too
    after       struct with the row's new image, NULL for deletes
    raw         the record's text where it is no JSON or a value does not fit its column
    event_ts    record timestamp
    partition, offset   position in the feed, orders changes of one key
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.schemas import FEED_RECORD, METRICS_RECORD, ShopTable

# Fixed value: a registry-framed message starts with one marker byte and a
# four-byte schema id.
_HEADER_BYTES = 5

_CORRUPT = "_corrupt"


def topic_of(table: str) -> str:
    return ".".join((settings.CAPTURE_SERVER, settings.CAPTURE_DATABASE, table))


def broker_options(servers: str, topics: Iterable[str]) -> dict[str, str]:
    """Read the topics from the start; later progress lives in the checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }


def broker_feed(
    spark: SparkSession,
    servers: str,
    tables: Iterable[str] = settings.CAPTURE_TABLES,
    *,
    stream: bool = True,
    **options: str,
) -> DataFrame:
    """Subscribe to the change topics of ``tables`` (needs the Kafka connector)."""
    return _subscribed(spark, servers, [topic_of(t) for t in tables], stream, options)


def broker_metrics_feed(
    spark: SparkSession, servers: str, *, stream: bool = True, **options: str
) -> DataFrame:
    """Subscribe to the metrics topic (needs the Kafka connector)."""
    return _subscribed(spark, servers, [settings.METRICS_TOPIC], stream, options)


def _subscribed(
    spark: SparkSession, servers: str, topics: list[str], stream: bool, options: dict[str, str]
) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).format("kafka")
    feed = reader.options(**broker_options(servers, topics), **options).load()
    return feed.select(*FEED_RECORD.fieldNames())


def file_feed(
    spark: SparkSession, path: str, *, stream: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    """A feed landed as parquet files."""
    if not stream:
        return spark.read.schema(FEED_RECORD).parquet(path)
    reader = spark.readStream.schema(FEED_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def select_tables(feed: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Keep the records of the listed tables."""
    return feed.where(F.col("topic").isin([topic_of(t) for t in tables]))


def strip_header(message: Column) -> Column:
    """The payload of a registry-framed binary message."""
    return F.substring(message, _HEADER_BYTES + 1, 2**31 - 1)


def schema_id(message: Column) -> Column:
    """The registry's schema id in a framed binary message."""
    return F.conv(F.hex(F.substring(message, 2, _HEADER_BYTES - 1)), 16, 10).cast("int")


def envelope_schema(table: ShopTable) -> T.StructType:
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("after", table.wire_schema),
        T.StructField(_CORRUPT, T.StringType()),
    ])


def _change_rows(
    records: DataFrame, table: ShopTable, value: Column, key: Column, raw: str | None = None
) -> DataFrame:
    # What is asked of the envelope later must not be pushed below this step, where every mention
    # of the envelope would parse the record again. Nothing is pushed through a generator.
    parsed = records.where(F.col("topic") == topic_of(table.name)).select(
        F.explode(F.array(value)).alias("envelope"), F.col("key"),
        F.col("value").isNull().alias("tombstone"),
        F.col("timestamp").alias("event_ts"), "partition", "offset",
    )
    text = F.col(f"envelope.{raw}") if raw else F.lit(None).cast("string")
    # A NULL value is a delete marker; an image without an op replaces the row; a record
    # that cannot be read in full does nothing.
    op = F.when(F.col("tombstone"), "d").when(text.isNull(),
        F.coalesce(F.col("envelope.op"), F.when(F.col("envelope.after").isNotNull(), "u"))
    )
    # The record key is parsed only where there is no image to take the key from.
    row_key = F.coalesce(F.col(f"envelope.after.{table.key}"), key.getField(table.key))
    return parsed.select(
        op.alias("op"), row_key.alias("row_key"), F.col("envelope.after").alias("after"),
        text.alias("raw"), "event_ts", "partition", "offset",
    )


def decode_json(feed: DataFrame, table: ShopTable) -> DataFrame:
    """Change rows of ``table`` from JSON envelopes."""
    key_schema = T.StructType([T.StructField(table.key, T.StringType())])
    return _change_rows(
        feed, table,
        F.from_json(
            F.col("value").cast("string"), envelope_schema(table),
            {"columnNameOfCorruptRecord": _CORRUPT}),
        F.from_json(F.col("key").cast("string"), key_schema),
        raw=_CORRUPT,
    )


def decode_avro(
    feed: DataFrame, table: ShopTable, value_schemas: str | Mapping[int, str],
    key_schemas: str | Mapping[int, str], decode: Callable[[Column, str], Column] | None = None,
) -> DataFrame:
    """Change rows of ``table`` from registry-framed Avro (needs the Avro module).

    The writer schemas are passed in as text, by their id in the registry: a job reads them from
    there once, not per record. One text alone stands for all ids. Each record is read by the
    schema it was written with, so that a table's older and newer records can lie in one feed;
    columns that a schema lacks are NULL. Records of an id that is not listed are left to
    ``unknown_schemas``.
    """
    if decode is None:
        from pyspark.sql.avro.functions import from_avro as decode

    def read(part: DataFrame, value_schema: str, key_schema: str) -> DataFrame:
        rows = _change_rows(
            part, table, decode(strip_header(F.col("value")), value_schema),
            decode(strip_header(F.col("key")), key_schema))
        return _conformed(rows, table)

    found = []
    for key_id, key_schema in _by_id(key_schemas):
        keyed = feed.where(_written_with("key", key_id))
        for value_id, value_schema in _by_id(value_schemas):
            found.append(read(keyed.where(_written_with("value", value_id)), value_schema, key_schema))
        if not isinstance(value_schemas, str):
            # Deletions have no value, and no schema but that of their key.
            found.append(read(keyed.where("value IS NULL"), value_schema, key_schema))
    return reduce(DataFrame.unionByName, found)


def _by_id(schemas: str | Mapping[int, str]) -> Iterable[tuple[int | None, str]]:
    return [(None, schemas)] if isinstance(schemas, str) else list(schemas.items())


def _written_with(column: str, number: int | None) -> Column:
    return F.lit(True) if number is None else schema_id(F.col(column)) == number


def _conformed(rows: DataFrame, table: ShopTable) -> DataFrame:
    """The rows with an image of all columns of the table, in its types on the wire."""
    held = rows.schema["after"].dataType.fieldNames()
    image = F.struct(*(
        (F.col(f"after.{f.name}") if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.wire_schema))
    return rows.withColumn("after", F.when(F.col("after").isNotNull(), image))


def unknown_schemas(feed: DataFrame, table: ShopTable, known: Iterable[int]) -> DataFrame:
    """The table's records written with a value schema that is not listed, to be set aside."""
    return feed.where(F.col("topic") == topic_of(table.name)).where(
        ~schema_id(F.col("value")).isin(list(known)))


def decode_metrics(feed: DataFrame) -> DataFrame:
    """Rows of the metrics topic; withdrawn keys have none."""
    records = feed.where(F.col("topic") == settings.METRICS_TOPIC).where("value IS NOT NULL")
    return records.select(
        F.from_json(F.col("value").cast("string"), METRICS_RECORD).alias("m")
    ).select("m.*")


def decode_metrics_changes(feed: DataFrame) -> DataFrame:
    """Records of the metrics topic with their place in it; withdrawn keys have NULL measures."""
    columns = METRICS_RECORD.fieldNames()[1:]
    value = F.from_json(F.col("value").cast("string"), METRICS_RECORD)
    return feed.where(F.col("topic") == settings.METRICS_TOPIC).select(
        F.from_json(F.col("key").cast("string"), METRICS_RECORD)["ts"].alias("ts"),
        value.alias("m"), "timestamp", "offset",
    ).select("ts", *(f"m.{c}" for c in columns), "timestamp", "offset")


def encode_metrics(metrics: DataFrame) -> DataFrame:
    """Key and value of metrics-topic records, one per timestamp or day.

    A day is keyed by its first instant. A row without measures was withdrawn: its value is
    NULL, which removes the key downstream.
    """
    if "ts" not in metrics.columns:
        metrics = metrics.withColumn("ts", F.col("sale_date").cast("timestamp"))
    columns = METRICS_RECORD.fieldNames()
    return metrics.select(
        F.lit(settings.METRICS_TOPIC).alias("topic"),
        F.to_json(F.struct("ts")).alias("key"),
        F.when(F.col("total_orders").isNotNull(), F.to_json(F.struct(*columns))).alias("value"),
    )
