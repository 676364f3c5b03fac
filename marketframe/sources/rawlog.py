"""Raw tables: typed, append-only logs with an arrival time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import blank_to_null, decimals_to_double
from ..operators.relational import assert_unique_columns
from ..schemas import raw_schema
from .messages import normalize_message

RAW_PREFIX = "raw_"


def with_receive_time(df: DataFrame) -> DataFrame:
    """ReceiveTime first. Rows of one batch share it; ``Seq``, where given, orders them."""
    return assert_unique_columns(df.select(F.current_timestamp().alias("ReceiveTime"), "*"))


def normalize_rows(df: DataFrame) -> DataFrame:
    """Decimals to doubles and empty strings to NULL, as every raw row is written."""
    return blank_to_null(decimals_to_double(assert_unique_columns(df)))


def read_raw(
    spark: SparkSession, table: str, path: str, format: str = "parquet", stream: bool = False, **options
) -> DataFrame:
    """A raw table from files (parquet, CSV, JSON) or any other source, with its declared schema."""
    reader = (spark.readStream if stream else spark.read).format(format).schema(raw_schema(table))
    return normalize_rows(reader.options(**options).load(path))


def append_raw(df: DataFrame, path: str, table: str | None = None) -> None:
    """Append rows to a raw table's folder; with the table's name, messages by its rules."""
    rows = normalize_message(table, df) if table else normalize_rows(df)
    rows.write.mode("append").parquet(path)


BAD, REASONS = "__bad", "__reasons"


def append_audited(df: DataFrame, path: str, expected: Mapping[str, str]) -> dict[str, int]:
    """Append rows and audit them in the same pass: the number of values per column that don't fit.

    ``expected`` names columns and their types. Rows whose values all fit are appended with these types;
    rows with a value that doesn't are moved aside as they came, with the columns at fault in
    ``__reasons``. Both parts lie under ``path`` and are read by :func:`read_audited`. For micro-batches
    call it on each batch.
    """
    misfits = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in expected.items()}
    reasons = F.filter(F.array(*[F.when(bad, F.lit(c)) for c, bad in misfits.items()]), lambda r: r.isNotNull())
    rows = df.withColumn(REASONS, reasons).withColumn(BAD, F.size(REASONS) > 0)
    audit = Observation()
    # Values go out as they came, so that both parts fit one table; a good part's values are known to cast.
    audited = rows.observe(audit, F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.array_contains(REASONS, c)).alias(c) for c in expected])
    audited.write.mode("append").partitionBy(BAD).parquet(path)
    found = audit.get
    return {c: found.get(c, 0) for c in expected}


def read_audited(spark: SparkSession, path: str, expected: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, with their types, and the rows that don't, as they came with ``__reasons``."""
    rows = spark.read.parquet(path)
    bad = F.col(BAD) == "true"
    good = rows.filter(~bad).drop(BAD, REASONS)
    return good.withColumns({c: F.col(c).cast(t) for c, t in expected.items()}), rows.filter(bad).drop(BAD)


def read_kafka(spark: SparkSession, table: str, servers: str, topic: str, **options) -> DataFrame:
    """A raw table as a stream of JSON messages. The message offset serves as arrival number."""
    schema = raw_schema(table, seq=False)
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return parse_messages(messages, schema, table)


def parse_messages(messages: DataFrame, schema, table: str | None = None) -> DataFrame:
    """Rows from messages with ``value`` (JSON), ``timestamp`` and ``offset``; by the table's rules, if named."""
    row = F.from_json(F.col("value").cast("string"), schema).alias("row")
    rows = messages.select(row, "timestamp", "offset").select(
        "row.*", F.col("timestamp").alias("__at"), F.col("offset").alias("Seq")
    )
    arrived = rows.withColumn("ReceiveTime", F.coalesce("ReceiveTime", "__at")).drop("__at")
    return normalize_message(table, arrived) if table else normalize_rows(arrived)


def unify_ticks(live: DataFrame, historical: DataFrame, renames: Mapping[str, str] | None = None):
    """Live and historical ticks of one kind in the same columns."""
    return live.unionByName(historical.withColumnsRenamed(dict(renames or {})), allowMissingColumns=True)


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Publish tables by name as temporary views, for use from SQL."""
    for name in sorted(tables):
        tables[name].createOrReplaceTempView(f"{prefix}{name}")
