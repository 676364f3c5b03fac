"""Writing raw tables and reading them back, checks of tables, and views by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.relational import assert_unique_columns, expect_min_rows
from ..schemas import raw_schema
from ..session import shared_dir
from ..sources import rawlog
from ..sources.short_rates import parse_short_rates
from .registry import query

_TICKS = """
    SELECT user_id AS RequestId, ts AS Timestamp, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS TickType,
           CAST(value AS DOUBLE) AS Value FROM events
"""


def _ticks(t):
    """The events as raw rows, as a program hands them over: blanks for NULLs, decimals for numbers."""
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return t.events.select(
        F.col("user_id").alias("RequestId"), F.col("ts").alias("Timestamp"), kind.alias("TickType"), F.col("value").cast("decimal(18,6)").alias("Value")
    )


_COUNTED = """
    SELECT RequestId, TickType, count(*) AS n, round(sum(Value), 2) AS Total, TRUE AS Arrived FROM ({ticks}) GROUP BY 1, 2
"""


@query("raw_append_reread", _COUNTED.format(ticks=f"{_TICKS} UNION ALL {_TICKS}"))
def raw_append_reread(t):
    folder = shared_dir(t.spark, "raw_append")
    for _ in range(2):
        rawlog.append_raw(rawlog.with_receive_time(_ticks(t)), folder)
    rows = t.spark.read.parquet(folder)
    return rows.groupBy("RequestId", "TickType").agg(
        F.count("*").alias("n"), F.round(F.sum("Value"), 2).alias("Total"), F.bool_and(F.col("ReceiveTime").isNotNull()).alias("Arrived")
    )


@query(
    "raw_csv",
    "SELECT event_id AS RequestId, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS TickType, round(value, 4) AS Value FROM events",
)
def raw_csv(t):
    folder = shared_dir(t.spark, "raw_csv")
    columns = raw_schema("ticks_generic").names
    kind = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type"))
    given = {"RequestId": F.col("event_id"), "TickType": kind, "Value": F.col("value")}
    rows = t.events.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in columns])
    rows.write.option("header", True).csv(folder)
    return rawlog.read_raw(t.spark, "ticks_generic", folder, "csv", header=True).select("RequestId", "TickType", F.round("Value", 4).alias("Value"))


@query(
    "short_rate_files",
    """
    SELECT 'r' || r_regionkey AS Source, s_suppkey AS Supplier, s_name || ' & co' AS Name, s_acctbal AS Rate
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def short_rate_files(t):
    folder = shared_dir(t.spark, "short_rate_files")
    line = F.concat_ws("|", "s_suppkey", F.concat("s_name", F.lit(" &amp; co")), F.col("s_acctbal"), F.lit(""))
    lines = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("region"), F.struct(F.lit(1).alias("part"), line.alias("line")).alias("x"))
    fixed = [(0, "#BOF|2024.01.01"), (0, "#Supplier|Name|Rate|"), (2, "#EOF|1")]
    frame = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.lit(x).alias("line")) for p, x in fixed]))
    whole = lines.unionByName(t.region.select(F.col("r_regionkey").alias("region"), frame.alias("x")))
    # One parted write; a region's lines meet in one file, as such files come, named by what they are about.
    parts = whole.select("region", "x.*").repartition("region").sortWithinPartitions("region", "part", F.desc("line"))
    parts.select(F.concat(F.lit("r"), "region").alias("file"), "line").write.partitionBy("file").text(folder)
    lines = t.spark.read.text(folder).select(F.col("file").alias("Source"), "value")
    return parse_short_rates(lines, {"Supplier": "long", "Rate": "double"}).select("Source", "Supplier", "Name", "Rate")


@query("views_by_name", "SELECT r_name, count(*) AS Nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1")
def views_by_name(t):
    rawlog.register_views({"region": t.region, "nation": t.nation}, "named_")
    return t.spark.sql("SELECT r_name, count(*) AS Nations FROM named_region JOIN named_nation ON r_regionkey = n_regionkey GROUP BY 1")


@query(
    "column_check",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Duplicate column names: o_orderkey' END AS Clash
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def column_check(t):
    """A join whose names clash is refused, by the names that do; without the clash it passes."""
    joined = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    try:
        assert_unique_columns(joined.withColumn("again", F.col("o_orderkey")).select("*", F.col("again").alias("o_orderkey")))
        said = "nothing"
    except ValueError as error:
        said = str(error)
    rows = assert_unique_columns(joined)
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", said).alias("Clash"))


@query(
    "row_count_check",
    """
    SELECT event_type, count(*) AS Events, CASE WHEN (SELECT count(*) FROM events) < 100000000 THEN 'Table "events" has ' || (SELECT count(*) FROM events) || ' rows (expected 100000000)' END AS Refused
    FROM events GROUP BY 1
    """,
)
def row_count_check(t):
    """A table of enough rows passes, one of fewer is refused with their number."""
    try:
        expect_min_rows(t.events, "events", 100_000_000)
        said = None
    except ValueError as error:
        said = str(error)
    return expect_min_rows(t.events, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("Events")).withColumn("Refused", F.lit(said))
