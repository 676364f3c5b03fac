"""Streaming forms over the events file, run to the end of what is there, beside the batch SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators.relational import last_by
from ..plans.market import BarSize
from ..session import shared_dir
from ..streaming import streams as s
from .registry import ntz, query, r6, rounded
from .series import decay_ctes


def _events(t):
    return s.read_files(t.spark, t.sf_dir, t.events.schema, glob="events.parquet")


def _paths(t, name):
    root = shared_dir(t.spark, name)
    return f"{root}/out", f"{root}/checkpoint"


@query(
    "stream_last_by",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_last_by(t):
    path, checkpoint = _paths(t, "stream_last_by")
    s.run_to_end(s.upsert_last_rows(_events(t), "user_id", ["ts", "event_id"], path, checkpoint))
    return s.read_changes(t.spark, path, "user_id")


@query(
    "stream_ema",
    f"""WITH {decay_ctes(86400)} SELECT i.event_id, i.user_id, round(m, 6) AS PredPrice, round(d.sd, 6) AS PredSD
        FROM inno i JOIN dev d USING (event_id)""",
)
def stream_ema(t):
    path, checkpoint = _paths(t, "stream_ema")
    s.run_to_end(
        s.decay_stream(
            _events(t), "ts", timedelta(days=1), "user_id", "value", "PredPrice", "PredSD", path, f"{path}-states", checkpoint, "event_id"
        )
    )
    rows = t.spark.read.parquet(path).select("event_id", "user_id", "PredPrice", "PredSD")
    return rounded(rows, "PredPrice", "PredSD")


@query(
    "stream_bars",
    """
    SELECT user_id, time_bucket(INTERVAL 5 SECOND, ts) AS Timestamp, arg_min(value, (ts, event_id)) AS "Open", max(value) AS High,
           min(value) AS Low, arg_max(value, (ts, event_id)) AS "Close", CAST(sum(size) AS DOUBLE) AS Volume, count(*) AS BarCount,
           round(sum(value * size) / sum(size) + 1e-9, 6) AS WAP
    FROM (SELECT *, 1 + event_id % 9 AS size FROM events) GROUP BY 1, 2
    """,
)
def stream_bars(t):
    path, checkpoint = _paths(t, "stream_bars")
    ticks = _events(t).withColumn("size", 1 + F.col("event_id") % 9)
    bars = s.bars_stream(ticks, BarSize.SEC_5, "user_id", "ts", "event_id", "value", "size")
    s.run_to_end(s.start(bars, checkpoint, s.write_changes(path), "update"))
    rows = s.read_changes(t.spark, path, ["user_id", "Timestamp"])
    return rows.withColumns({"Timestamp": ntz("Timestamp"), "WAP": r6(F.col("WAP") + 1e-9)})


@query(
    "stream_enrich",
    "SELECT e.event_id, e.user_id, e.value, c_name, c_mktsegment FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON user_id = c_custkey",
)
def stream_enrich(t):
    path, checkpoint = _paths(t, "stream_enrich")

    def dimension():
        return t.customer.filter("c_mktsegment <> 'BUILDING'").withColumnRenamed("c_custkey", "user_id")

    rows = _events(t).select("event_id", "user_id", "value")
    s.run_to_end(s.enrich_stream(rows, dimension, "user_id", ["c_name", "c_mktsegment"], path, checkpoint))
    return t.spark.read.parquet(path).drop(s.BATCH)


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(t):
    path, checkpoint = _paths(t, "stream_first_seen")
    keys = s.first_seen(_events(t).select("user_id", "event_type"), ["user_id", "event_type"])
    s.run_to_end(s.start(keys, checkpoint, s.write_changes(path)))
    return t.spark.read.parquet(path).drop(s.BATCH)


@query(
    "stream_snapshot",
    """
    SELECT event_id, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_snapshot(t):
    path, checkpoint = _paths(t, "stream_snapshot")
    keys = ["user_id", "event_type"]
    s.run_to_end(s.snapshot_periodically(_events(t), keys, ["ts", "event_id"], path, checkpoint, None))
    return last_by(t.spark.read.parquet(path), keys, s.BATCH).select("event_id", *keys, "value")


@query("stream_raw_append", "SELECT event_id, user_id, value FROM events")
def stream_raw_append(t):
    path, checkpoint = _paths(t, "stream_raw_append")
    for q in s.tables_to_append({"ticks": _events(t).select("event_id", "user_id", "value")}, path, checkpoint):
        s.run_to_end(q)
    return t.spark.read.parquet(f"{path}/ticks")
