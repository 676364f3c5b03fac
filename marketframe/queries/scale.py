"""The paths that hot keys and odd rows take: forced blocks, NULL times and parts, late rows, several micro-batches."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators.decay import decay_stats, ema_time, emstd_time, last_states
from ..operators.ordered import changed_only, with_previous, with_row_ids
from ..plans.market import BarSize, bars_from_ticks
from ..streaming import streams as s
from .batches import run_in_batches
from .registry import ntz, query, r6, rounded
from .series import decay_ctes

DAY = timedelta(days=1)
#: Rows per block: the hot key, with half of all rows, is cut at every scale.
ROWS = 200

_HOT = "SELECT event_id, ts, CASE WHEN event_id % 2 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value FROM events"


def _hot(t):
    return t.events.selectExpr("event_id", "ts", "CASE WHEN event_id % 2 = 0 THEN 1 ELSE user_id END AS user_id", "event_type", "value")


@query("ema_time_blocked", f"WITH {decay_ctes(86400, source=_HOT)} SELECT event_id, user_id, round(m, 6) AS PredPrice FROM mean")
def ema_time_blocked(t):
    out = ema_time(_hot(t), "ts", DAY, {"PredPrice": "value"}, "user_id", "event_id", split_rows=ROWS)
    return rounded(out.select("event_id", "user_id", "PredPrice"), "PredPrice")


@query(
    "emstd_time_blocked",
    f"WITH {decay_ctes(86400, source=_HOT)} SELECT i.event_id, i.user_id, round(d.sd, 6) AS PredSD FROM inno i JOIN dev d USING (event_id)",
)
def emstd_time_blocked(t):
    out = emstd_time(_hot(t), "ts", DAY, {"PredSD": "value"}, "user_id", "event_id", split_rows=ROWS)
    return rounded(out.select("event_id", "user_id", "PredSD"), "PredSD")


_PREVIOUS = """
    SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) AS Previous FROM ({source})
"""


@query("previous_row_blocked", _PREVIOUS.format(source=_HOT))
def previous_row_blocked(t):
    return with_previous(_hot(t), {"Previous": "value"}, "user_id", "ts", "event_id", split_rows=ROWS).select("event_id", "Previous")


_NULL_TIMES = _HOT.replace("event_id, ts,", "event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts,")


@query("previous_row_null_time", _PREVIOUS.format(source=_NULL_TIMES))
def previous_row_null_time(t):
    rows = _hot(t).withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    return with_previous(rows, {"Previous": "value"}, "user_id", "ts", "event_id", split_rows=ROWS).select("event_id", "Previous")


@query(
    "quote_change_blocked",
    f"""
    SELECT event_id, user_id, event_type FROM (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM ({_HOT})) WHERE p IS NULL OR p <> event_type
    """,
)
def quote_change_blocked(t):
    rows = changed_only(_hot(t), "event_type", "user_id", "ts", "event_id", split_rows=ROWS)
    return rows.select("event_id", "user_id", "event_type")


@query("row_ids_blocked", "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS RequestId FROM events")
def row_ids_blocked(t):
    return with_row_ids(t.events, ["ts", "event_id"], F.date_trunc("month", "ts"), "ts", split_rows=ROWS).select("event_id", "RequestId")


@query(
    "row_ids_null_bucket",
    """
    SELECT event_id, CAST(row_number() OVER (ORDER BY ts NULLS FIRST, event_id) AS BIGINT) AS RequestId
    FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events)
    """,
)
def row_ids_null_bucket(t):
    rows = t.events.select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"))
    return with_row_ids(rows, ["ts", "event_id"], F.date_trunc("day", "ts"), "ts", split_rows=ROWS).select("event_id", "RequestId")


# Every fifth row comes after all others of its key: it counts as of their last time then, in time order.
_LATE = """
    SELECT user_id, value, CASE WHEN event_id % 5 = 0 THEN greatest(ts, coalesce(last_ts, ts)) ELSE ts END AS ts,
           CASE WHEN event_id % 5 = 0 THEN row_number() OVER (ORDER BY ts, event_id) + 1000000000 ELSE event_id END AS event_id, event_id AS id
    FROM events LEFT JOIN (SELECT user_id, max(ts) AS last_ts FROM events WHERE event_id % 5 <> 0 GROUP BY 1) USING (user_id)
"""


@query(
    "stream_ema_late_rows",
    f"""WITH {decay_ctes(86400, source=_LATE)} SELECT src.id AS event_id, round(m, 6) AS PredPrice
        FROM mean JOIN src USING (event_id) WHERE event_id >= 1000000000""",
)
def stream_ema_late_rows(t):
    def stats(rows, initial=None):
        return decay_stats(rows, "ts", DAY, "user_id", {"PredPrice": "value"}, {}, ["__time", "event_id"], initial=initial, split_rows=ROWS)

    rows = t.events.select("event_id", "ts", "user_id", "value", F.col("ts").alias("__time"))
    before = last_states(stats(rows.filter("event_id % 5 <> 0")), "user_id", "ts", {"value": ("PredPrice", None)}, "event_id")
    late = stats(rows.filter("event_id % 5 = 0"), before)
    return rounded(late.select("event_id", "PredPrice"), "PredPrice")


@query(
    "ohlc_bars_null_price",
    """
    SELECT user_id, date_trunc('day', ts) AS Timestamp, arg_min(value, (ts, seq)) AS "Open", max(value) AS High, min(value) AS Low,
           arg_max(value, (ts, seq)) AS "Close", CAST(sum(size) AS DOUBLE) AS Volume, count(*) AS BarCount, round(sum(value * size) / sum(size) + 1e-9, 6) AS WAP
    FROM (SELECT *, 1 + event_id % 9 AS size, CASE WHEN event_id % 6 <> 0 THEN event_id ELSE 0 END AS seq FROM events WHERE event_id % 4 <> 0)
    GROUP BY 1, 2
    """,
)
def ohlc_bars_null_price(t):
    rows = t.events.select(
        "user_id",
        "ts",
        F.when(F.col("event_id") % 6 != 0, F.col("event_id")).alias("Seq"),
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("Price"),
        (1 + F.col("event_id") % 9).alias("Size"),
    )
    bars = bars_from_ticks(rows, BarSize.DAY_1, "user_id", "ts")
    return bars.withColumns({"Timestamp": ntz("Timestamp"), "WAP": r6(F.col("WAP") + 1e-9)})


@query(
    "stream_ema_batches",
    f"""WITH {decay_ctes(86400)} SELECT i.event_id, i.user_id, round(m, 6) AS PredPrice, round(d.sd, 6) AS PredSD
        FROM inno i JOIN dev d USING (event_id)""",
)
def stream_ema_batches(t):
    def run(stream, out, checkpoint):
        return s.decay_stream(stream, "ts", DAY, "user_id", "value", "PredPrice", "PredSD", out, f"{out}-states", checkpoint, "event_id")

    folder = run_in_batches(t, "stream_ema_batches", run)
    return rounded(t.spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "PredPrice", "PredSD"), "PredPrice", "PredSD")


@query(
    "stream_last_by_batches",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def stream_last_by_batches(t):
    def run(stream, out, checkpoint):
        return s.upsert_last_rows(stream, "user_id", ["ts", "event_id"], out, checkpoint)

    out = run_in_batches(t, "stream_last_by_batches", run) + "/out"
    s.compact_changes(t.spark, out, f"{out}-compact", "user_id")
    return s.read_changes(t.spark, f"{out}-compact", "user_id")


@query(
    "stream_bars_watermark",
    """
    SELECT user_id, time_bucket(INTERVAL 1 MINUTE, ts) AS Timestamp, arg_min(value, (ts, event_id)) AS "Open", max(value) AS High, min(value) AS Low,
           arg_max(value, (ts, event_id)) AS "Close", CAST(sum(1 + event_id % 9) AS DOUBLE) AS Volume, count(*) AS BarCount
    FROM events GROUP BY 1, 2
    """,
)
def stream_bars_watermark(t):
    """Updates replace their bar. State is kept for one day of event time only: rows that come later than that, of which there are none here, are left out."""
    rows = t.events.withColumn("size", 1 + F.col("event_id") % 9)

    def run(stream, out, checkpoint):
        bars = s.bars_stream(stream, BarSize.MIN_1, "user_id", "ts", "event_id", "value", "size", watermark="1 day")
        return s.start(bars, checkpoint, s.write_changes(out), "update")

    out = run_in_batches(t, "stream_bars_watermark", run, rows) + "/out"
    return s.read_changes(t.spark, out, ["user_id", "Timestamp"]).drop("WAP").withColumn("Timestamp", ntz("Timestamp"))
