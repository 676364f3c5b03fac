"""Time columns on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as n
from ..functions import timefmt as tf
from ..plans.market import in_duration
from .registry import ntz, query, r6
from datetime import datetime


@query(
    "yield_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS YieldRedemptionDate
    FROM orders
    """,
)
def yield_date(t):
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    number = F.when(F.col("o_orderkey") % 10 == 0, F.lit(0)).otherwise(number)
    return t.orders.select("o_orderkey", n.yield_date(number).alias("YieldRedemptionDate"))


@query(
    "bar_date",
    """
    SELECT o_orderkey, CAST(timezone('UTC', CASE WHEN o_orderkey % 2 = 0
        THEN timezone('US/Eastern', o_orderdate + INTERVAL '23:59:59' HOUR TO SECOND)
        ELSE timezone('UTC', o_orderdate + INTERVAL 9 HOUR) END) AS TIMESTAMP) AS Timestamp
    FROM orders
    """.replace("INTERVAL '23:59:59' HOUR TO SECOND", "INTERVAL 86399 SECOND"),
)
def bar_date(t):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    seconds = F.unix_seconds((F.col("o_orderdate") + F.expr("INTERVAL 9 HOURS")).cast("timestamp")).cast("string")
    text = F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(seconds)
    return t.orders.select("o_orderkey", ntz(tf.parse_bar_date(text)).alias("Timestamp"))


@query(
    "unix_time",
    """
    SELECT event_id, date_trunc('second', ts) AS Timestamp, date_trunc('second', ts) + INTERVAL 5 SECOND AS TimestampEnd
    FROM events
    """,
)
def unix_time(t):
    start = tf.unix_seconds_to_instant(F.unix_seconds(F.col("ts").cast("timestamp")))
    end = tf.bar_end(start, F.lit(5))
    return t.events.select("event_id", ntz(start).alias("Timestamp"), ntz(end).alias("TimestampEnd"))


_LOCAL = "(o_orderdate + to_seconds(9 * 3600 + o_orderkey % 3600))"


@query(
    "broker_time_parse",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 4 THEN NULL
      WHEN o_orderkey % 6 IN (1, 3) THEN CAST(timezone('UTC', timezone('US/Eastern', {_LOCAL})) + INTERVAL 250 MILLISECOND AS TIMESTAMP)
      ELSE CAST(timezone('UTC', timezone('US/Eastern', {_LOCAL})) AS TIMESTAMP) END AS Timestamp
    FROM orders
    """,
)
def broker_time_parse(t):
    local = F.col("o_orderdate") + F.make_dt_interval(secs=(F.lit(9 * 3600) + F.col("o_orderkey") % 3600).cast("decimal(18,6)"))
    plain = F.date_format(local, "yyyyMMdd HH:mm:ss")
    dashed = F.date_format(local, "yyyy-MM-dd HH:mm:ss")
    kind = F.col("o_orderkey") % 6
    text = (
        F.when(kind == 0, plain)
        .when(kind == 1, F.concat(plain, F.lit(".25")))
        .when(kind == 2, dashed)
        .when(kind == 3, F.concat(dashed, F.lit(".250")))
        .when(kind == 4, F.lit("not a time"))
        .otherwise(F.concat(plain, F.lit(" US/Eastern")))
    )
    return t.orders.select("o_orderkey", ntz(tf.parse_feed_time(text)).alias("Timestamp"))


@query(
    "broker_time_format",
    """
    SELECT event_id,
           CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(timezone('US/Eastern', timezone('UTC', ts)), '%Y%m%d %H:%M:%S.%g') || ' US/Eastern' END AS SubSec,
           CASE WHEN event_id % 7 = 0 THEN '' ELSE strftime(timezone('US/Eastern', timezone('UTC', ts)), '%Y%m%d %H:%M:%S') || ' US/Eastern' END AS Sec
    FROM events
    """,
)
def broker_time_format(t):
    at = F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id", tf.format_feed_time(at).alias("SubSec"), tf.format_feed_time(at, sub_sec=False).alias("Sec")
    )


@query(
    "expiry_time",
    """
    SELECT o_orderkey, CAST(timezone('UTC', timezone('US/Eastern', o_orderdate + INTERVAL 14 HOUR)) AS TIMESTAMP) AS ExpiryTime,
           round((epoch_us(timezone('UTC', timezone('US/Eastern', o_orderdate + INTERVAL 14 HOUR))) - epoch_us(TIMESTAMP '2000-01-01')) / (365.0 * 86400 * 1000000), 6) AS T
    FROM orders
    """,
)
def expiry_time(t):
    expiry = tf.expiry_instant(F.date_format("o_orderdate", "yyyyMMdd"))
    years = tf.years_365(F.lit(datetime(2000, 1, 1)), expiry)
    return t.orders.select("o_orderkey", ntz(expiry).alias("ExpiryTime"), r6(years).alias("T"))


@query(
    "duration_range",
    """
    SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-28 12:00:00'
    """,
)
def duration_range(t):
    return in_duration(t.events, "ts", "7 D", datetime(2024, 1, 28, 12))


@query(
    "duration_range_months",
    """
    SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-05-31' - INTERVAL 3 MONTH AND o_orderdate <= TIMESTAMP '2000-05-31'
    """,
)
def duration_range_months(t):
    return in_duration(t.orders, "o_orderdate", "3 M", datetime(2000, 5, 31))
