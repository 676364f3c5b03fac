"""Row-order, time-decayed and snapshot operators on the events table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..operators.decay import decay_stats, ema_time, emstd_time
from ..operators.ordered import changed_only, returns
from ..operators.snapshot import TimeGrid, snapshot_when
from ..plans.market import BarSize, bars_from_ticks
from ..plans.market_making import after_burn_in, predictions, with_first_time
from .registry import ntz, query, rounded

DAY = timedelta(days=1)


@query(
    "previous_row_return",
    """
    SELECT event_id, user_id, value, p AS "Last", round(value - p, 6) AS Chg, round((value - p) / nullif(p, 0), 6) AS "Return"
    FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    """,
)
def previous_row_return(t):
    rows = returns(t.events, "value", "user_id", "ts", "event_id")
    return rounded(rows.select("event_id", "user_id", "value", "Last", "Chg", "Return"), "Chg", "Return")


@query(
    "quote_change_only",
    """
    SELECT event_id, ts, user_id, event_type FROM (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    WHERE p IS NULL OR p <> event_type
    """,
)
def quote_change_only(t):
    rows = t.events.select("event_id", "ts", "user_id", "event_type")
    return changed_only(rows, "event_type", "user_id", "ts", "event_id")


def decay_ctes(tau_seconds: int, key: str = "user_id", source: str = "SELECT * FROM events", x: str = "value") -> str:
    """The recurrences as weighted self-joins: ``mean`` then ``dev`` per row."""
    tau = f"{tau_seconds}e6"
    return f"""
    src AS ({source}),
    o AS (SELECT *, epoch_us(ts) AS us, row_number() OVER w AS rn,
                 epoch_us(ts) - lag(epoch_us(ts)) OVER w AS dt FROM src
          WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
    wt AS (SELECT *, coalesce(1 - exp(-dt / {tau}), 1.0) AS w FROM o),
    mean AS (SELECT a.event_id, any_value(a.{key}) AS {key}, any_value(a.us) AS us, any_value(a.rn) AS rn,
                    any_value(a.dt) AS dt, any_value(a.w) AS w, any_value(a.{x}) AS x,
                    sum(b.w * b.{x} * exp(-(a.us - b.us) / {tau})) AS m
             FROM wt a JOIN wt b ON a.{key} = b.{key} AND b.rn <= a.rn GROUP BY a.event_id),
    inno AS (SELECT *, CASE WHEN rn = 1 THEN 0.0 ELSE exp(-dt / {tau}) * w *
                    (x - lag(m) OVER (PARTITION BY {key} ORDER BY rn)) ** 2 END AS u FROM mean),
    dev AS (SELECT a.event_id, CASE WHEN any_value(a.rn) > 1 THEN
                   sqrt(sum(b.u * exp(-(a.us - b.us) / {tau}))) END AS sd
            FROM inno a JOIN inno b ON a.{key} = b.{key} AND b.rn <= a.rn GROUP BY a.event_id)
    """


@query(
    "ema_time",
    f"WITH {decay_ctes(86400)} SELECT event_id, user_id, round(m, 6) AS PredPrice FROM mean",
)
def ema(t):
    out = ema_time(t.events, "ts", DAY, {"PredPrice": "value"}, "user_id", "event_id")
    return rounded(out.select("event_id", "user_id", "PredPrice"), "PredPrice")


@query(
    "emstd_time",
    f"WITH {decay_ctes(86400)} SELECT i.event_id, i.user_id, round(d.sd, 6) AS PredSD FROM inno i JOIN dev d USING (event_id)",
)
def emstd(t):
    out = emstd_time(t.events, "ts", DAY, {"PredSD": "value"}, "user_id", "event_id")
    return rounded(out.select("event_id", "user_id", "PredSD"), "PredSD")


@query(
    "ema_time_short",
    f"""WITH {decay_ctes(120)} SELECT i.event_id, i.user_id, round(m, 6) AS PredPrice, round(d.sd, 6) AS PredSD
        FROM inno i JOIN dev d USING (event_id)""",
)
def ema_short(t):
    out = decay_stats(
        t.events, "ts", timedelta(minutes=2), "user_id", {"PredPrice": "value"}, {"PredSD": "value"}, "event_id"
    )
    return rounded(out.select("event_id", "user_id", "PredPrice", "PredSD"), "PredPrice", "PredSD")


_BANDS = """
    SELECT e.event_id, e.user_id, e.ts, round(i.m, 6) AS PredPrice, round(d.sd, 6) AS PredSD,
           round(i.m - d.sd, 6) AS PredLow, round(i.m + d.sd, 6) AS PredHigh
    FROM events e JOIN inno i USING (event_id) JOIN dev d USING (event_id)
"""


def _bands(t):
    out = predictions(t.events, DAY, "user_id", "ts", "event_id", "value")
    return out.select("event_id", "user_id", "ts", "PredPrice", "PredSD", "PredLow", "PredHigh")


@query("prediction_bands", f"WITH {decay_ctes(86400)} {_BANDS}")
def prediction_bands(t):
    return rounded(_bands(t), "PredPrice", "PredSD", "PredLow", "PredHigh")


@query(
    "burn_in",
    f"""WITH {decay_ctes(86400)}, bands AS ({_BANDS}),
        f AS (SELECT user_id, min(ts) AS TimestampFirst FROM events GROUP BY 1)
        SELECT bands.*, TimestampFirst FROM bands JOIN f USING (user_id) WHERE ts > TimestampFirst + INTERVAL 1 DAY""",
)
def burn_in(t):
    # The first times come from the events themselves, not from the (far longer) band plan.
    rows = after_burn_in(with_first_time(_bands(t), t.events, "user_id", "ts"), DAY, "ts")
    return rounded(rows, "PredPrice", "PredSD", "PredLow", "PredHigh")


TICKS = """
    SELECT unnest(range(date_trunc('day', low)::TIMESTAMP + INTERVAL 1 DAY, date_trunc('day', high)::TIMESTAMP + INTERVAL 25 HOUR, INTERVAL 1 DAY)) AS SnapTime
    FROM (SELECT min(ts) AS low, max(ts) AS high FROM events)
"""


def grid(t) -> TimeGrid:
    """Midnights from the one after the first event to the one after the last: two numbers of the table. Without events, one of a day of no event."""
    low, high = t.events.agg(F.min("ts"), F.max("ts")).first()
    low, high = low or datetime(1970, 1, 1), high or datetime(1970, 1, 1)
    midnight = {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}
    return TimeGrid(low.replace(**midnight) + DAY, high.replace(**midnight) + DAY, DAY)


@query("time_grid", TICKS)
def time_grid(t):
    return grid(t).frame(t.spark, "SnapTime").select(ntz("SnapTime").alias("SnapTime"))


_SNAP = f"""
    WITH g AS ({TICKS}), u AS (SELECT DISTINCT user_id FROM events), gu AS (SELECT * FROM g, u)
    SELECT gu.SnapTime, gu.user_id, e.event_id, e.ts, e.value
    FROM gu ASOF JOIN events e ON gu.user_id = e.user_id AND gu.SnapTime >= e.ts
"""


@query("snapshot_when", _SNAP)
def snapshot_history(t):
    rows = t.events.select("event_id", "ts", "user_id", "value")
    out = snapshot_when(rows, grid(t), "user_id", "ts", "event_id", history=True)
    return out.withColumn("SnapTime", ntz("SnapTime"))


@query("snapshot_newest", f"{_SNAP} WHERE gu.SnapTime = (SELECT max(SnapTime) FROM g)")
def snapshot_newest(t):
    rows = t.events.select("event_id", "ts", "user_id", "value")
    return snapshot_when(rows, grid(t), "user_id", "ts", "event_id").withColumn("SnapTime", ntz("SnapTime"))


@query(
    "bars_by_previous_close",
    """
    WITH d AS (SELECT user_id, date_trunc('day', ts) AS day, arg_max(value, (ts, event_id)) AS c FROM events GROUP BY 1, 2)
    SELECT user_id, day, c AS "Close", lag(c) OVER (PARTITION BY user_id ORDER BY day) AS "Last" FROM d
    """,
)
def bars_by_previous_close(t):
    bars = bars_from_ticks(t.events, BarSize.DAY_1, "user_id", "ts", "event_id", "value", None)
    out = returns(bars.select("user_id", "Timestamp", "Close"), "Close", "user_id", "Timestamp", split_rows=None)
    return out.select("user_id", ntz("Timestamp").alias("day"), "Close", "Last")

