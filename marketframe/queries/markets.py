"""Bars, tick history, news, search and account requests on the driver's tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..functions.normalize import lenient_double
from ..operators.relational import last_by
from ..plans import market as m
from .registry import ntz, query, r6, rounded

_BARS = """
    SELECT user_id, {bucket} AS Timestamp, arg_min(value, (ts, event_id)) AS "Open", max(value) AS High, min(value) AS Low,
           arg_max(value, (ts, event_id)) AS "Close", CAST(sum(size) AS DOUBLE) AS Volume, count(*) AS BarCount,
           round(sum(value * size) / sum(size) + 1e-9, 6) AS WAP
    FROM (SELECT *, 1 + event_id % 9 AS size FROM events) GROUP BY 1, 2
"""


def _ticks(t):
    return t.events.withColumn("size", 1 + F.col("event_id") % 9)


def _bars(t, size):
    bars = m.bars_from_ticks(_ticks(t), size, "user_id", "ts", "event_id", "value", "size")
    return bars.withColumns({"Timestamp": ntz("Timestamp"), "WAP": r6(F.col("WAP") + 1e-9)})


_SIZES = {
    "ohlc_bars_5s": (m.BarSize.SEC_5, "time_bucket(INTERVAL 5 SECOND, ts)"),
    "ohlc_bars_1m": (m.BarSize.MIN_1, "date_trunc('minute', ts)"),
    "ohlc_bars_15m": (m.BarSize.MIN_15, "time_bucket(INTERVAL 15 MINUTE, ts)"),
    "ohlc_bars_1h": (m.BarSize.HOUR_1, "date_trunc('hour', ts)"),
    "ohlc_bars_8h": (m.BarSize.HOUR_8, "time_bucket(INTERVAL 8 HOUR, ts, TIMESTAMP '1970-01-01')"),
    "ohlc_bars_1d": (m.BarSize.DAY_1, "date_trunc('day', ts)"),
    "ohlc_bars_1w": (m.BarSize.WEEK_1, "date_trunc('week', ts)"),
    "ohlc_bars_1mo": (m.BarSize.MONTH_1, "date_trunc('month', ts)"),
}
# The remaining sizes, by the length that their names state.
_SIZES |= {
    f"ohlc_bars_{size.name.lower()}": (size, f"to_timestamp(epoch_us(ts) // {size.seconds}000000 * {size.seconds}) AT TIME ZONE 'UTC'")
    for size in m.BarSize
    if size not in [known for known, _ in _SIZES.values()]
}
for _name, (_size, _bucket) in _SIZES.items():
    query(_name, _BARS.format(bucket=_bucket))(lambda t, size=_size: _bars(t, size))


@query(
    "bars_realtime_midpoint",
    """
    SELECT user_id, b AS Timestamp, b + INTERVAL 5 SECOND AS TimestampEnd, arg_min(mid, (ts, event_id)) AS "Open",
           max(mid) AS High, min(mid) AS Low, arg_max(mid, (ts, event_id)) AS "Close", count(*) AS "Count"
    FROM (SELECT *, 0.5 * (value + (value + 2)) AS mid, time_bucket(INTERVAL 5 SECOND, ts) AS b FROM events) GROUP BY 1, 2
    """,
)
def bars_realtime_midpoint(t):
    quotes = t.events.withColumns({"BidPrice": F.col("value"), "AskPrice": F.col("value") + 2})
    bars = m.bars_realtime(quotes, "user_id", "MIDPOINT", 5, "ts", "event_id", volume=None)
    bars = bars.withColumns({"Timestamp": ntz("Timestamp"), "TimestampEnd": ntz("TimestampEnd")})
    return bars.drop("Volume", "WAP")


_QUOTES = """
    SELECT user_id, date_trunc('hour', ts) AS Timestamp, arg_min({price}, (ts, event_id)) AS "Open", max({price}) AS High, min({price}) AS Low,
           arg_max({price}, (ts, event_id)) AS "Close", count(*) AS BarCount FROM events GROUP BY 1, 2
"""
for _basis, _price in {"BID": "(value - 1)", "ASK": "(value + 1)", "TRADES": "value"}.items():

    @query(f"bars_basis_{_basis.lower()}", _QUOTES.format(price=_price))
    def bars_basis(t, basis=_basis):
        quotes = t.events.withColumns({"BidPrice": F.col("value") - 1, "AskPrice": F.col("value") + 1, "Price": F.col("value")})
        bars = m.bars_from_ticks(quotes, m.BarSize.HOUR_1, "user_id", "ts", "event_id", m.basis_price(quotes, basis), None)
        return bars.withColumn("Timestamp", ntz("Timestamp")).drop("Volume", "WAP")


@query(
    "bars_replace_updates",
    """
    SELECT user_id, bucket, event_id, value FROM (
      SELECT *, date_trunc('day', ts) AS bucket,
             row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def bars_replace_updates(t):
    rows = t.events.withColumn("bucket", F.date_trunc("day", F.col("ts").cast("timestamp")))
    latest = last_by(rows, ["user_id", "bucket"], ["ts", "event_id"])
    return latest.select("user_id", ntz("bucket").alias("bucket"), "event_id", "value")


_HISTORY = """
    SELECT event_id, ts, user_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {d}, event_id {d}) AS rn FROM events WHERE ts {op} TIMESTAMP '2024-01-15')
    WHERE rn <= 10
"""


def _history(t, **bound):
    rows = t.events.select("event_id", "ts", "user_id", "value")
    return m.tick_history(rows, 10, "user_id", "ts", "event_id", **bound)


@query("tick_history_after", _HISTORY.format(d="ASC", op=">"))
def tick_history_after(t):
    return _history(t, start=datetime(2024, 1, 15))


@query("tick_history_before", _HISTORY.format(d="DESC", op="<="))
def tick_history_before(t):
    return _history(t, end=datetime(2024, 1, 15))


@query("tick_type_select", "SELECT * FROM events WHERE event_type IN ('purchase', 'view')")
def tick_type_select(t):
    wanted = {"SHORTABLE": "purchase", "SHORTABLE_SHARES": "purchase", "AUCTION": "view"}
    code = F.lit(None).cast("int")
    for name, event in wanted.items():
        code = F.when(F.col("event_type") == event, F.lit(m.GENERIC_TICK_TYPES[name])).otherwise(code)
    return m.select_generic_ticks(t.events.withColumn("TickCode", code), list(wanted)).drop("TickCode")


@query(
    "snapshot_latest",
    """
    SELECT event_id, ts, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def snapshot_latest(t):
    return m.snapshot_latest(t.events.drop("props"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "regular_hours",
    """
    SELECT event_id, ts, user_id FROM events
    WHERE hour(timezone('US/Eastern', timezone('UTC', ts))) * 60 + minute(timezone('US/Eastern', timezone('UTC', ts))) >= 570
      AND hour(timezone('US/Eastern', timezone('UTC', ts))) < 16
      AND dayofweek(timezone('US/Eastern', timezone('UTC', ts))) BETWEEN 1 AND 5
    """,
)
def regular_hours(t):
    low, high = t.events.agg(F.min("ts"), F.max("ts")).first()
    low, high = low or datetime(1970, 1, 1), high or datetime(1970, 1, 1)
    days = [low.date() + timedelta(days=i) for i in range(-1, (high.date() - low.date()).days + 2)]
    periods = [
        f"{d:%Y%m%d}:CLOSED" if d.weekday() > 4 else f"{d:%Y%m%d}:0930-{d:%Y%m%d}:1600" for d in days
    ]
    contracts = t.events.select("user_id").distinct()
    hours = contracts.withColumns({"LiquidHours": F.lit(periods), "TimeZoneId": F.lit("US/Eastern")})
    return m.regular_hours_only(t.events.select("event_id", "ts", "user_id"), hours, "ts", "user_id")


_NEWS = """
    SELECT doc_id, source, lang, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id DESC) AS rn FROM documents
      WHERE n_chars > 100 AND n_chars <= 20000 {where}) WHERE rn <= {n}
"""


def _news(t, providers, n):
    # The day count since 1970 stands in for the publication time.
    at = F.timestamp_seconds(F.col("n_chars") * 86400)
    news = t.documents.select("doc_id", "source", "lang", "n_chars", at.alias("Timestamp"))
    start, end = (datetime(1970, 1, 1) + timedelta(days=d) for d in (100, 20000))
    out = m.news_history(news, start, end, providers, n, "lang", "Timestamp", "source", "doc_id")
    return out.drop("Timestamp")


@query("news_history", _NEWS.format(where="AND source IN ('src0', 'src3')", n=5))
def news_history(t):
    return _news(t, ["src0", "src3"], 5)


@query("news_history_all", _NEWS.format(where="", n=100))
def news_history_all(t):
    return _news(t, None, 100)


@query("news_article", "SELECT doc_id AS ArticleId, source AS ProviderCode, text FROM documents WHERE source = 'src1' AND doc_id = 1")
def news_article(t):
    articles = t.documents.selectExpr("doc_id AS ArticleId", "source AS ProviderCode", "text")
    return m.news_article(articles, "src1", 1)


@query(
    "contract_search",
    """
    SELECT p_partkey, p_name, p_brand, Pattern
    FROM part, (SELECT unnest(['GEAR', 'red', 'Brand#2']) AS Pattern)
    WHERE contains(lower(p_name), lower(Pattern)) OR contains(lower(p_brand), lower(Pattern))
    """,
)
def contract_search(t):
    parts = t.part.select("p_partkey", "p_name", "p_brand")
    return m.contract_search(parts, ["GEAR", "red", "Brand#2"], ["p_name", "p_brand"])


@query("account_filter", "SELECT c_custkey, c_acctbal, c_mktsegment AS Account FROM customer WHERE c_mktsegment = 'MACHINERY'")
def account_filter(t):
    rows = t.customer.selectExpr("c_custkey", "c_acctbal", "c_mktsegment AS Account")
    return m.for_account(rows, "MACHINERY")


@query("account_filter_all", "SELECT c_custkey, c_acctbal, c_mktsegment AS Account FROM customer")
def account_filter_all(t):
    rows = t.customer.selectExpr("c_custkey", "c_acctbal", "c_mktsegment AS Account")
    return m.for_account(rows, "All")


_TAG = "CASE event_type WHEN 'signup' THEN 'NetLiquidation' WHEN 'error' THEN 'Cushion' WHEN 'click' THEN 'SMA' ELSE event_type END"


@query(
    "account_summary",
    f"""
    SELECT user_id AS Account,
           max(value) FILTER (WHERE Tag = 'NetLiquidation') AS NetLiquidation,
           max(value) FILTER (WHERE Tag = 'Cushion') AS Cushion, max(value) FILTER (WHERE Tag = 'SMA') AS SMA
    FROM (SELECT *, {_TAG} AS Tag FROM events) WHERE Tag IN ('NetLiquidation', 'Cushion', 'SMA') GROUP BY 1
    """,
)
def account_summary(t):
    rows = t.events.selectExpr("user_id AS Account", f"{_TAG} AS Tag", "CAST(value AS STRING) AS Value")
    rows = rows.withColumn("DoubleValue", lenient_double(F.col("Value")))
    return m.account_summary_wide(rows, ["NetLiquidation", "Cushion", "SMA"], "Account")


@query(
    "account_summary_tags",
    f"SELECT event_id, Tag FROM (SELECT *, {_TAG} AS Tag FROM events) WHERE Tag IN ('NetLiquidation', 'Cushion', 'SMA')",
)
def account_summary_tags(t):
    return m.account_summary(t.events.selectExpr("event_id", f"{_TAG} AS Tag"))


@query(
    "chart_prices",
    "SELECT ts AS Timestamp, user_id AS ContractId, value AS BidPrice, round(value + 0.02, 6) AS AskPrice FROM events WHERE event_type = 'view'",
)
def chart_prices(t):
    rows = m.one_key(t.events, event_type="view")
    out = rows.selectExpr("ts AS Timestamp", "user_id AS ContractId", "value AS BidPrice", "value + 0.02D AS AskPrice")
    return rounded(out, "AskPrice")
