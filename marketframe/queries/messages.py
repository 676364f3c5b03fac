"""Messages in the feed's form, made from the driver's tables, as rows of the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.derived import derive
from ..sources.messages import normalize_message
from .registry import ntz, query


@query(
    "raw_ticks_trade",
    """
    SELECT user_id AS RequestId, to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC' AS Timestamp, value AS Price,
           CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ['Cash Trade (Same Day Clearing)', 'Odd Lot Trade'] ELSE ['UNKNOWN(?)'] END AS SpecialConditions,
           CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END AS Exchange FROM events
    """,
)
def raw_ticks_trade(t):
    letters = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, "I C I").otherwise("?")
    messages = t.events.select(
        F.col("user_id").alias("RequestId"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("Timestamp"),
        F.col("value").alias("Price"),
        letters.alias("SpecialConditions"),
        F.when(F.col("event_id") % 2 == 0, "").otherwise(F.col("event_type")).alias("Exchange"),
    )
    return normalize_message("ticks_trade", messages).withColumn("Timestamp", ntz("Timestamp"))


@query(
    "raw_ticks_price",
    "SELECT user_id AS RequestId, event_type AS TickType, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS Price FROM events",
)
def raw_ticks_price(t):
    price = F.when(F.col("event_id") % 4 == 0, 0.0).otherwise(F.col("value"))
    return normalize_message("ticks_price", t.events.select(F.col("user_id").alias("RequestId"), F.col("event_type").alias("TickType"), price.alias("Price")))


@query(
    "raw_bars_historical",
    """
    SELECT o_orderkey AS RequestId,
           CASE WHEN o_orderkey % 2 = 0 THEN timezone('UTC', timezone('US/Eastern', o_orderdate::TIMESTAMP + INTERVAL 86399 SECOND))
                ELSE o_orderdate::TIMESTAMP END AS Timestamp,
           o_totalprice AS Close, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS Volume,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 5 END AS BarCount FROM orders
    """,
)
def raw_bars_historical(t):
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyyMMdd")).otherwise((F.unix_date(day).cast("long") * 86400).cast("string"))
    messages = t.orders.select(
        F.col("o_orderkey").alias("RequestId"),
        text.alias("Timestamp"),
        F.col("o_totalprice").alias("Close"),
        F.when(F.col("o_orderkey") % 3 == 0, -1.0).otherwise(F.col("o_totalprice")).alias("Volume"),
        (F.col("o_orderkey") % 5).alias("BarCount"),
    )
    return normalize_message("bars_historical", messages).withColumn("Timestamp", ntz("Timestamp"))


_DETAILS = """
    SELECT p_partkey AS RequestId, CASE WHEN p_size % 2 = 0 THEN NULL ELSE 'C' END AS "Right",
           CASE WHEN p_size % 3 = 0 THEN 1.0 ELSE p_size::DOUBLE END AS Multiplier, list_sort(list_distinct([p_brand, p_type, 'LMT'])) AS OrderTypes,
           CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size::BIGINT END AS AggGroup, ['ISIN=' || p_name] AS SecIdList FROM part
"""


@query("raw_contracts_details", _DETAILS)
def raw_contracts_details(t):
    messages = t.part.select(
        F.col("p_partkey").alias("RequestId"),
        F.when(F.col("p_size") % 2 == 0, "?").otherwise("C").alias("Right"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_size").cast("string")).alias("Multiplier"),
        F.concat_ws(",", "p_brand", "p_type", F.lit("LMT"), "p_brand").alias("OrderTypes"),
        F.when(F.col("p_size") % 5 == 0, 2147483647).otherwise(F.col("p_size")).alias("AggGroup"),
        F.array(F.struct(F.lit("ISIN").alias("tag"), F.col("p_name").alias("value"))).alias("SecIdList"),
    )
    return normalize_message("contracts_details", messages)


@query(
    "raw_orders_submitted",
    """
    SELECT o_orderkey AS PermId, CASE o_orderkey % 3 WHEN 0 THEN 'Customer' WHEN 1 THEN 'Firm' ELSE 'Unknown' END AS Origin,
           CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Holding' WHEN 2 THEN 'Elsewhere' ELSE 'UNKNOWN(3)' END AS ShortSaleSlot,
           o_totalprice AS LmtPrice FROM orders
    """,
)
def raw_orders_submitted(t):
    messages = t.orders.select(
        F.col("o_orderkey").alias("PermId"), (F.col("o_orderkey") % 3).alias("Origin"), (F.col("o_orderkey") % 4).alias("ShortSaleSlot"), F.col("o_totalprice").alias("LmtPrice")
    )
    return normalize_message("orders_submitted", messages)


@query(
    "raw_commission_report",
    """
    SELECT l_orderkey || '-' || l_linenumber AS ExecId, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS Yield,
           CASE WHEN l_linenumber = 2 THEN NULL ELSE strftime(l_shipdate::DATE, '%Y-%m-%d') END AS YieldRedemptionDate FROM lineitem
    """,
)
def raw_commission_report(t):
    date = F.date_format(F.col("l_shipdate").cast("date"), "yyyyMMdd").cast("int")
    messages = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ExecId"),
        F.when(F.col("l_linenumber") == 1, 1.7976931348623157e308).otherwise(F.col("l_tax")).alias("Yield"),
        F.when(F.col("l_linenumber") == 2, 0).otherwise(date).alias("YieldRedemptionDate"),
    )
    return normalize_message("orders_exec_commission_report", messages)


@query(
    "raw_news_historical",
    """
    SELECT doc_id AS RequestId, TIMESTAMP '2024-01-05 15:00:00' AS Timestamp, source AS ProviderCode, nullif(text, '') AS Headline FROM documents
    """,
)
def raw_news_historical(t):
    messages = t.documents.select(
        F.col("doc_id").alias("RequestId"), F.lit("20240105 10:00:00").alias("Timestamp"), F.col("source").alias("ProviderCode"), F.concat(F.lit("{A:1:L:en}"), "text").alias("Headline")
    )
    return normalize_message("news_historical", messages).withColumn("Timestamp", ntz("Timestamp"))


@query(
    "raw_accounts_positions",
    """
    SELECT c_custkey AS RequestId, c_mktsegment AS Account, CASE WHEN c_custkey % 2 = 0 THEN 'STK' ELSE 'OPT' END AS SecType,
           CASE WHEN c_custkey % 2 = 0 THEN 'SMART' ELSE c_name END AS Exchange, c_acctbal AS Position, 1.0::DOUBLE AS Multiplier FROM customer
    """,
)
def raw_accounts_positions(t):
    messages = t.customer.select(
        F.col("c_custkey").alias("RequestId"),
        F.col("c_mktsegment").alias("Account"),
        F.when(F.col("c_custkey") % 2 == 0, "STK").otherwise("OPT").alias("SecType"),
        F.col("c_name").alias("Exchange"),
        F.col("c_acctbal").alias("Position"),
        F.lit(None).cast("string").alias("Multiplier"),
    )
    return normalize_message("accounts_positions", messages)


@query(
    "raw_to_derived",
    """
    SELECT user_id AS RequestId, to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC' AS Timestamp, 'C' || user_id AS Symbol, value AS Price
    FROM events
    """,
)
def raw_to_derived(t):
    """Messages through the rules into a derived table, with the columns of the requests that they answer."""
    ticks = t.events.select(
        F.col("user_id").alias("RequestId"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("Timestamp"), F.col("value").alias("Price"),
        F.lit("X").alias("Exchange"), F.col("ts").cast("timestamp").alias("ReceiveTime"), F.col("event_id").alias("Seq"),
    )
    asked = t.events.groupBy(F.col("user_id").alias("RequestId")).agg(F.min("ts").cast("timestamp").alias("ReceiveTime"), F.min("event_id").alias("Seq"))
    asked = asked.select("*", F.concat(F.lit("C"), "RequestId").alias("Symbol"), F.lit("?").alias("Right"))
    raw = {"requests": normalize_message("requests", asked), "ticks_trade": normalize_message("ticks_trade", ticks)}
    out = derive(raw)["ticks_trade"]
    return out.select("RequestId", ntz("Timestamp").alias("Timestamp"), "Symbol", "Price")
