"""Error code table: union of published code tables, with fixed additions for missing codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import last_by

# Texts for codes that the published tables lack.
ADDITIONAL_CODES = {
    0: "Warning: Approaching max rate of 50 messages per second",
    504: "Not connected",
    502: "Couldn't connect to TWS. Confirm that 'Enable ActiveX and Socket EClients' is enabled and connection port is the same as 'Socket Port' on the TWS 'Edit->Global Configuration...->API->Settings' menu. Live Trading ports: TWS: 7496; IB Gateway: 4001. Simulated Trading ports for new installations of version 954.1 or newer:  TWS: 7497; IB Gateway: 4002",
    2113: "The order size for Bonds (Bills) is entered as a nominal par value of the order, and must be a multiple",
    2129: "The product is provided on an indicative and informational basis only. IBKR does not represent that the valuation for this instrument is accurate. The basis for the calculation may change at any time. Traders are responsible for understanding the contract details and details of deliverable instruments independently of IBKR sources, which are provided on a best efforts basis only.",
    2157: "Sec-def data farm connection is broken:secdefil",
    10089: "Requested market data requires additional subscription for API.See link in 'Market Data Connections' dialog for more details.",
    10147: "OrderId that needs to be cancelled is not found.",
    10168: "Requested market data is not subscribed.Delayed market data is not enabled.",
    10172: "Failed to request news article: No data available",
    10187: "Failed to request historical ticks",
    10189: "Failed to request tick-by-tick data",
    10190: "Maxnumber of tick-by-tick requests has been reached.",
    10311: "This order will be directly routed to NYSE. Direct routed orders may result in higher trade fees. Restriction is specified in Precautionary Settings of Global Configuration/API.",
    10349: "Order TIF was set to DAY based on order preset.",
}


def error_code_dim(
    spark: SparkSession,
    tables: Sequence[DataFrame],
    columns: Sequence[str] = ("Code", "Message", "Note"),
    additions: Mapping[int, str] | None = None,
) -> DataFrame:
    """(ErrorCode, Message, Note) from tables that hold all of ``columns``; others are ignored.

    Missing text is ''. A later table, and a later row by ``Row`` where a table has one, wins.
    Additions apply only to codes absent from the tables.
    """
    code, message, note = columns
    parts = [
        t.select(
            F.lit(i).alias("__table"),
            (F.col("Row") if "Row" in t.columns else F.lit(0)).cast("long").alias("__row"),
            F.col(code).cast("long").alias("ErrorCode"),
            F.coalesce(F.col(message), F.lit("")).alias("Message"),
            F.coalesce(F.col(note), F.lit("")).alias("Note"),
        )
        for i, t in enumerate(tables)
        if set(columns) <= set(t.columns)
    ]
    texts = {**ADDITIONAL_CODES, **(additions or {})}
    rows = [F.struct(F.lit(k).cast("long").alias("ErrorCode"), F.lit(v).alias("Message")) for k, v in texts.items()]
    added = spark.range(1).select(F.inline(F.array(*rows)))
    parts.append(added.select(F.lit(-1).alias("__table"), F.lit(0).cast("long").alias("__row"), "*", F.lit("").alias("Note")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # Table -1 is earliest, so an addition survives only where no table has its code.
    return last_by(union, "ErrorCode", ["__table", "__row"]).drop("__table", "__row")
