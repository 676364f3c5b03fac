"""Decayed price bands, periodic snapshots, position limits, order intents and executions.

Order intents are rows of a table; nothing is sent anywhere.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import mid
from ..functions.timefmt import micros
from ..operators.decay import decay_stats
from ..operators.ordered import to_micros
from ..operators.relational import first_by, last_by, natural_join, update
from ..operators.snapshot import TimeGrid, snapshot_when

TAU = timedelta(minutes=2)
MAX_POSITION_DOLLARS = 10000.0
ORDER_QUANTITY = 100


def mid_prices(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("MidPrice", mid(F.col("BidPrice"), F.col("AskPrice")))


def predictions(
    prices: DataFrame,
    tau: timedelta = TAU,
    key: str = "Symbol",
    ts: str = "Timestamp",
    seq: str = "Seq",
    price: str = "MidPrice",
    block: int | None = None,
) -> DataFrame:
    """Decayed mean and deviation of the price with the band between mean minus and plus deviation."""
    out = decay_stats(prices, ts, tau, key, {"PredPrice": price}, {"PredSD": price}, seq, block)
    low, high = F.col("PredPrice") - F.col("PredSD"), F.col("PredPrice") + F.col("PredSD")
    return out.withColumn("PredLow", low).withColumn("PredHigh", high)


def first_times(rows: DataFrame, key: str = "Symbol", ts: str = "Timestamp") -> DataFrame:
    """First time per key. A minimum, as nothing else of the first row is used."""
    return rows.groupBy(key).agg(F.min(ts).alias("TimestampFirst"))


def with_first_time(rows: DataFrame, source: DataFrame | None = None, key="Symbol", ts="Timestamp") -> DataFrame:
    """Each row with its key's first time, taken from ``source`` if given; rows without a key have none.

    Plain equality keeps rows that windows have partitioned by key where they are."""
    first = first_times(rows if source is None else source, key, ts)
    return natural_join(rows, first, key, "TimestampFirst", validate=False, null_safe=False)


def first_rows(rows: DataFrame, key: str = "Symbol", ts: str = "Timestamp", seq: str = "Seq") -> DataFrame:
    return first_by(rows, key, [ts, seq])


def after_burn_in(rows: DataFrame, tau: timedelta = TAU, ts: str = "Timestamp") -> DataFrame:
    """Rows later than their key's first time by more than ``tau``."""
    return rows.filter(micros(F.col(ts)) > micros(F.col("TimestampFirst")) + F.lit(to_micros(tau)))


def latest_snapshot(
    preds: DataFrame, grid: TimeGrid, key="Symbol", ts="Timestamp", seq="Seq", history: bool = False
) -> DataFrame:
    """Latest prediction per symbol at the trigger times, stamped with ``SnapTime``."""
    return snapshot_when(preds, grid, key, ts, seq, "SnapTime", history)


def position_limits(
    rows: DataFrame, positions: DataFrame, limit: float = MAX_POSITION_DOLLARS, price: str = "MidPrice"
) -> DataFrame:
    """Position and its value per row, and which sides the limit leaves open."""
    out = natural_join(rows, positions, "ContractId", "Position")
    return update(
        out,
        {
            "Position": F.coalesce(F.col("Position"), F.lit(0.0)),
            "PositionDollars": F.col("Position") * F.col(price),
            "MaxPositionDollars": F.lit(limit),
            "BuyOrder": F.col("PositionDollars") < F.col("MaxPositionDollars"),
            "SellOrder": F.col("PositionDollars") > -F.col("MaxPositionDollars"),
        },
    )


def order_counts(limits: DataFrame) -> DataFrame:
    """How many intents each row yields."""
    sides = F.col("SellOrder").cast("long") + F.col("BuyOrder").cast("long")
    return limits.withColumn("NumNewOrders", F.coalesce(sides, F.lit(0)))


def order_intents(limits: DataFrame, keep=("ContractId",), quantity: int = ORDER_QUANTITY) -> DataFrame:
    """One row per intended limit order: sell at the upper band, buy at the lower."""

    def intent(side, price, wanted):
        order = F.struct(
            F.lit(side).alias("Action"),
            F.lit("LIMIT").alias("OrderType"),
            F.lit(quantity).cast("double").alias("TotalQuantity"),
            F.round(price, 2).alias("LmtPrice"),
        )
        return F.when(F.col(wanted), order)

    both = F.array(intent("SELL", F.col("PredHigh"), "SellOrder"), intent("BUY", F.col("PredLow"), "BuyOrder"))
    orders = limits.select(*keep, F.explode(F.array_compact(both)).alias("__order"))
    return orders.select(*keep, "__order.*")


def open_intents(snapshots: DataFrame, key: str = "ContractId", at: str = "SnapTime") -> DataFrame:
    """The intents in force: those of each contract's newest snapshot replace all earlier ones."""
    return order_intents(last_by(snapshots, key, at), keep=(key, at))


def executions_since_start(executions: DataFrame, starts: DataFrame, key="Symbol", ts="Timestamp") -> DataFrame:
    """Executions at or after their symbol's first prediction; one without predictions has none."""
    out = natural_join(executions, starts, key, "TimestampFirst")
    return out.filter(F.col(ts) >= F.col("TimestampFirst"))


def buys(executions: DataFrame) -> DataFrame:
    return executions.filter(F.col("Side") == "BOT")


def sells(executions: DataFrame) -> DataFrame:
    return executions.filter(F.col("Side") == "SLD")
