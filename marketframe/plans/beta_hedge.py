"""Returns, regression of each symbol on a benchmark, portfolio beta and the hedge for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import round_half_up
from ..operators.relational import Names, as_list, constituent, natural_join, sum_by, update

MIN_R2 = 0.2
LIMIT_OFFSET = 0.05


def with_benchmark(
    returns: DataFrame, benchmark: DataFrame, ts: Names = "Timestamp", name: str = "BenchmarkReturn", validate: bool = True
) -> DataFrame:
    """The benchmark's return at the same time, added to every return.

    ``validate=False`` skips the check that the benchmark has one row at a time, for computed bars."""
    return natural_join(returns, benchmark, ts, f"{name}=Return", validate=validate)


def benchmark_rows(returns: DataFrame, symbol: str, key: str = "Symbol") -> DataFrame:
    return constituent(returns, key, symbol)


def regress(returns: DataFrame, keys: Names = "Symbol", y="Return", x="BenchmarkReturn") -> DataFrame:
    """Least squares of return on benchmark return per key, in one aggregate combined before the
    shuffle; pairs with a NULL are left out. A perfect fit of a constant has R2 1."""
    return returns.groupBy(*as_list(keys)).agg(
        F.regr_slope(y, x).alias("Beta"),
        F.regr_intercept(y, x).alias("Intercept"),
        F.regr_r2(y, x).alias("R2"),
    )


def positions_with_beta(
    positions: DataFrame,
    prices: DataFrame,
    betas: DataFrame,
    contract: str = "ContractId",
    symbol: str = "Symbol",
    validate: bool = True,
) -> DataFrame:
    """Positions with price, value, profit and beta-weighted value. ``validate=False`` skips the
    check that ``prices`` has one row per contract; betas from :func:`regress` need none."""
    out = natural_join(positions, prices, contract, "Price", validate)
    out = natural_join(out, betas, symbol, ["Beta", "R2"], validate=False)
    return update(
        out,
        {
            "PosValue": F.col("Position") * F.col("Price"),
            "PNL": F.col("PosValue") - F.col("AvgCost") * F.col("Position"),
            "BetaValue": F.col("Beta") * F.col("PosValue"),
        },
    )


def hedge(positions: DataFrame, benchmark_price: DataFrame, min_r2: float = MIN_R2) -> DataFrame:
    """Portfolio value and beta, and the benchmark shares that offset it.

    Positions fitted no better than ``min_r2`` do not count toward the hedge. ``benchmark_price``
    is one row with ``Price``. Comparing with a NULL R2 leaves the position out.
    """
    for_hedge = F.when(F.col("R2") > min_r2, F.col("BetaValue")).otherwise(F.lit(0.0))
    totals = sum_by(positions.select("PosValue", "BetaValue", for_hedge.alias("BetaValueForHedge")))
    out = natural_join(totals, benchmark_price, [], "BenchmarkPrice=Price")
    out = update(
        out,
        {
            "PortfolioBeta": F.try_divide(F.col("BetaValue"), F.col("PosValue")),
            "HedgeShares": -round_half_up(F.try_divide(F.col("BetaValueForHedge"), F.col("BenchmarkPrice"))),
            "HedgeCost": F.col("HedgeShares") * F.col("BenchmarkPrice"),
        },
    )
    return out.select(
        F.col("PosValue").alias("PortfolioValue"),
        "PortfolioBeta",
        "BetaValue",
        "BetaValueForHedge",
        "HedgeShares",
        "HedgeCost",
        "BenchmarkPrice",
    )


def hedge_intent(hedges: DataFrame, offset: float = LIMIT_OFFSET) -> DataFrame:
    """The hedge as an order intent: buy above or sell below the last price by ``offset``."""
    buy = F.col("HedgeShares") > 0
    return hedges.select(
        F.when(buy, "BUY").otherwise("SELL").alias("Action"),
        F.lit("LIMIT").alias("OrderType"),
        F.col("HedgeShares").alias("TotalQuantity"),
        (F.col("BenchmarkPrice") + F.when(buy, F.lit(offset)).otherwise(F.lit(-offset))).alias("LmtPrice"),
    )
