"""Scenario risk of option positions: price under each shock of the underlying, sum per account."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import mid
from ..functions.pricing import RATE, SHOCKS, with_option_price
from ..functions.timefmt import expiry_instant, years_365
from ..operators.relational import Names, as_list, join, last_by, natural_join, sum_by

CONTRACT = (
    "ContractId",
    "SecType",
    "Symbol",
    "LocalSymbol",
    "Expiry",
    "Strike",
    "Right",
    "Multiplier",
    "Currency",
)


def net_positions(positions: DataFrame, keys: Names = CONTRACT) -> DataFrame:
    """Position per contract over all accounts."""
    return sum_by(positions.select(*as_list(keys), "Position"), keys)


def last_underlying_prices(quotes: DataFrame, order: Names, sec_type: str = "STK") -> DataFrame:
    """Latest quote per underlying contract with its mid price."""
    stocks = quotes.filter(F.col("SecType") == sec_type)
    return last_by(stocks, "ContractId", order).withColumn("MidPrice", mid(F.col("BidPrice"), F.col("AskPrice")))


def last_vols(generic_ticks: DataFrame, order: Names, tick_type: str = "OPTION_IMPLIED_VOL") -> DataFrame:
    """Latest implied volatility per contract."""
    vols = generic_ticks.filter(F.col("TickType") == tick_type).withColumnRenamed("Value", "Vol")
    return last_by(vols, "ContractId", order)


def scenarios(
    positions: DataFrame,
    vols: DataFrame,
    underlying: DataFrame,
    asof: datetime,
    shocks: Sequence[float] = SHOCKS,
    rate: float = RATE,
    validate: bool = True,
) -> DataFrame:
    """Positions priced at the underlying's price and at every shock of it.

    Joins run before the shocks fan rows out, and pricing is a column expression, so the fan-out
    never leaves its task. ``asof`` is the valuation time. ``validate=False`` skips the check that
    ``vols`` has one row per contract, as :func:`last_vols` gives.
    """
    # The symbol's join comes first: sums that follow then need a shuffle of their own after the
    # contract's, so that no task gets all contracts and shocks of one symbol.
    out = join(positions, underlying, "Symbol", "UPrice=MidPrice")
    out = natural_join(out, vols, "ContractId", "Vol", validate)
    out = out.withColumn("ExpiryTime", expiry_instant(F.col("Expiry"))).withColumns(
        {
            "T": years_365(F.lit(asof), F.col("ExpiryTime")),
            "IsCall": F.col("Right").eqNullSafe("C"),
            "IsStock": F.col("SecType").eqNullSafe("STK"),
            "Rate": F.lit(rate),
        }
    )
    out = _theoretical(out, "TheoBase", "UPrice")
    out = out.withColumn("Scenario", F.explode(F.array(*[F.lit(float(s)) for s in shocks])))
    out = out.withColumn("UPriceScenario", (F.lit(1.0) + F.col("Scenario")) * F.col("UPrice"))
    out = _theoretical(out, "TheoScenario", "UPriceScenario")
    return out.withColumn("TheoChange", F.col("TheoScenario") - F.col("TheoBase"))


def _theoretical(df: DataFrame, name: str, price: str) -> DataFrame:
    """A stock is worth its price, an option what the model says."""
    priced = with_option_price(df, name, price, "Strike", "T", "Rate", "Vol", "IsCall")
    return priced.withColumn(name, F.when(F.col("IsStock"), F.col(price)).otherwise(F.col(name)))


def scenario_risk(priced: DataFrame, keys: Names = ("Account", "Scenario")) -> DataFrame:
    """Change in value per account and shock."""
    risk = F.col("Position") * F.col("Multiplier") * F.col("TheoChange")
    return sum_by(priced.select(*as_list(keys), risk.alias("Risk")), keys)


def account_risk(
    positions: DataFrame,
    vols: DataFrame,
    underlying: DataFrame,
    asof: datetime,
    contract: Names = CONTRACT,
    keys: Names = ("Account", "Scenario"),
    **model,
) -> DataFrame:
    """Scenario risk straight from positions.

    Risk is linear in the position, so positions are first summed per account and contract: each
    contract is then priced once per account, however many position rows there are.
    """
    by = [k for k in as_list(keys) if k != "Scenario"]
    held = sum_by(positions.select(*by, *as_list(contract), "Position"), [*by, *as_list(contract)])
    return scenario_risk(scenarios(held, vols, underlying, asof, **model), keys)
