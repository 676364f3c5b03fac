"""Option pricing in SQL expressions; every step stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of the five-term normal approximation (Abramowitz and Stegun 26.2.17).
CND_GAMMA = 0.2316419
CND_COEFFICIENTS = (0.31938153, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
CND_RSQRT2PI = 0.39894228040143267794

# The rate and the shocks of the scenario grid.
RATE = 0.04
SHOCKS = (-0.2, -0.15, -0.1, -0.05, -0.02, -0.01, 0.0, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2)


def _k(d: str) -> str:
    return f"(1D / (1D + {CND_GAMMA!r}D * abs({d})))"


def _tail(d: str, k: str) -> str:
    """Probability beyond ``|d|``."""
    series = "0D"
    for coefficient in reversed(CND_COEFFICIENTS):
        series = f"{k} * ({coefficient!r}D + {series})"
    return f"{CND_RSQRT2PI!r}D * exp(-0.5D * {d} * {d}) * ({series})"


def _side(d: str, tail: str) -> str:
    return f"IF({d} > 0, 1D - {tail}, {tail})"


def normal_cdf(d: str) -> Column:
    """Cumulative normal probability of a named column."""
    return F.expr(_side(f"`{d}`", _tail(f"`{d}`", _k(f"`{d}`"))))


# The model as a chain of small columns: each is computed once per row, and the generated code stays
# small enough to be compiled to machine code.
_MODEL = (
    {
        "__spread": "{vol} * sqrt(IF({years} > 0, {years}, NULL))",
        "__drift": "ln(try_divide({price}, {strike})) + ({rate} + 0.5D * {vol} * {vol}) * {years}",
        "__discounted": "{strike} * exp(-{rate} * {years})",
    },
    {"__d1": "try_divide(__drift, __spread)"},
    {"__d2": "__d1 - __spread"},
    {"__k1": _k("__d1"), "__k2": _k("__d2")},
    {"__t1": _tail("__d1", "__k1"), "__t2": _tail("__d2", "__k2")},
    {"__n1": _side("__d1", "__t1"), "__n2": _side("__d2", "__t2")},
)
_VALUE = (
    "IF({is_call}, {price} * __n1 - __discounted * __n2, "
    "__discounted * (1D - __n2) - {price} * (1D - __n1))"
)


def with_option_price(
    df: DataFrame, name: str, price: str, strike: str, years: str, rate: str, vol: str, is_call: str
) -> DataFrame:
    """Add the price of a European option; NULL when an input is NULL or the model is undefined.

    Arguments are column names.
    """
    inputs = {"price": price, "strike": strike, "years": years, "rate": rate, "vol": vol, "is_call": is_call}
    named = {k: f"`{v}`" for k, v in inputs.items()}
    kept = [f"`{c}`" for c in df.columns if c != name]
    for stage in _MODEL:
        df = df.selectExpr("*", *[f"{e.format(**named)} AS {c}" for c, e in stage.items()])
    return df.selectExpr(*kept, f"{_VALUE.format(**named)} AS `{name}`")
