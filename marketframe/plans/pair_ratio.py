"""Price ratio of two symbols, bar by bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import constituent, natural_join, update


def pair_ratio(
    bars: DataFrame,
    first: str,
    second: str,
    key: str = "Symbol",
    at: str = "TimestampEnd",
    keep: tuple[str, ...] = ("Timestamp", "TimestampEnd"),
    close: str = "Close",
    names: tuple[str, str] = ("First", "Second"),
    validate: bool = True,
) -> DataFrame:
    """Every bar of the first symbol with the second's close at the same time and their ratio.

    ``validate=False`` skips the check that the second symbol has one bar at a time, for computed bars."""
    a, b = names
    left = constituent(bars, key, first).select(*keep, F.col(close).alias(a))
    out = natural_join(left, constituent(bars, key, second), at, f"{b}={close}", validate=validate)
    return update(out, {"Ratio": F.try_divide(F.col(a), F.col(b))})
