"""The registered queries over the driver's tables, each with the SQL it must agree with."""

from . import derived, kept, logs, markets, messages, outcomes, programs, relational, rows, scale, series, streams, times
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "derived",
    "kept",
    "logs",
    "markets",
    "messages",
    "outcomes",
    "programs",
    "relational",
    "rows",
    "scale",
    "series",
    "streams",
    "times",
]
