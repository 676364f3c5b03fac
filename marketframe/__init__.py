"""marketframe: market and account tables, derived tables and analyses on Spark."""

from .session import builder, shared_dir

__all__ = ["builder", "shared_dir"]
