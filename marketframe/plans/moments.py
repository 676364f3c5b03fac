"""Regression of each symbol on a benchmark, kept current by mergeable co-moments.

Of a symbol's pairs only their number, means, sums of squares and products around the means are kept.
Those of new pairs are merged in, so beta, intercept and R2 never read history again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import Names, as_list
from ..streaming.changes import Changes
from ..streaming.streams import start

FIELDS = ("N", "MeanX", "MeanY", "M2X", "M2Y", "CXY")


def moments(pairs: DataFrame, keys: Names = "Symbol", y: str = "Return", x: str = "BenchmarkReturn") -> DataFrame:
    """Co-moments per key, in one aggregate combined before the shuffle; pairs with a NULL are left out."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    rows = pairs.filter(both).select(*as_list(keys), F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    n = F.count(F.lit(1))
    return rows.groupBy(*as_list(keys)).agg(
        n.alias("N"),
        F.avg("__x").alias("MeanX"),
        F.avg("__y").alias("MeanY"),
        (F.var_pop("__x") * n).alias("M2X"),
        (F.var_pop("__y") * n).alias("M2Y"),
        (F.covar_pop("__x", "__y") * n).alias("CXY"),
    )


def _added(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets of pairs, of a NULL and one those of the one."""
    n = a["N"] + b["N"]
    dx, dy, share = b["MeanX"] - a["MeanX"], b["MeanY"] - a["MeanY"], a["N"] * b["N"] / n
    return F.when(a.isNull(), b).otherwise(
        F.struct(
            n.alias("N"),
            (a["MeanX"] + dx * b["N"] / n).alias("MeanX"),
            (a["MeanY"] + dy * b["N"] / n).alias("MeanY"),
            (a["M2X"] + b["M2X"] + dx * dx * share).alias("M2X"),
            (a["M2Y"] + b["M2Y"] + dy * dy * share).alias("M2Y"),
            (a["CXY"] + b["CXY"] + dx * dy * share).alias("CXY"),
        )
    )


def merge_moments(partial: DataFrame, keys: Names = "Symbol") -> DataFrame:
    """Moments of several disjoint sets of pairs per key made one.

    A key's partial moments are collected, so there should be few of them: one a folder of changes.
    """
    kind = "struct<N:bigint,MeanX:double,MeanY:double,M2X:double,M2Y:double,CXY:double>"
    sets = partial.groupBy(*as_list(keys)).agg(F.sort_array(F.collect_list(F.struct(*FIELDS).cast(kind))).alias("__sets"))
    total = F.aggregate("__sets", F.lit(None).cast(kind), lambda a, b: _added(a, b).cast(kind))
    return sets.select(*as_list(keys), total.alias("__m")).select(*as_list(keys), "__m.*")


def regression(moments: DataFrame) -> DataFrame:
    """Beta, Intercept and R2 of moments; NULL for a constant benchmark. A perfect fit of a constant has R2 1."""
    keys = [c for c in moments.columns if c not in FIELDS]
    varies = F.col("M2X") > 0
    beta = F.when(varies, F.col("CXY") / F.col("M2X"))
    r2 = F.when(varies & (F.col("M2Y") > 0), F.col("CXY") * F.col("CXY") / F.col("M2X") / F.col("M2Y")).when(varies, 1.0)
    return moments.select(*keys, beta.alias("Beta"), (F.col("MeanY") - beta * F.col("MeanX")).alias("Intercept"), r2.alias("R2"))


def current_moments(path: str, keys: Names = "Symbol") -> Changes:
    """Moments kept under a path."""
    return Changes(path, keys, merge=lambda rows: merge_moments(rows, keys))


def keep_betas_current(pairs: DataFrame, path: str, checkpoint: str, keys: Names = "Symbol", y: str = "Return", x: str = "BenchmarkReturn", every: str | None = None) -> StreamingQuery:
    """Merge every micro-batch's moments into those under ``path``: read ``regression(current_moments(path, keys).read(spark))``."""
    kept = current_moments(path, keys)
    return start(pairs, checkpoint, lambda rows, batch_id: kept.write(moments(rows, keys, y, x), batch_id), "append", every)
