"""Row-order operators that do not put one key's rows into one task.

A window over a key alone sends all rows of the key to one task; a hot key then sets the run time of
the whole job. Here rows are shuffled once, by key and block: a key that fits a task is one block, a hot
key's rows are cut at points that a small sample of its rows gives, as a range partitioning would. What
a block needs from the rows before it is a prefix over one small row per block, which leads its block.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..functions.timefmt import micros
from ..session import shared_dir
from .relational import Names, as_list

US = "__us"
BLOCK = "__block"
CUTS = "__cuts"
POINT = "__point"
FOUND = "__found"

# Keys with more rows than this, about, are cut into blocks of half as many.
SPLIT_ROWS = 2_000_000
# Sampled rows for as many: enough that a block's size is right to about a sixth.
SAMPLES = 64
# Keys with more rows than so many times the split are cut into larger blocks first, and these again.
FAN = 256
# The block of rows without a time, where blocks have a given length: before all others, as such rows stand first.
FIRST_BLOCK = -(2**63)
# Cut points that are broadcast at most; more are joined by a shuffle.
BROADCAST_POINTS = 200_000


def to_micros(duration: timedelta | int | float) -> int:
    """A timedelta, or seconds, in whole microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    return round(duration * 1_000_000)


def position(df: DataFrame, column: str) -> Column:
    """A time in microseconds, or a whole number as it is."""
    kind = df.schema[column].dataType
    return F.col(column).cast("long") if isinstance(kind, T.IntegralType) else micros(F.col(column))


@dataclass(frozen=True)
class Cuts:
    """Where hot keys are cut: one row per hot key with its points (time, then sequence columns) in order.

    There are about twice as many points as the hot rows have ``split_rows``. The table is written once, so
    that all uses of it cut alike, and broadcast if its counted points are few. ``steps`` are those of a
    binary search in the longest row. Only rows that agree in time and sequence stay together whatever
    their number.

    A row is joined with a few hundred points only, whatever the key's size: if ``coarser`` cuts come first, there is
    one row for each of their blocks that is cut again, and one without a block for each key that they leave whole.
    """

    points: DataFrame
    small: bool
    steps: tuple[int, ...]
    coarser: Cuts | None = None


def _point(df: DataFrame, ts: str, seq: list[str]) -> Column:
    at = position(df, ts)
    return (F.struct(at.alias(US), *seq) if seq else at).alias(POINT)


def _sample(points: DataFrame, rows: int) -> tuple[DataFrame, float]:
    share = min(1.0, SAMPLES / rows)
    return points.sample(fraction=share, seed=7) if share < 1 else points, share


def plan_cuts(df: DataFrame, keys: Names, ts: str, seq: Names | None = None, rows: int | None = SPLIT_ROWS) -> Cuts | None:
    """Where to cut hot keys, or None when every key fits a task.

    One narrow read of a sample decides, now; each level of cuts takes one more. Results don't depend on the
    samples: they move the cuts only. ``rows=None`` states that no key is hot, and nothing is read.
    """
    if rows is None:
        return None
    keys = as_list(keys)
    points = df.select(*keys, _point(df, ts, as_list(seq)))
    sample, share = _sample(points, rows)
    most = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("__of")).agg(F.max("__of")).first()[0] or 0
    if most <= rows * share:
        return None
    widths = [rows]
    while most > widths[-1] * FAN * share:
        widths.append(widths[-1] * FAN)
    cuts = None
    for width in reversed(widths):
        cuts = _finer(points, keys, width, cuts)
    return cuts


def _finer(points: DataFrame, keys: list[str], rows: int, coarser: Cuts | None) -> Cuts | None:
    """Cuts of what has more rows than ``rows``: of keys, or of their blocks by ``coarser``."""
    sample, share = _sample(points, rows)
    if coarser:
        sample, keys = _numbered(sample, keys, coarser), [*keys, BLOCK]
    own = Window.partitionBy(*keys)
    ranked = sample.withColumns({"__n": F.row_number().over(own.orderBy(POINT)), "__of": F.count(F.lit(1)).over(own)})
    step = max(1, round(rows * share / 2))
    hot = ranked.filter((F.col("__of") > rows * share) & (F.col("__n") % step == 0))
    points = hot.groupBy(*keys).agg(F.sort_array(F.collect_set(POINT)).alias(CUTS))
    path = shared_dir(sample.sparkSession, "cuts")
    counted = Observation()
    points.observe(counted, F.sum(F.size(CUTS)).alias("all"), F.max(F.size(CUTS)).alias("longest")).write.parquet(path)
    size = counted.get
    if not size.get("all"):
        return coarser
    steps = tuple(1 << i for i in reversed(range(size["longest"].bit_length())))
    return Cuts(sample.sparkSession.read.schema(points.schema).parquet(path), size["all"] <= BROADCAST_POINTS, steps, coarser)


def with_blocks(
    df: DataFrame,
    keys: Names,
    ts: str,
    seq: Names | None = None,
    block: int | None = None,
    cuts: Cuts | None = None,
    hot_only: bool = False,
) -> DataFrame:
    """Add the time in microseconds and the number of the row's block in its key: in order of time and sequence.

    All keys get blocks of ``block`` microseconds if given; otherwise hot keys get the blocks of ``cuts``
    (``hot_only`` leaves the others out) and all others are block 0. No row is shuffled here.
    """
    rows = df.withColumn(US, position(df, ts))
    if block:
        return rows.withColumn(BLOCK, F.coalesce(F.expr(f"{US} - pmod({US}, {block}L)"), F.lit(FIRST_BLOCK)))
    if cuts is None:
        return rows.withColumn(BLOCK, F.lit(0).cast("long"))
    rows = _numbered(rows.withColumn(POINT, _point(df, ts, as_list(seq))), as_list(keys), cuts, hot_only).drop(POINT)
    return rows.withColumn(BLOCK, F.coalesce(BLOCK, F.lit(0).cast("long")))


def _numbered(rows: DataFrame, keys: list[str], cuts: Cuts, hot_only: bool = False) -> DataFrame:
    """Rows, by their point, with the number of their block; NULL for keys that are not cut."""
    if cuts.coarser is None:
        rows = join_points(rows, cuts, keys, "inner" if hot_only else "left")
    else:
        rows = join_points(_numbered(rows, keys, cuts.coarser), cuts, [*keys, BLOCK], "left")
    if isinstance(rows.schema[POINT].dataType, T.LongType):
        # Each step is a column of its own, so that the stage is compiled as a whole and copies no row's points.
        rows, found = rows.withColumn(FOUND, F.lit(0)), FOUND
        for step in cuts.steps:
            rows = rows.withColumn(FOUND, F.expr(f"{FOUND} + IF(get({CUTS}, {FOUND} + {step - 1}) <= {POINT}, {step}, 0)"))
    else:
        # Points of several columns take more code than the compiler allows a stage.
        steps = ", ".join(map(str, cuts.steps))
        found = f"aggregate(array({steps}), 0, (at, step) -> IF(get({CUTS}, at + step - 1) <= {POINT}, at + step, at))"
    first = f"{BLOCK} * {2 * cuts.steps[0]}L" if cuts.coarser else "CAST(NULL AS BIGINT)"
    rows = rows.withColumn(BLOCK, F.expr(f"IF({CUTS} IS NULL, {first}, coalesce({first}, 0L) + {found})")).drop(CUTS, FOUND)
    return rows.filter(F.col(BLOCK).isNotNull()) if hot_only and cuts.coarser else rows


def join_points(rows: DataFrame, cuts: Cuts, keys: list[str], how: str) -> DataFrame:
    """Rows with their key's cut points, by broadcast if these are few; NULL keys match."""
    renamed = cuts.points.withColumnsRenamed({k: f"__small_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & rows[k].eqNullSafe(renamed[f"__small_{k}"])
    return rows.join(F.broadcast(renamed) if cuts.small else renamed, match, how).drop(*[f"__small_{k}" for k in keys])


def with_previous(
    df: DataFrame,
    values: Mapping[str, str | Column],
    keys: Names,
    ts: str,
    seq: Names | None = None,
    block: int | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Add values of the previous row of the same key, in (ts, seq) order; NULL on the first row.

    For keys that fit a task this is one window. Otherwise each block of a hot key is given the last row of
    the key's previous block as a leading extra row, so all rows are shuffled once, by (key, block).
    ``block`` forces blocks on all keys. ``split_rows=None`` skips the sample, for input whose keys are
    known to be small (bars, for example).
    """
    keys, seq = as_list(keys), as_list(seq)
    kept = [c for c in df.columns if c not in values]
    inner = {out: f"__in_{out}" for out in values}
    given = {inner[out]: F.col(v) if isinstance(v, str) else v for out, v in values.items()}
    source = df.withColumns(given)
    cuts = None if block else plan_cuts(df, keys, ts, seq, split_rows)
    if not block and cuts is None:
        window = Window.partitionBy(*keys).orderBy(ts, *seq)
        return source.select(*kept, *[F.lag(c).over(window).alias(out) for out, c in inner.items()])
    order = [F.col(US), *[F.col(c) for c in seq]]
    rows = with_blocks(source, keys, ts, seq, block, cuts).withColumn("__own", F.lit(1))
    cut = with_blocks(source.select(*dict.fromkeys([*keys, ts, *seq]), *inner.values()), keys, ts, seq, block, cuts, hot_only=True)
    last = F.max_by(F.struct(*inner.values()), F.struct(*order)).alias("__last")
    following = F.lead(BLOCK).over(Window.partitionBy(*keys).orderBy(BLOCK))
    carried = (
        cut.groupBy(*keys, BLOCK)
        .agg(last)
        .withColumn(BLOCK, following)
        .filter(F.col(BLOCK).isNotNull())
        .select(*keys, BLOCK, "__last.*", F.lit(0).alias("__own"))
    )
    window = Window.partitionBy(*keys, BLOCK).orderBy("__own", *order)
    lagged = rows.unionByName(carried, allowMissingColumns=True).withColumns(
        {f"__out_{out}": F.lag(c).over(window) for out, c in inner.items()}
    )
    return lagged.filter("__own = 1").select(*kept, *[F.col(f"__out_{out}").alias(out) for out in inner])


def returns(df: DataFrame, close: str, keys: Names, ts: str, seq: Names | None = None, **split):
    """Previous close within the key, change and return."""
    out = with_previous(df, {"Last": close}, keys, ts, seq, **split)
    change = F.col(close) - F.col("Last")
    return out.withColumn("Chg", change).withColumn("Return", F.try_divide(F.col("Chg"), F.col("Last")))


def changed_only(
    df: DataFrame, columns: Names, keys: Names, ts: str, seq: Names | None = None, **split
) -> DataFrame:
    """Rows whose named columns differ from the key's previous row, and each key's first row."""
    names = as_list(columns)
    now = F.struct(*names)
    out = with_previous(df, {"__before": now}, keys, ts, seq, **split)
    return out.filter(~F.col("__before").eqNullSafe(now)).drop("__before")


def with_row_ids(
    df: DataFrame,
    order: Names,
    bucket: Column,
    spread: str,
    start: int = 1,
    name: str = "RequestId",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Dense ids in the given order.

    ``bucket`` is a coarse, order-preserving value of the first order column; ``spread`` is the
    column (a time or whole number) that leads the order inside a bucket, along which large buckets
    are split. Rows are numbered inside their part, which is led by a row with the count of all earlier
    rows, so all rows are shuffled once. The running count over parts is the only single-task step; it
    sees one row per part.
    """
    rows = df.withColumn("__bucket", bucket)
    cuts = plan_cuts(rows, "__bucket", spread, None, split_rows)
    rows = with_blocks(rows, "__bucket", spread, cuts=cuts).drop(US)
    part = ["__bucket", BLOCK]
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    leading = counts.select(*part, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n"), F.lit(0).alias("__own"))
    rows = rows.withColumns({"__n": F.lit(1).cast("long"), "__own": F.lit(1)}).unionByName(leading, allowMissingColumns=True)
    order = Window.partitionBy(*part).orderBy("__own", *as_list(order)).rowsBetween(Window.unboundedPreceding, 0)
    ids = (F.sum("__n").over(order) + F.lit(start - 1)).cast("long")
    numbered = rows.withColumn("__id", ids).filter("__own = 1").withColumn(name, F.col("__id"))
    return numbered.drop(*part, "__n", "__own", "__id")
