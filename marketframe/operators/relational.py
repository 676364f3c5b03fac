"""Joins, last/first rows, sums and column helpers over whole tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..session import shared_dir

Names = str | Sequence[str]

PARTS = 256


def as_list(names: Names | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def renames(specs: Names | None) -> dict[str, str]:
    """``["New=Old", "Same"]`` as ``{"New": "Old", "Same": "Same"}``."""
    pairs = (spec.partition("=") for spec in as_list(specs))
    return {new.strip(): (old or new).strip() for new, _, old in pairs}


def where(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows for which every condition holds."""
    for condition in conditions:
        df = df.filter(condition)
    return df


def view(df: DataFrame, columns: Mapping[str, Column] | Sequence[str | Column]) -> DataFrame:
    """Project: names, ``New=Old`` specs, aliased columns, or a mapping of name to expression."""
    if isinstance(columns, Mapping):
        return df.select(*[expr.alias(name) for name, expr in columns.items()])
    out = []
    for c in columns:
        if isinstance(c, str):
            ((new, old),) = renames(c).items()
            c = F.col(old).alias(new)
        out.append(c)
    return df.select(*out)


def update(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in order; later expressions see earlier ones."""
    for name, expr in columns.items():
        df = df.withColumn(name, expr)
    return df


def rename(df: DataFrame, specs: Names) -> DataFrame:
    """Rename by ``New=Old`` specs."""
    return df.withColumnsRenamed({old: new for new, old in renames(specs).items()})


def move_up(df: DataFrame, columns: Names) -> DataFrame:
    """The named columns first, the others behind in their order."""
    first = as_list(columns)
    return df.select(*first, *[c for c in df.columns if c not in first])


def assert_unique_columns(df: DataFrame) -> DataFrame:
    repeated = [name for name, n in Counter(df.columns).items() if n > 1]
    if repeated:
        raise ValueError(f"Duplicate column names: {','.join(repeated)}")
    return df


def at_most_one_row_per_key(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The frame, failing at run time if a key repeats.

    The check is a scalar subquery over the keys alone, counted before the shuffle. It leaves the
    join itself a plain equi-join, which AQE may still broadcast or split where a key is hot.
    """
    top = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).scalar()
    message = F.lit(f"Duplicate right keys: {','.join(on)}")
    return df.filter(F.when(top > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def natural_join(
    left: DataFrame,
    right: DataFrame,
    on: Names,
    joins: Names | None = None,
    validate: bool = True,
    null_safe: bool = True,
) -> DataFrame:
    """Every left row once, with the columns of its 0 or 1 right match (NULL without one).

    ``null_safe=False`` is for right keys that are never NULL: plain equality then, which can use rows
    that are already partitioned by the keys and leaves them partitioned so.

    ``joins`` picks right columns as ``New=Old`` (all but the keys by default); NULL keys match.
    Repeated right keys are an error; ``validate=False`` skips the check where the right side is
    unique by construction. With no keys the right side's only row goes to every left row.
    """
    keys = as_list(on)
    picked = renames(joins) if joins is not None else {c: c for c in right.columns if c not in keys}
    clash = [c for c in picked if c in left.columns]
    if clash:
        raise ValueError(f"Duplicate column names: {','.join(clash)}")
    if not keys:
        return _attach_single_row(left, right, picked)

    right = right.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        *[F.col(old).alias(new) for new, old in picked.items()],
    )
    right_keys = [f"__key_{k}" for k in keys]
    if validate:
        right = at_most_one_row_per_key(right, right_keys)
    match = F.lit(True)
    for k, rk in zip(keys, right_keys):
        match = match & (left[k].eqNullSafe(right[rk]) if null_safe else left[k] == right[rk])
    return left.join(right, match, "left").drop(*right_keys)


def _attach_single_row(left: DataFrame, right: DataFrame, picked: Mapping[str, str]) -> DataFrame:
    """A global aggregate always has one row; as a scalar subquery it needs no join at all."""
    row = F.struct(*[F.col(old).alias(new) for new, old in picked.items()])
    several = F.raise_error(F.lit("Keyless join: the right table has more than one row"))
    only = right.agg(F.count(F.lit(1)).alias("n"), F.first(row).alias("row")).select(
        F.when(F.col("n") > 1, several.cast(_struct_type(right, picked))).otherwise(F.col("row"))
    )
    return left.withColumn("__row", only.scalar()).select(
        *left.columns, *[F.col(f"__row.{name}").alias(name) for name in picked]
    )


def _struct_type(df: DataFrame, picked: Mapping[str, str]) -> T.StructType:
    return T.StructType([T.StructField(new, df.schema[old].dataType) for new, old in picked.items()])


def join(left: DataFrame, right: DataFrame, on: Names, joins: Names | None = None) -> DataFrame:
    """Inner many-to-many equi-join with the same column picking as :func:`natural_join`."""
    keys = as_list(on)
    picked = renames(joins) if joins is not None else {c: c for c in right.columns if c not in keys}
    right = right.select(*keys, *[F.col(old).alias(new) for new, old in picked.items()])
    return left.join(right, keys, "inner").select(*left.columns, *picked)


def _edge_by(df: DataFrame, keys: Names, order: Names, last: bool) -> DataFrame:
    # Null placement mirrors the direction, so a NULL order value counts as earliest both ways.
    direction = "desc_nulls_last" if last else "asc_nulls_first"
    ordering = [getattr(F.col(c), direction)() for c in as_list(order)]
    window = Window.partitionBy(*as_list(keys)).orderBy(*ordering)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def last_by(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """Last row per key. The rank filter runs before the shuffle too (WindowGroupLimit), so each
    task sends one row per key and a hot key costs no more than any other."""
    return _edge_by(df, keys, order, last=True)


def first_by(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """First row per key."""
    return _edge_by(df, keys, order, last=False)


def top_by(df: DataFrame, keys: Names, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key in the given order, limited before the shuffle as well.

    Spark limits window groups early only up to a threshold; beyond it the rows of a key are cut
    down in ``PARTS`` random parts first, so a hot key still does not reach one task whole.
    """
    keys = as_list(keys)

    def limited(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        ranked = rows.withColumn("__rank", F.row_number().over(window))
        return ranked.filter(F.col("__rank") <= n).drop("__rank")

    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = df.withColumn("__part", F.pmod(F.xxhash64(*hashable(df)), F.lit(PARTS)))
        df = limited(parts, [*keys, "__part"]).drop("__part")
    return limited(df, keys)


def hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def last_by_agg(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """Last row per key as one aggregate: the form a streaming query can keep current."""
    keys = as_list(keys)
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*as_list(order)))
    return df.groupBy(*keys).agg(latest.alias("__row")).select(*keys, "__row.*").select(*df.columns)


def select_distinct(df: DataFrame, columns: Names) -> DataFrame:
    return df.select(*as_list(columns)).distinct()


def sum_by(df: DataFrame, keys: Names | None = None) -> DataFrame:
    """Sum of every remaining column per key, or over the whole table without keys."""
    keys = as_list(keys)
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c not in keys])


def constituent(df: DataFrame, key: str, value) -> DataFrame:
    """The part of a keyed table with one key value."""
    return df.filter(F.col(key) == F.lit(value))


def ungroup(df: DataFrame, column: str) -> DataFrame:
    """One row per array element, in place of the array."""
    return df.withColumn(column, F.explode(column))


def expect_min_rows(df: DataFrame, name: str, n: int = 1) -> DataFrame:
    """Raise unless the frame has at least ``n`` rows; reads no further than it needs to."""
    found = df.limit(n).count()
    if found < n:
        raise ValueError(f'Table "{name}" has {found} rows (expected {n})')
    return df


def audit_types(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Per column, how many non-NULL values do not fit the expected type: one row per column."""
    bad = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
        for c, t in expected.items()
    ]
    entry = [
        F.struct(F.lit(c).alias("ColumnName"), F.lit(t).alias("ColumnType"), F.col(c).alias("Mismatches"))
        for c, t in expected.items()
    ]
    return df.agg(*bad).select(F.inline(F.array(*entry)))


def small_side(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` written once to the shared folder, and marked for broadcasting if its counted rows are few."""
    path = shared_dir(df.sparkSession, "side")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return F.broadcast(stored) if stored.count() <= rows else stored


def new_keys_only(candidates: DataFrame, known: DataFrame, on: Names) -> DataFrame:
    """Each key not seen before, once; a NULL key is known if a known key is NULL."""
    keys = as_list(on)
    return without_keys(candidates.select(*keys).distinct(), known, keys)


def without_keys(rows: DataFrame, known: DataFrame, on: Names) -> DataFrame:
    """Rows whose keys are not among the known ones; NULL keys match."""
    keys = as_list(on)
    known = known.select(*[F.col(k).alias(f"__known_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(known[f"__known_{k}"])
    return rows.join(known, same, "left_anti")
