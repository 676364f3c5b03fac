"""Search by part of a name through an index of the names' substrings of one to three characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import Names, as_list, small_side

GRAM = "__gram"


def _grams(text: Column, length: int) -> Column:
    """Distinct substrings of a length; none of a shorter text."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    return F.when(F.length(text) >= length, F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(length))))).otherwise(F.array().cast("array<string>"))


def gram_index(rows: DataFrame, key: Names, columns: Names) -> DataFrame:
    """Posting lists: a row for each key and each substring of one, two and three characters of its lower-case columns.

    Columns are joined by line ends; NULLs are left out. An index is written once and used for any number of
    pattern tables.
    """
    text = F.lower(F.concat_ws("\n", *as_list(columns)))
    named = rows.select(*as_list(key), text.alias("__text"))
    every = F.concat(*[_grams(F.col("__text"), n) for n in (1, 2, 3)])
    return named.select(*as_list(key), F.explode(F.array_distinct(every)).alias(GRAM))


def search_indexed(rows: DataFrame, patterns: DataFrame, index: DataFrame, key: Names, columns: Names, pattern: str = "Pattern") -> DataFrame:
    """Rows whose columns contain a pattern, ignoring case: one row per match, as ``contains`` has it.

    A pattern meets the posting list of its rarest substring of three characters only (of its own length, if
    it is shorter), by an equi-join; ``contains`` then confirms. A pattern with a substring that no row
    has meets nothing. Empty and NULL patterns match nothing, repeated ones count once.
    """
    keys = as_list(key)
    wanted = patterns.select(F.col(pattern).alias("__pattern")).filter("__pattern <> ''").distinct()
    lower = F.lower("__pattern")
    own = F.when(F.length(lower) < 3, F.array(lower)).otherwise(_grams(lower, 3))
    asked = wanted.withColumn(GRAM, F.explode(own))
    # How long the lists of the asked substrings are: the index is cut down to them before it is counted.
    sizes = index.join(small_side(asked.select(GRAM).distinct()), GRAM, "left_semi").groupBy(GRAM).agg(F.count(F.lit(1)).alias("__n"))
    counted = asked.join(sizes, GRAM, "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    rarest = counted.groupBy("__pattern").agg(F.min(F.struct("__n", GRAM)).alias("__r")).filter("__r.__n > 0")
    rarest = small_side(rarest.select("__pattern", F.col(f"__r.{GRAM}").alias(GRAM)))
    candidates = index.join(rarest, GRAM).drop(GRAM).withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(F.col(f"__of_{k}"))
    found = rows.join(candidates, same).drop(*[f"__of_{k}" for k in keys])
    text = F.lower(F.concat_ws("\n", *as_list(columns)))
    return found.filter(F.contains(text, F.lower("__pattern"))).withColumnRenamed("__pattern", pattern)
