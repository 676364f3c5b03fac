"""Quality rules as a short-circuit cascade, in Spark expressions only.

Each rule says when a text fails. A bounded sample gives every rule's cost (time per row) and
selectivity (share of rows it rejects); the cascade tries rules by rejection per cost, and a text that
fails a rule is not shown to the later ones. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let

#: Rows of the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 200


def words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")


def word_chars(text: Column) -> Column:
    """Code points outside white space."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", "")).cast("long")


def symbols(text: Column) -> Column:
    """Characters of ``#*$%&|<>``."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")


def capitals(text: Column) -> Column:
    """Capital letters."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long")


def letters(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACES}]"))


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeat_words(word_list: Column) -> Column:
    """Words inside a 3-word window that the text holds twice or more.

    Every window becomes one long: a hash of its words in the high bits, its place in the low bits.
    Sorting the longs brings equal windows together; neighbours with equal hashes are then compared
    word by word. Places of repeated windows, sorted, cover 3 words each less what they share.
    """

    def of(w: Column) -> Column:
        n = F.size(w)
        bits = F.length(F.bin(n.cast("long")))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1).cast("long")

        def window(i: Column) -> Column:
            return F.xxhash64(w[i], w[i + 1], w[i + 2])

        keys = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: window(i).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")),
        )

        def repeated(s: Column) -> Column:
            def place(k: Column) -> Column:
                return k.bitwiseAND(mask).cast("int")

            def same(a: Column, b: Column) -> Column:
                high = a.bitwiseAND(F.bitwise_not(mask)) == b.bitwiseAND(F.bitwise_not(mask))
                p, q = place(a), place(b)
                return high & (w[p] == w[q]) & (w[p + 1] == w[q + 1]) & (w[p + 2] == w[q + 2])

            found = F.filter(
                s,
                lambda k, i: ((i > 0) & same(F.get(s, F.greatest(i - 1, F.lit(0))), k))
                | ((i < F.size(s) - 1) & same(F.get(s, F.least(i + 1, F.size(s) - 1)), k)),
            )
            return F.sort_array(F.transform(found, place))

        def covered(p: Column) -> Column:
            return F.aggregate(
                p,
                F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
                lambda a, x: F.struct(
                    (a["words"] + F.lit(3) - F.greatest(a["end"] - x, F.lit(0))).alias("words"), (x + 3).alias("end")
                ),
                lambda a: a["words"].cast("long"),
            )

        return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(keys), lambda s: let(repeated(s), covered)))

    return let(word_list, of)


@dataclass(frozen=True)
class Rule:
    """``fails(text, words)`` is true for a text to reject; NULL counts as false."""

    name: str
    fails: Callable[[Column, Column], Column]


def rules(
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_symbols_percent: int = 30,
    max_dup_lines_percent: int = 50,
    max_capitals_percent: int = 40,
    min_word_chars: int = 2,
    max_word_chars: int = 20,
) -> list[Rule]:
    """The rules of the library: shares of repeated words, symbols, repeated lines and capitals; sizes of text and words."""
    return [
        Rule("few_words", lambda t, w: F.size(w) < min_words),
        Rule("symbols", lambda t, w: 100 * symbols(t) > max_symbols_percent * F.size(w)),
        Rule("capitals", lambda t, w: 100 * capitals(t) > max_capitals_percent * letters(t)),
        Rule("dup_lines", lambda t, w: 100 * dup_lines(t) > max_dup_lines_percent * lines(t)),
        Rule(
            "word_size",
            lambda t, w: (word_chars(t) < min_word_chars * F.size(w)) | (word_chars(t) > max_word_chars * F.size(w)),
        ),
        Rule("repeat_words", lambda t, w: 100 * repeat_words(w) > max_repeat_percent * F.size(w)),
    ]


def order_rules(df: DataFrame, text: str = "text", of: Sequence[Rule] | None = None, rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules by falling rejection per cost, each with its share of rejected rows and seconds per row, on ``rows`` rows.

    An empty table leaves the order as given.
    """
    of = list(of or rules())
    spark = df.sparkSession
    sample = df.select(F.col(text).cast("string").alias("t")).sample(0.2, seed=7).take(rows)
    if not sample:
        return [(r, 0.0, 0.0) for r in of]
    frame = spark.createDataFrame(sample, "t string").withColumn("w", words(F.col("t"))).coalesce(1)

    def timed(fails: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = frame.agg(F.avg(F.coalesce(fails, F.lit(False)).cast("double"))).first()[0]
        return share, time.perf_counter() - start

    timed(F.size("w") > 0)  # compiles what all rules share
    idle = min(timed(F.size("w") > 0)[1] for _ in range(2))
    seen = []
    for rule in of:
        timed(rule.fails(F.col("t"), F.col("w")))
        share, seconds = timed(rule.fails(F.col("t"), F.col("w")))
        seen.append((rule, share, max(seconds - idle, 1e-4) / len(sample)))
    return sorted(seen, key=lambda x: -x[1] / x[2])


def cascade(ordered: Sequence[Rule], text: Column, word_list: Column) -> Column:
    """Name of the first rule that a text fails, NULL if none; later rules aren't evaluated then."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.fails(text, word_list), F.lit(rule.name)).otherwise(verdict)
    return verdict


def with_verdict(df: DataFrame, text: str = "text", of: Sequence[Rule] | None = None, out: str = "failed_rule") -> DataFrame:
    """``df`` with the first failed rule of each row in ``out`` (a column of that name is replaced).

    A NULL or empty text has no words and fails ``few_words``. Repeated rows get the same verdict, and
    an empty table stays empty. Which of several failed rules is named depends on the measured order;
    whether one is named does not.
    """
    ordered = [r for r, _, _ in order_rules(df, text, of)]
    return df.withColumn(out, let(words(F.col(text)), lambda w: cascade(ordered, F.col(text), w)))


def measures(df: DataFrame, key: str = "doc_id", text: str = "text", of: Sequence[Rule] | None = None) -> DataFrame:
    """Per row: the counts the rules rest on, the fixed base verdict and the cascade's verdict.

    A NULL or empty text counts 0 everywhere and fails the base verdict; a NULL key stays NULL.
    Other columns of ``df`` are left out, so their names can't clash.
    """
    ordered = [r for r, _, _ in order_rules(df, text, of)]
    frame = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("__text"))
    frame = frame.withColumn("__words", words(F.col("__text")))
    frame = frame.select(
        "doc_id",
        F.size("__words").cast("long").alias("n_words"),
        word_chars(F.col("__text")).alias("word_chars"),
        symbols(F.col("__text")).alias("n_symbols"),
        dup_lines(F.col("__text")).alias("n_dup_lines"),
        repeat_words(F.col("__words")).alias("n_repeat_words"),
        cascade([r for r in ordered if of is not None or r.name not in ("few_words", "repeat_words")], F.col("__text"), F.col("__words")).alias("__failed"),
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return frame.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & F.col("__failed").isNull()).drop("__failed")


def kept(df: DataFrame, text: str = "text", of: Sequence[Rule] | None = None) -> DataFrame:
    """Rows that no rule rejects, with all their columns."""
    name = "__failed_rule"
    return with_verdict(df, text, of, name).where(F.col(name).isNull()).drop(name)
