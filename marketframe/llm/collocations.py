"""Word collocations of each language, counted in suffix subtrees that are built independently.

Every place of a text starts a suffix. The suffixes are parted vertically: prefixes of words are grouped
so that a group's suffixes fit a budget, and a prefix that doesn't fit alone is extended by a word. Each
group then becomes a suffix tree that is cut off at four words: its suffixes, sorted, are the leaves, and a
phrase's count is the total of the leaves under its node.

A phrase can't be more frequent than its words and word pairs, so suffixes end before the first rare word
and the first rare pair. Both are looked up in bitmaps of fixed size: a false hit there costs a row and
changes no count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import top_by
from .common import shipped, written
from .hashing import scrambled

#: Words of a phrase at most.
DEPTH = 4
#: What the result's contract calls a candidate, and when a longer one drops it.
LEAST, DROP_PERCENT, SCALE = 30, 80, 2_000_000
#: Characters that end pieces become line ends and tabs become blanks; a piece's end is then the word "\n".
ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``budget``: suffixes of a group, about. ``chunk_chars``: text that a task looks at at a time.

    ``word_bits`` and ``pair_bits`` are the sizes of the bitmaps of frequent words and pairs.
    """

    budget: int = 1_000_000
    chunk_chars: int = 8_000_000
    word_bits: int = 1 << 24
    pair_bits: int = 1 << 26
    least: int = LEAST


def chunks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[str, list[bytes]]]:
    """(language, its texts' words and piece ends) of some texts at a time; NULL texts are left out, a NULL language is ``und``."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def flushed():
        for lang, texts in held.items():
            joined = b"\n".join(texts).lower().translate(ENDS)
            yield lang, joined.replace(b"\n", b" \n ").split(b" ")
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                held.setdefault("und" if lang is None else lang, []).append(text.encode())
                size += len(text)
            if size >= chars:
                yield from flushed()
                size = 0
    yield from flushed()


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh32_intdigest(lang))


def texts_of(df: DataFrame, text: str, lang: str) -> DataFrame:
    return shipped(df).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))


def word_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """lang, word, its hash and n, its occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, parts in chunks(batches, settings.chunk_chars):
            counts = Counter(parts)
            del counts[b""], counts[b"\n"]
            if counts:
                words = list(counts)
                hashes = np.fromiter((word_hash(lang, w) for w in words), np.uint64, len(words)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), pa.array([w.decode() for w in words]), pa.array(hashes), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "word", "hash", "n"],
                )

    found = texts.mapInArrow(counted, "lang string, word string, hash long, n long")
    return found.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))


def bitmap(hashes: Column, df: DataFrame, bits: int) -> np.ndarray:
    """Bits that say which remainders by ``bits`` some hashes have: the driver gets this many bits, however many hashes there are."""
    rows = df.select((F.pmod(hashes, F.lit(bits)) + 1).alias("b")).groupBy(F.expr("bitmap_bucket_number(b)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(b))").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.collect():
        at = (r["bucket"] - 1) * 4096
        part = np.frombuffer(r["bits"], np.uint8)[: len(out) - at]
        out[at : at + len(part)] = part
    return out


def has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % np.uint64(len(bits) * 8)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Coded(dict):
    """Numbers of a chunk's frequent words, in the order met; rare words and piece ends are -1, the blanks' empty words -2."""

    def __init__(self, lang: str, frequent: np.ndarray):
        super().__init__({b"": -2, b"\n": -1})
        self.lang, self.bits, self.size, self.words, self.hashes = lang, frequent, len(frequent) * 8, [], []

    def __missing__(self, word: bytes) -> int:
        h = word_hash(self.lang, word)
        at = h % self.size
        code = -1
        if self.bits[at >> 3] >> (at & 7) & 1:
            code = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
        self[word] = code
        return code


def coded(lang: str, parts: list[bytes], frequent: np.ndarray) -> tuple[Coded, np.ndarray, np.ndarray]:
    """The chunk's words, the hashes by code and the codes in order, with an end behind the last."""
    words = Coded(lang, frequent)
    codes = np.fromiter(map(words.__getitem__, parts), np.int32, len(parts))
    codes = np.append(codes[codes != -2], np.full(DEPTH, -1, np.int32))
    return words, np.array(words.hashes, np.uint64), codes


def pair_hashes(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return scrambled(hashes[a] * FACTOR + hashes[b])


def pair_counts(texts: DataFrame, frequent: np.ndarray, settings: Settings) -> DataFrame:
    """hash, n of the pairs of neighbouring frequent words; pairs of one hash count together, so n is never too small."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, parts in chunks(batches, settings.chunk_chars):
            _, hashes, codes = coded(lang, parts, frequent)
            first = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
            if len(first):
                found, n = np.unique(pair_hashes(hashes, codes[first], codes[first + 1]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["hash", "n"])

    return texts.mapInArrow(counted, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Groups:
    """Which group a suffix belongs to. A word of more than the budget has groups of its own, over which its longer prefixes go."""

    of_bin: np.ndarray
    heavy: dict[tuple[str, str], tuple[int, int]]

    def of(self, lang: str, words: Coded, hashes: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The groups of suffixes (rows of codes, -1 behind the end), and the lengths of their prefixes."""
        own = [self.heavy.get((lang, w.decode())) for w in words.words]
        heavy = np.array([o is not None for o in own] + [False])
        base, count = (np.array([o[i] if o else i for o in own] + [i], np.uint64) for i in range(2))
        known = np.append(hashes, np.uint64(0))
        prefix = known[suffixes[:, 0]]
        length = np.ones(len(suffixes), np.int32)
        going = heavy[suffixes[:, 0]]
        for i in range(1, DEPTH):
            # A prefix ends with its first word that fits the budget, as it is no more frequent than that.
            prefix = np.where(going, scrambled(prefix * FACTOR + known[suffixes[:, i]]), prefix)
            length += going
            going = going & heavy[suffixes[:, i]]
        first = suffixes[:, 0]
        light = self.of_bin[(known[first] % np.uint64(len(self.of_bin))).astype(np.int64)]
        return np.where(heavy[first], (base[first] + prefix % count[first]).astype(np.int64), light), length


def grouped(counts: DataFrame, settings: Settings) -> Groups:
    """Groups of about ``settings.budget`` suffixes from the counts of frequent words.

    Light words lie in bins by their hash, four to a group, so the plan's size follows the number of
    groups; heavy words are at most as many as groups.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    bins = max(64, 4 * -(-total // settings.budget))
    light = counts.where(F.col("n") <= settings.budget)
    # The hash is unsigned: its high half first, so that the remainder is that of an unsigned number.
    high, low = F.shiftrightunsigned("hash", 32), F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF))
    rest = ((high % bins) * (2**32 % bins) + low) % bins
    sums = np.zeros(bins, np.int64)
    for r in light.groupBy(rest.alias("bin")).agg(F.sum("n").alias("n")).collect():
        sums[r["bin"]] = r["n"]
    of_bin = np.cumsum(sums) // settings.budget
    free = int(of_bin[-1]) + 1
    heavy = {}
    for r in counts.where(F.col("n") > settings.budget).orderBy("lang", "word").collect():
        own = -(-r["n"] // settings.budget)
        heavy[r["lang"], r["word"]] = (free, own)
        free += own
    return Groups(of_bin, heavy)


SUFFIX = "lang string, group long, prefix int, " + ", ".join(f"w{i} string" for i in range(1, DEPTH + 1)) + ", n long"


def suffixes(texts: DataFrame, frequent: np.ndarray, pairs: np.ndarray, groups: Groups, settings: Settings) -> DataFrame:
    """Suffixes of at least two words, ended after four or before the first rare word or pair; equal ones of a chunk are one row."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, parts in chunks(batches, settings.chunk_chars):
            words, hashes, codes = coded(lang, parts, frequent)
            goes_on = np.zeros(len(codes), bool)
            first = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
            if not len(first):
                continue
            goes_on[first] = has(pairs, pair_hashes(hashes, codes[first], codes[first + 1]))
            start = np.flatnonzero(goes_on)
            rows = np.full((len(start), DEPTH), -1, np.int64)
            here = np.ones(len(start), bool)
            for i in range(DEPTH):
                rows[here, i] = codes[start[here] + i]
                here &= goes_on[start + i]
            # Sorted by two numbers of two words each.
            left, right = (rows[:, 0] << 32) + rows[:, 1] + 1, ((rows[:, 2] + 1) << 32) + rows[:, 3] + 1
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            new = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])) if len(start) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(start)))
            rows = rows[order[at]]
            group, length = groups.of(lang, words, hashes, rows)
            spelt = pa.array([w.decode() for w in words.words], pa.string())
            columns = [spelt.take(pa.array(np.maximum(rows[:, i], 0), mask=rows[:, i] < 0)) for i in range(DEPTH)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(group), pa.array(length), *columns, pa.array(n)], [f.split()[0] for f in SUFFIX.split(", ")])

    return texts.mapInArrow(found, SUFFIX)


def subtree(table: pa.Table, least: int) -> pa.Table:
    """Nodes of two words and more of one group's suffix tree: lang, phrase, n.

    Under nodes of fewer words than the prefix other groups have leaves too; such nodes come whatever their
    count, all others from ``least`` on.
    """
    codes, spelt = [], []
    for name in ("lang", *(f"w{i}" for i in range(1, DEPTH + 1))):
        column = table.column(name).combine_chunks()
        column = column.dictionary_encode() if isinstance(column, pa.Array) else column.combine_chunks().dictionary_encode()
        codes.append(column.indices.fill_null(-1).to_numpy(zero_copy_only=False))
        spelt.append(column.dictionary)
    n, prefix = table.column("n").to_numpy(), table.column("prefix").to_numpy()
    order = np.lexsort(codes[::-1])
    codes, n, prefix = [c[order] for c in codes], n[order], prefix[order]
    new = np.append(True, (codes[0][1:] != codes[0][:-1]) | (codes[1][1:] != codes[1][:-1]))
    out = []
    for depth in range(2, DEPTH + 1):
        new[1:] |= codes[depth][1:] != codes[depth][:-1]
        at = np.flatnonzero(new)
        totals = np.add.reduceat(n, at)
        keep = (codes[depth][at] >= 0) & ((totals >= least) | (prefix[at] > depth))
        at = at[keep]
        words = [spelt[i].take(pa.array(codes[i][at])) for i in range(1, depth + 1)]
        phrases = pa.compute.binary_join_element_wise(*words, " ")
        out.append(pa.table({"lang": spelt[0].take(pa.array(codes[0][at])), "phrase": phrases, "n": totals[keep]}))
    return pa.concat_tables(out)


def phrase_counts(texts: DataFrame, words: DataFrame, settings: Settings) -> DataFrame:
    """lang, phrase, n of all phrases of 2 to 4 words that occur ``settings.least`` times; ``words`` are the counts of words."""
    often = words.where(F.col("n") >= settings.least)
    frequent = bitmap(F.col("hash"), often, settings.word_bits)
    pairs = pair_counts(texts, frequent, settings).where(F.col("n") >= settings.least)
    in_pairs = bitmap(F.col("hash"), pairs, settings.pair_bits)
    leaves = suffixes(texts, frequent, in_pairs, grouped(often, settings), settings)
    least = settings.least
    nodes = leaves.groupBy("group").applyInArrow(lambda t: subtree(t, least), "lang string, phrase string, n long")
    return nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def part(words: str, start: str, size: str) -> Column:
    return F.expr(f"array_join(slice({words}, {start}, {size}), ' ')")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with the lowest-scoring cut: lang, phrase, a, l, r, score. Exact: products are decimals of 38 digits."""
    parts = phrases.select("lang", "phrase", "n").unionByName(words.select("lang", F.col("word").alias("phrase"), "n"))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part("w", "1", "k").alias("left"), part("w", "k + 1", "size(w) - k").alias("right"))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr(f"cast(cast(a AS decimal(20, 0)) * {SCALE} div (cast(l AS decimal(20, 0)) + r) AS long)")
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def without_parts(candidates: DataFrame) -> DataFrame:
    """Candidates that don't lie in a longer one of at least 80 % of their count."""
    longer = candidates.select("lang", "a", F.split("phrase", " ").alias("w")).where(F.size("w") > 2)
    inside = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    longest = longer.select("lang", F.explode(F.array_distinct(inside)).alias("phrase"), F.col("a").alias("f")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    joined = candidates.join(longest, ["lang", "phrase"], "left")
    drop = F.expr(f"coalesce(cast(f AS decimal(20, 0)) * 100 >= cast(a AS decimal(20, 0)) * {DROP_PERCENT}, false)")
    return joined.where(~drop).drop("f")


def collocations(df: DataFrame, top: int = 2000, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A NULL language is ``und``, a NULL text is empty. Repeated rows count as often as they stand. Ties are
    ordered by count, then by the phrase's bytes. Other columns are left out; an empty table gives no rows,
    and so does a language without a candidate.
    """
    texts = texts_of(df, text, lang)
    words = written(word_counts(texts, settings), "words")
    phrases = written(phrase_counts(texts, words, settings), "phrases")
    kept = without_parts(written(scored(phrases, words), "scored"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = top_by(kept, "lang", order, top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
