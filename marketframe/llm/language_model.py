"""Language-model scores by a weighted backoff automaton over word pairs.

States are the words that training texts hold, and the empty history. A text is read once from left to
right; behind word u the automaton is in state u. If the pair (u, v) was seen, state u has an arc v of
weight p(v) * ((1 - w) * x + w), where x is how many times likelier v is behind u than anywhere. If not,
the failure arc of weight w leads to the empty history, whose arcs weigh p(v) = (c(v) + 1) / (N + V + 1);
unknown words share the last part. What leaves a state that was seen thus weighs 1 in sum. w depends on how
often u was seen, by powers of two, and maximises the likelihood of the training tokens, each left out in
turn and counted by classes of x, a class by its mean. ``exact=False`` rounds x down to its class, a quarter
power of two.

The model grows with the corpus, so no task holds it whole. Texts are read once into blocks of word
numbers. Every block asks for the counts of its own words and pairs: sorted hashes go to reducers by
hash range, which add up all blocks' counts and answer each block in its own order. A block's answers
make the part of the automaton that its texts walk through. Words are known by 64-bit hashes, pairs by
64-bit hashes of those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder, shipped, written
from .hashing import lower_words, scrambled

#: Tokens of a block, about: what one task holds.
BLOCK_TOKENS = 2_000_000
#: Classes of a state's count (powers of two) and of x (0: pair not seen; else quarter powers of two from 2**-8).
CLASSES, RATIOS, LOWEST = 48, 160, -32
END_WORD = b""


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte place by byte place, so that high bytes that are mostly zero compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _numbers(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data, np.uint64), dtype=np.uint64)


def blocks(df: DataFrame, key: str, text: str, held_out: Column, size: int = BLOCK_TOKENS) -> DataFrame:
    """Texts as blocks of word numbers: ids, held-out marks and token counts of the texts, tokens and word hashes."""
    source = shipped(df).select(F.col(key).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("__text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        words: dict[bytes, int] = {END_WORD: 0}
        ids, held, sizes, parts, total = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
            row = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays([0, sum(map(len, ids))], pa.concat_arrays(ids)),
                pa.ListArray.from_arrays([0, sum(map(len, held))], pa.concat_arrays(held)),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([_planes(np.concatenate(parts))], pa.binary()),
                pa.array([hashes.tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, ["block", "ids", "held", "sizes", "tokens", "words"])

        for batch in batches:
            start = 0
            for i, value in enumerate(batch.column(2)):
                found = lower_words(value.as_py())
                found.append(END_WORD)
                parts.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
                sizes.append(len(found))
                total += len(found)
                if total >= size:
                    ids.append(batch.column(0)[start : i + 1])
                    held.append(batch.column(1)[start : i + 1])
                    yield block()
                    start, number, words = i + 1, number + 1, {END_WORD: 0}
                    ids, held, sizes, parts, total = [], [], [], [], 0
            if start < len(batch):
                ids.append(batch.column(0)[start:])
                held.append(batch.column(1)[start:])
        if sizes:
            yield block()

    schema = f"block long, ids array<{kind}>, held array<boolean>, sizes array<int>, tokens binary, words binary"
    return source.mapInArrow(run, schema)


class Block:
    """Words and pairs of one block's row, numbered and in the order of their hashes."""

    def __init__(self, row: dict):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.tokens = _numbers(row["tokens"], np.uint32).astype(np.int64)
        self.hashes = np.frombuffer(row["words"], np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(~self.held, self.sizes)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.starts] = 0
        self.word_order = np.argsort(self.hashes)
        self.word_counts = np.bincount(self.tokens[self.train], minlength=len(self.hashes))
        # A pair's number times 2, plus 1 where the text is one to learn from: one sort counts both.
        n = len(self.hashes)
        self.codes = self.before * n + self.tokens
        marked, times = np.unique(self.codes << 1 | self.train, return_counts=True)
        self.pairs, first = np.unique(marked >> 1, return_index=True)
        self.pair_counts = np.add.reduceat(times * (marked & 1), first) if len(first) else times
        self.first, self.second = np.divmod(self.pairs, n)
        self.pair_keys = scrambled(self.hashes[self.first] * np.uint64(0x9E3779B97F4A7C15) + scrambled(self.hashes[self.second]))
        self.pair_order = np.argsort(self.pair_keys)


def _asked(kind: int, block: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> list[tuple]:
    """Rows (kind, range, block, keys, counts), one a range; keys are sorted."""
    place = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(ranges + 1, dtype=np.uint64))
    counts = counts.astype(np.uint32)
    return [(kind, r, block, _packed_keys(keys[a:b]), _planes(counts[a:b])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


ASKED = "kind int, range int, block long, keys binary, counts binary"


def _as_batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 64):
        part = rows[at : at + 64]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def questions(whole: DataFrame, ranges: int) -> DataFrame:
    """What every block asks for and adds: hashes and training counts of its words (kind 0) and pairs (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                rows = _asked(0, row["block"], b.hashes[b.word_order], b.word_counts[b.word_order], max(1, ranges // 6))
                rows += _asked(1, row["block"], b.pair_keys[b.pair_order], b.pair_counts[b.pair_order], ranges)
                del b
                yield from _as_batches(rows, schema)

    return whole.mapInArrow(run, ASKED)


ANSWERED = "block long, kind int, range int, totals binary, n_tokens long, n_words long"


def answers(asked: DataFrame) -> DataFrame:
    """Corpus counts for every question, in the question's order, and the sums over all words of a range (in one row)."""

    def total(group: pa.Table) -> pa.Table:
        kind, place = group.column("kind")[0].as_py(), group.column("range")[0].as_py()
        keys = [_unpacked_keys(k.as_py()) for k in group.column("keys")]
        counts = np.concatenate([_numbers(c.as_py(), np.uint32) for c in group.column("counts")]).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        fresh = np.empty(len(every), bool)
        fresh[:1], fresh[1:] = True, every[order][1:] != every[order][:-1]
        sums = np.add.reduceat(counts[order], np.flatnonzero(fresh))
        back = np.empty(len(every), np.int64)
        back[order] = sums[np.cumsum(fresh) - 1]
        found = [_planes(part.astype(np.uint32)) for part in np.split(back, ends[:-1])]
        n = len(found)
        first = [int(sums.sum()), int((sums > 0).sum())] if kind == 0 else [0, 0]
        return pa.table(
            {
                "block": group.column("block"),
                "kind": pa.array([kind] * n, pa.int32()),
                "range": pa.array([place] * n, pa.int32()),
                "totals": pa.array(found, pa.binary()),
                "n_tokens": pa.array([first[0]] + [0] * (n - 1), pa.int64()),
                "n_words": pa.array([first[1]] + [0] * (n - 1), pa.int64()),
            }
        )

    return asked.groupBy("kind", "range").applyInArrow(total, ANSWERED)


def _class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(np.maximum(count, 1).astype(float))[1] - 1, CLASSES - 1)


def _ratio(pair: np.ndarray, state: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Class of x = (pair / state) / p; 0 if the pair was not seen."""
    seen = (pair > 0) & (state > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.floor(4 * np.log2(pair / (state * p)))
    return np.where(seen, np.clip(np.where(seen, x, 0) - LOWEST + 1, 1, RATIOS - 1), 0).astype(np.int64)


def ratios() -> np.ndarray:
    """x by its class."""
    x = 2.0 ** ((np.arange(RATIOS) - 1 + LOWEST) / 4)
    x[0] = 0
    return x


def walks(whole: DataFrame, answered: DataFrame, n: int, v: int, exact: bool = False) -> DataFrame:
    """Per text what its walk through the automaton meets; a row without sizes per block has what a text less would meet.

    ``states`` (classes of their counts) and ``x`` are those of a text's tokens, in order; tokens behind an
    unknown word, whose failure arc weighs 1, are in neither. What a text less would meet is summed up by
    class of (state count, x): ``arcs``, ``times`` each was met and ``sums`` of x.
    """
    kind = whole.schema["ids"].dataType.elementType.simpleString()
    norm = n + v + 1

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left.to_pylist()[0])
        found = sorted(right.select(["kind", "range", "totals"]).to_pylist(), key=lambda r: (r["kind"], r["range"]))
        words, pairs = (np.concatenate([_numbers(r["totals"], np.uint32) for r in found if r["kind"] == k]).astype(np.int64) for k in (0, 1))
        count = np.empty(len(words), np.int64)
        count[b.word_order] = words
        together = np.empty(len(pairs), np.int64)
        together[b.pair_order] = pairs
        p = (count + 1) / norm
        state, p_second = count[b.first], p[b.second]

        def arc(pair: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            kind = _ratio(pair, state, p_second)
            x = np.maximum(pair, 0) / (np.maximum(state, 1) * p_second) if exact else ratios()[kind]
            return np.where(state > 0, _class(state) * RATIOS + kind, -1), x

        arcs, x = arc(together, state)
        # Training tokens, each left out: their pair and state count one less.
        less, x_less = arc(together - 1, state - 1)
        learnt = (less >= 0) & (b.pair_counts > 0)
        left_out = np.bincount(less[learnt], weights=b.pair_counts[learnt], minlength=CLASSES * RATIOS).astype(np.int64)
        x_sums = np.bincount(less[learnt], weights=b.pair_counts[learnt] * x_less[learnt], minlength=CLASSES * RATIOS)
        met = np.searchsorted(b.pairs, b.codes)
        seen = arcs[met] >= 0
        met = met[seen]
        ends = np.append(0, np.cumsum(np.add.reduceat(seen.astype(np.int64), b.starts)))
        tokens = pa.array(np.append(ends, ends[-1]), pa.int32())
        logs = np.add.reduceat(np.log10(count[b.tokens] + 1.0), b.starts)
        known = np.add.reduceat((count[b.tokens] > 0).astype(np.int64), b.starts)
        cells = np.flatnonzero(left_out)
        offsets = pa.array([0] * (len(b.sizes) + 1) + [len(cells)], pa.int32())
        none = pa.nulls(1, pa.int64())
        return pa.table(
            {
                "doc_id": pa.concat_arrays([left.column("ids").combine_chunks().values, pa.nulls(1, left.schema.field("ids").type.value_type)]),
                "held_out": pa.array([*b.held.tolist(), None], pa.bool_()),
                "n_tokens": pa.concat_arrays([pa.array(b.sizes), none]),
                "n_known": pa.concat_arrays([pa.array(known), none]),
                "logs": pa.array([*logs.tolist(), None], pa.float64()),
                "states": pa.ListArray.from_arrays(tokens, pa.array((arcs // RATIOS)[met], pa.int8())),
                "x": pa.ListArray.from_arrays(tokens, pa.array(x[met])),
                "arcs": pa.ListArray.from_arrays(offsets, pa.array(cells, pa.int32())),
                "times": pa.ListArray.from_arrays(offsets, pa.array(left_out[cells])),
                "sums": pa.ListArray.from_arrays(offsets, pa.array(x_sums[cells], pa.float64())),
            }
        )

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, states array<tinyint>, x array<double>, arcs array<int>, times array<long>, sums array<double>"
    return whole.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(walk, schema)


def failure_weights(met: np.ndarray, means: np.ndarray | None = None) -> np.ndarray:
    """By class of state count, the weight w that is likeliest for tokens left out (``met``: how many by class of x).

    ``means`` are the x of the classes, those rounded down by default. The likelihood is concave in w; its slope's
    zero is found by halving. Classes without tokens take the next one's.
    """
    means = np.broadcast_to(ratios(), met.shape) if means is None else means
    out = np.full(CLASSES, 0.5)
    for c in reversed(range(CLASSES)):
        times, x = met[c], means[c]
        if not times.sum():
            out[c] = out[c + 1] if c + 1 < CLASSES else 0.5
            continue
        low, high = 1e-4, 1 - 1e-4
        for _ in range(50):
            w = (low + high) / 2
            low, high = (w, high) if (times * (1 - x) / ((1 - w) * x + w)).sum() > 0 else (low, w)
        out[c] = (low + high) / 2
    return out


def scored(df: DataFrame, key: str = "doc_id", text: str = "text", held_out: Column | None = None, block_tokens: int = BLOCK_TOKENS, exact: bool = False) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    The model learns from rows for which ``held_out`` is not true (none held out by default). A NULL or
    empty text is the end token alone. A NULL key stays NULL, repeated rows count as often as they
    stand there and score alike, and other columns are left out. Without rows to learn from every
    token is unknown; an empty table gives no rows. With ``exact`` arcs weigh what they should; without,
    their x is rounded down to a quarter power of two, so scores fall short by up to 0.075 a token.
    """
    spark = df.sparkSession
    whole = written(blocks(df, key, text, held_out if held_out is not None else F.lit(False), block_tokens), "blocks")
    ranges = max(4, whole.count())
    # One group of questions to a partition, as far as hashing deals them out: a block's worth of counts each.
    answered = written(answers(questions(whole, ranges)), "answers")
    n, v = (int(x or 0) for x in answered.agg(F.sum("n_tokens"), F.sum("n_words")).first())
    met = written(walks(whole, answered.drop("n_tokens", "n_words"), n, v, exact), "walks")
    left_out, sums = np.zeros((2, CLASSES * RATIOS))
    cells = F.explode(F.arrays_zip("arcs", "times", "sums")).alias("c")
    for r in met.where(F.col("n_tokens").isNull()).select(cells).groupBy("c.arcs").agg(F.sum("c.times").alias("n"), F.sum("c.sums").alias("x")).collect():
        left_out[r["arcs"]], sums[r["arcs"]] = r["n"], r["x"]
    w = failure_weights(left_out.reshape(CLASSES, RATIOS), (sums / np.maximum(left_out, 1)).reshape(CLASSES, RATIOS))
    norm = math.log10(n + v + 1)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, logs = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            states, x = batch.column(5), batch.column(6)
            text = np.repeat(np.arange(len(size)), states.value_lengths().to_numpy())
            fails = w[states.flatten().to_numpy()]
            sums = np.bincount(text, weights=np.log10((1 - fails) * x.flatten().to_numpy() + fails), minlength=len(size))
            base = logs - size * norm
            columns = [*(batch.column(i) for i in range(4)), pa.array(np.full(len(size), n)), pa.array(base), pa.array(base + sums)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = met.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return met.where(F.col("n_tokens").isNotNull()).drop("arcs", "times", "sums").mapInArrow(weigh, schema)


def held_out_rows(key: str = "doc_id", n: int = 7, left: int = 2) -> Column:
    """Rows whose key's crc32 leaves ``left`` modulo ``n``."""
    return F.coalesce(remainder(key, n) == left, F.lit(False))
