"""Quality classifier: logistic regression on hashed 1-grams and 2-grams of words and word shapes, trained by follow the regularised leader.

Training runs on a bounded sample of labelled rows, featurised where they lie and then passed once or
a few times through one task in a fixed order. The model is one array of weights, ``2 ** bits`` floats
whatever the data's size; scoring is a sparse dot product per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .caching import Recent, held, returned
from .common import batch_rows, remainder, shipped

_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")
#: Labelled rows to learn from at most; those with the smallest hashes of their keys are taken.
TRAIN_ROWS = 12_000
#: Rows of a batch that training hands a Python task at once.
BATCH_ROWS = 1000


@dataclass(frozen=True)
class Settings:
    """Model size and the parameters of the updates."""

    bits: int = 18
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.01
    passes: int = 3
    train_rows: int = TRAIN_ROWS


def shape(word: bytes) -> bytes:
    """A word with its runs of capitals, other letters and digits each as one character; other characters stay."""
    text = _DIGITS.sub("0", word.decode("utf-8", "replace"))
    return _LETTERS.sub(lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a", text).encode()


def _hashes() -> tuple[Recent, Recent]:
    """64-bit hashes of recent words and of their shapes, one table each for a worker process."""

    def make() -> tuple[Recent, Recent]:
        return Recent(xxhash.xxh3_64_intdigest, 150_000), Recent(lambda w: xxhash.xxh3_64_intdigest(shape(w), seed=1), 150_000)

    return held("words and shapes", make)


def features(text: str | None, bits: int) -> np.ndarray:
    """Hashed places of the 1-grams and 2-grams of a text's words and of their shapes, repeated as they repeat.

    A word that follows itself is the same 2-gram whatever the word.
    """
    words = text.encode().split() if text else []
    found = []
    for salt, known in enumerate(_hashes()):
        h = np.fromiter((known[w] for w in words), np.uint64, len(words))
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        if not salt:
            pairs[h[:-1] == h[1:]] = np.uint64(0xC2B2AE3D27D4EB4F)
        found += [h, pairs]
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def _scale(n: int) -> float:
    return 1.0 / np.sqrt(max(n, 1))


def counted(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct places, how often each of them occurs, in as few bytes as that takes, and how many there are in all."""
    i, times = np.unique(places, return_counts=True)
    return i.astype(np.int32), times.astype(np.min_scalar_type(times.max(initial=0))), len(places)


def learn(rows: list[tuple[np.ndarray, int]], s: Settings) -> np.ndarray:
    """The weights that ``fitted`` learns from places as ``features`` gives them."""
    return fitted([(counted(places), label) for places, label in rows], s)


def fitted(rows: list[tuple[tuple[np.ndarray, np.ndarray, int], int]], s: Settings) -> np.ndarray:
    """Weights (the last one is the constant's) after one update a row of counted places, in order, ``s.passes`` times.

    Per coordinate the leader is regularised by l1 and l2, and its step shrinks with the squares of the
    gradients so far.
    """
    size = (1 << s.bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)

    def leader(i: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(s.passes):
        for (places, times, count), label in rows:
            i, x = np.append(places, size - 1), np.append(times * _scale(count), 1.0)
            w = leader(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return leader(np.arange(size)).astype(np.float32)


def learned(batches: Iterable[pa.RecordBatch], s: Settings) -> np.ndarray:
    """The weights from batches of places, label and order, whichever way the rows come."""
    rows = []
    for b in batches:
        for p, y, o in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()):
            row = counted(p.values.to_numpy())
            # Rows of one key and length stand in a fixed order too; those that agree in this learn alike.
            rows.append((o, row[2], xxhash.xxh3_128_digest(row[0].tobytes() + row[1].tobytes()), (row, y)))
    rows.sort(key=lambda r: r[:3])
    return fitted([r[3] for r in rows], s)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", use: Column | None = None, settings: Settings = Settings()) -> np.ndarray:
    """The model for ``label`` (1 or 0; other rows are left out), learned from labelled rows of ``docs``.

    ``use`` says which keys may be learned from. Of repeated labels of a key the larger counts, of
    repeated rows each, but ``train_rows`` rows at most. Without labelled rows all weights are 0 and every score is one half.
    """
    marked = labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    marked = marked.where(F.col("__key").isNotNull() & F.col("__label").isin(0, 1)).groupBy("__key").agg(F.max("__label").alias("__label"))
    if use is not None:
        marked = marked.withColumnRenamed("__key", key).where(use).withColumnRenamed(key, "__key")
    sample = marked.withColumn("__order", F.xxhash64("__key")).orderBy("__order", "__key").limit(settings.train_rows)
    # At most settings.train_rows rows of three numbers: a proven bound for broadcasting.
    rows = shipped(docs).select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).join(F.broadcast(sample), "__key")
    bits = settings.bits

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), bits).astype(np.int32) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)], ["places", "label", "order"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = learned(batches, settings).tobytes()
        returned()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], ["weights"])

    places = rows.select("__text", "__label", "__order").mapInArrow(featurise, "places array<int>, label int, order long")
    # Rows are read and featurised in all tasks; of repeated keys' rows no more stay either. The bounded
    # sample, as numbers, then meets in one task.
    bounded = places.orderBy("order", F.size("places"), F.xxhash64("places"), "label").limit(settings.train_rows)
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        found = bounded.repartition(1).mapInArrow(fit, "weights binary").collect()
    return np.frombuffer(found[0][0], np.float32) if found else learn([], settings)


def with_score(df: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the model's probability of label 1 in ``out`` (a column of that name is replaced).

    A NULL or empty text has the constant's score; repeated rows score alike; an empty table stays empty.
    """
    bits = int(len(weights) - 1).bit_length() - 1
    data = weights.tobytes()
    df = shipped(df.drop(out))
    at = df.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(data, np.float32).astype(np.float64)
        for batch in batches:
            sums = np.empty(batch.num_rows)
            for i, value in enumerate(batch.column(at)):
                places = features(value.as_py(), bits)
                sums[i] = w[places].sum() * _scale(len(places)) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, out])

    return df.mapInArrow(score, StructType([*df.schema.fields, StructField(out, DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, least: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, held_out (its key's crc32 is a multiple of ``folds``; never learned from), score, predicted.

    A NULL key stays NULL and counts as held out; other columns are left out.
    """
    model = train(docs, labels, key, text, label, remainder(key, folds) != 0, settings)
    frame = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_score(frame, model).select(
        "doc_id",
        F.coalesce(remainder("doc_id", folds) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
