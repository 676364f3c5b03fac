"""Approximate nearest neighbours by a permutation index.

A few rows serve as pivots, and a vector is known by its nearest ones in order. Rows are kept in
blocks; each block has an inverted file per pivot, of the vectors that have the pivot among their
first. A query reads the files of its own first pivots, ranks what it finds by footrule distance (how
far places of pivots differ, pivots out of sight counting as the place after the last), and the nearer
share is ranked anew by true inner product. Rows and pivots stand for vectors of one common length,
extended by one coordinate, as then the nearest to a query are those of largest inner product; a query's
own extension is 0. Copies of a vector in a block count once when shares are
taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped, written

#: Pivots (the bounded sample that fits the index), places kept, places posted, share of a block that is ranked anew, rows of a block.
PIVOTS, PLACES, POSTED, SHARE, LEAST, BLOCK_ROWS, QUERY_ROWS = 128, 32, 16, 0.35, 500, 16_384, 2_048


def usable(vector: str) -> Column:
    """Vectors that are neither NULL, empty nor zero and hold finite numbers only."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def _permutations(vectors: np.ndarray, pivots: np.ndarray, places: int, limit: float | None = None) -> np.ndarray:
    """The nearest pivots of each vector in order, ties to the smaller number.

    With ``limit``, the largest squared length of all rows, vectors and pivots count as extended to it.
    """
    near = np.einsum("ij,kj->ik", vectors, pivots) if len(vectors) < 64 else vectors @ pivots.T
    if limit is not None:
        a, b = np.einsum("ij,ij->i", vectors, vectors)[:, None], np.einsum("ij,ij->i", pivots, pivots)
        # The product of both extensions less the limit, without the loss of digits under a large limit.
        near += (a * (b / limit) - a - b) / (1 + np.sqrt(np.maximum(1 - a / limit, 0) * np.maximum(1 - b / limit, 0)))
    return np.argsort(-near.round(9), axis=1, kind="stable")[:, :places].astype(np.uint16)


def blocks(df: DataFrame, pivots: np.ndarray, places: int, rows: int, limit: float | None = None) -> DataFrame:
    """(key, vector) rows as blocks: number, keys, vectors (doubles) and permutations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, parts, total = TaskContext.get().partitionId() << 24, [], [], 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays(keys)
            order = np.argsort(ids.to_numpy(), kind="stable")
            vectors = np.concatenate(parts)[order]
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays([0, len(ids)], ids.take(pa.array(order))),
                pa.array([vectors.tobytes()], pa.binary()),
                pa.array([_permutations(vectors, pivots, places, limit).tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "keys", "vectors", "places"])

        for batch in batches:
            values = batch.column(1)
            vectors = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
            for at in range(0, len(values), rows):
                keys.append(batch.column(0)[at : at + rows])
                parts.append(vectors[at : at + rows])
                total += len(keys[-1])
                if total >= rows:
                    yield block()
                    number, keys, parts, total = number + 1, [], [], 0
        if total:
            yield block()

    return shipped(df).mapInArrow(run, "block long, keys array<long>, vectors binary, places binary")


class Index:
    """One block's inverted files."""

    def __init__(self, keys: list[int], vectors: np.ndarray, places: np.ndarray, pivots: int):
        _, first, copy = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(first)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        # Distinct vectors by their first row, and the rows of each: keys ascend.
        self.vectors, self.keys = vectors[first[order]], np.array(keys, np.int64)
        self.rows = np.argsort(back[copy.ravel()], kind="stable")
        self.cuts = np.append(0, np.cumsum(np.bincount(copy.ravel(), minlength=len(order))[order]))
        kept = places[first[order]]
        self.depth = kept.shape[1]
        #: By pivot and vector: the pivot's place, or the one after the last.
        self.place = np.full((pivots, len(kept)), self.depth, np.int16)
        for p in range(self.depth):
            self.place[kept[:, p], np.arange(len(kept))] = p

    def search(self, query: np.ndarray, places: np.ndarray, own: int, k: int, posted: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and scores of the k nearest found, nearest first."""
        n, depth = len(self.vectors), self.depth
        # Footrule less what it is when no pivot is shared: only the query's own pivots matter.
        foot = np.zeros(n, np.int32)
        for at, p in enumerate(places):
            place = self.place[p]
            foot += np.abs(place - np.int16(at)) - (np.int16(depth) - place)
        met = np.zeros(n, bool)
        for p in places[:posted]:
            met |= self.place[p] < posted
        wanted = min(n, max(int(np.ceil(share * n)), least))
        ranked = np.where(met, foot, foot + (1 << 24)).astype(np.int64) * n + np.arange(n)
        found = np.argpartition(ranked, wanted - 1)[:wanted] if wanted < n else np.arange(n)
        near = self.vectors[found] @ query
        # A distinct vector may be the query's own row only, so one more than k is enough; near ties stay in.
        if len(found) > k + 1:
            limit = np.partition(near, -(k + 1))[-(k + 1)] - 1e-9 * (1 + np.abs(near).max())
            found = found[near >= limit]
        # Row sums, so that a vector scores alike in every block.
        scores = (self.vectors[found] * query).sum(axis=1)
        rows = [self.rows[self.cuts[v] : self.cuts[v + 1]][: k + 1] for v in found]
        keys = self.keys[np.concatenate(rows)]
        scores = np.repeat(scores, [len(r) for r in rows])
        keep = keys != own
        keys, scores = keys[keep], scores[keep]
        best = np.lexsort((keys, -scores))[:k]
        return keys[best], scores[best]


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, pivots: int = PIVOTS, places: int = PLACES, posted: int = POSTED, share: float = SHARE, least: int = LEAST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row for which ``queries`` holds its k nearest others found: query_id, rank (from 1), vec_id and score.

    Nearness is the inner product in double precision; ties go to the smaller key. Rows with a NULL key, a
    vector that isn't usable or one of another length than most take no part. Repeated keys are rows of
    their own as candidates, but never a query's with the same key. Other columns are left out; an empty
    table gives no rows.
    """
    frame = df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("query"))
    frame = frame.where(F.col("key").isNotNull() & usable("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = frame.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("count"), F.max(squares).alias("limit"))
    sizes = sizes.orderBy(F.desc("count"), "size").limit(1).collect()
    length, limit = (sizes[0]["size"], max(sizes[0]["limit"], 1e-300)) if sizes else (0, 1.0)
    frame = frame.where(F.size("vector") == length)
    sample = frame.select(F.xxhash64("key").alias("order"), "key", "vector").orderBy("order", "key").limit(4 * pivots).collect()
    chosen = list(dict.fromkeys(tuple(r["vector"]) for r in sample))[:pivots]
    centres = np.array(chosen, np.float64).reshape(len(chosen), length)
    depth, count = min(places, len(chosen)), len(chosen)
    index = written(blocks(frame.select("key", "vector"), centres, depth, block_rows, limit), "index")
    asked = written(blocks(frame.where("query").select("key", "vector"), centres, depth, QUERY_ROWS), "queries")
    # Every block of rows meets every block of queries: whole blocks are what is dealt out.
    groups = max(1, index.count())
    index = index.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("group"), *(F.col(c).alias(f"q_{c}") for c in ("keys", "vectors", "places")))
    met = asked.join(index, "group").select("block", "keys", "vectors", "places", "q_keys", "q_vectors", "q_places")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, Index] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                number, keys, vectors, order, q_keys, q_vectors, q_order = (batch.column(i)[r] for i in range(7))
                block = recent.get(number.as_py())
                if block is None:
                    n = len(keys)
                    block = Index(keys.as_py(), np.frombuffer(vectors.as_py()).reshape(n, -1), np.frombuffer(order.as_py(), np.uint16).reshape(n, -1), count)
                    recent = dict([*recent.items()][-2:]) | {number.as_py(): block}
                n = len(q_keys)
                found_q, found_k, found_s = [], [], []
                for own, q, places_of in zip(q_keys.as_py(), np.frombuffer(q_vectors.as_py()).reshape(n, -1), np.frombuffer(q_order.as_py(), np.uint16).reshape(n, -1)):
                    got, scores = block.search(q, places_of, own, k, posted, share, least)
                    found_q.append(np.full(len(got), own))
                    found_k.append(got)
                    found_s.append(scores)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (found_q, found_k, found_s)], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
