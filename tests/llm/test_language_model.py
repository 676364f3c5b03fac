import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import language_model as L
from marketframe.llm.queries import QUERIES

from .conftest import clashing


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


@pytest.fixture(scope="module")
def scores(documents):
    return L.scored(clashing(documents), held_out=L.held_out_rows(), block_tokens=20_000).collect()


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def test_base_scores_match_brute_force(scores, rows):
    count = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), held(i), len(tokens(x)), sum(t in count for t in tokens(x)), n, round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 4)) for i, x in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in scores) == want


def test_walks_match_brute_force(scores, rows):
    """A plain automaton over dictionaries: states, arcs, failure arcs, and weights fitted to tokens left out."""
    texts = [(i, tokens(x)) for i, x in rows]
    count = Counter(t for i, x in texts if not held(i) for t in x)
    pairs = Counter((a, b) for i, x in texts if not held(i) for a, b in zip([b"", *x], x))
    norm = sum(count.values()) + len(count) + 1
    x_of = L.ratios()

    def x(pair, state, p):
        return x_of[min(max(math.floor(4 * math.log2(pair / (state * p))) - L.LOWEST + 1, 1), L.RATIOS - 1)] if pair > 0 else 0.0

    left = {}
    for (a, b), c in pairs.items():
        if count[a] > 1:
            left.setdefault(int(math.log2(count[a] - 1)), []).append((x(c - 1, count[a] - 1, (count[b] + 1) / norm), c))
    met = np.zeros((L.CLASSES, L.RATIOS))
    for k, found in left.items():
        for value, c in found:
            met[k, int(np.argmin(abs(x_of - value)))] += c
    w = L.failure_weights(met)
    want = []
    for i, t in texts:
        total = 0.0
        for a, b in zip([b"", *t], t):
            p = (count[b] + 1) / norm
            k = int(math.log2(count[a])) if count[a] else 0
            total += math.log10(p * ((1 - w[k]) * x(pairs[a, b], count[a], p) + w[k])) if count[a] else math.log10(p)
        want.append((str(i), round(total, 3)))
    got = sorted((str(r["doc_id"]), r["score"]) for r in scores)
    assert [g[0] for g in got] == [v[0] for v in sorted(want)]
    assert all(abs(g[1] - v[1]) < 1e-3 * max(1, abs(v[1])) for g, v in zip(got, sorted(want)))


def test_query_scores_by_exact_arcs(spark):
    """op1 weighs arcs by x itself: a plain automaton agrees, and what leaves a state sums to 1."""
    path = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], tokens(r["text"])) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    count = Counter(t for i, x in texts if not held(i) for t in x)
    pairs = Counter((a, b) for i, x in texts if not held(i) for a, b in zip([b"", *x], x))
    norm = sum(count.values()) + len(count) + 1
    met, sums = np.zeros((2, L.CLASSES, L.RATIOS))
    for (a, b), c in pairs.items():
        if count[a] > 1:
            x = (c - 1) * norm / ((count[a] - 1) * (count[b] + 1))
            at = int(math.log2(count[a] - 1)), min(max(math.floor(4 * math.log2(x)) - L.LOWEST + 1, 1), L.RATIOS - 1) if x else 0
            met[at] += c
            sums[at] += c * x
    w = L.failure_weights(met, sums / np.maximum(met, 1))

    def arc(a, b):
        p = (count[b] + 1) / norm
        return p * ((1 - w[int(math.log2(count[a]))]) * pairs[a, b] / (count[a] * p) + w[int(math.log2(count[a]))]) if count[a] else p

    want = {i: sum(math.log10(arc(a, b)) for a, b in zip([b"", *t], t)) for i, t in texts}
    got = {r["doc_id"]: r["score"] for r in QUERIES["op1_language_model"](spark, path).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 * abs(want[i]) for i in want)
    for a in sorted(count)[::500]:
        assert abs(sum(arc(a, b) for b in count) + 1 / norm * w[int(math.log2(count[a]))] - 1) < 1e-9


def test_weights_behind_a_state_sum_to_at_most_one():
    rng = np.random.default_rng(2)
    count = rng.integers(1, 50, 30)
    p = (count + 1) / (count.sum() + 31)
    pair = rng.multinomial(40, rng.dirichlet(np.ones(30) * 0.2))
    x = L.ratios()[L._ratio(pair, np.full(30, 40), p)]
    for w in (1e-4, 0.3, 1 - 1e-4):
        assert (p * ((1 - w) * x + w)).sum() <= 1 + 1e-12


def test_model_beats_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.scored(docs, held_out=L.held_out_rows()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_blocks_change_nothing(documents, scores):
    other = L.scored(documents.repartition(3), held_out=L.held_out_rows()).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"])
    for a, b in zip(sorted(scores, key=key), sorted(other, key=key)):
        assert key(a) == key(b) and abs(a["score"] - b["score"]) < 1e-6 * max(1, abs(a["score"]))


def test_no_rows_and_no_training_rows(spark, empty):
    assert L.scored(empty).count() == 0
    r = L.scored(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), held_out=F.lit(True)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
