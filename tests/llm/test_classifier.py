import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketframe.llm import caching
from marketframe.llm import quality_classifier as Q

from .conftest import clashing


@pytest.fixture(scope="module")
def labelled(spark):
    good = [(i, f"the plain words of text number {i} go on as they should", 1) for i in range(120)]
    bad = [(1000 + i, f"THE!! PLAIN## WORDS!! OF## TEXT!! NUMBER {i}", 0) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in good + bad] + [(5001, None), (5002, ""), (None, "the plain words")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad] + [(5001, None), (None, 1), (0, 0)], "doc_id long, quality int")
    return docs, labels


def test_held_out_rows_are_told_apart(labelled):
    docs, labels = labelled
    got = Q.report(clashing(docs), labels).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == docs.count() and by[None]["held_out"] and 0 <= by[5001]["score"] == by[5002]["score"] <= 1
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 2000:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            assert r["predicted"] == int(r["score"] >= 0.3) == int(r["doc_id"] < 1000)


def test_training_ignores_other_rows_and_is_bounded(labelled):
    docs, labels = labelled
    few = Q.train(docs, labels, settings=Q.Settings(train_rows=40))
    assert len(few) == 2**18 + 1 and np.any(few)
    assert np.array_equal(few, Q.train(docs.repartition(7), labels.repartition(3), settings=Q.Settings(train_rows=40)))
    none = Q.train(docs, labels, use=F.lit(False))
    assert not np.any(none)
    assert {r["score"] for r in Q.with_score(docs, none).collect()} == {0.5}


def test_updates_match_a_plain_loop():
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 16, rng.integers(0, 9)), int(rng.integers(0, 2))) for _ in range(40)]
    s = Q.Settings(bits=4, passes=2)
    z, n = dict.fromkeys(range(17), 0.0), dict.fromkeys(range(17), 0.0)

    def w(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(2):
        for places, y in rows:
            x = {16: 1.0}
            for p in places:
                x[p] = x.get(p, 0) + 1 / np.sqrt(len(places))
            old = {i: w(i) for i in x}
            p = 1 / (1 + np.exp(-sum(old[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha * old[i]
                n[i] += g * g
    assert np.allclose(Q.learn(rows, s), [w(i) for i in range(17)], atol=1e-5)


def test_driver_tables(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = Q.report(docs, labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.report(empty, labels).count() == 0


def test_training_holds_counts_instead_of_places():
    """The task that learns holds less than the places it is given, and what it learns is as from the places."""
    rng, s = np.random.default_rng(3), Q.Settings(bits=11, passes=1)
    rows = [(o, rng.integers(0, 1500, 2000).astype(np.int32), int(o % 2)) for o in rng.permutation(1500).tolist()]

    def batches():
        for at in range(0, len(rows), 100):
            orders, places, labels = zip(*rows[at : at + 100])
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.list_(pa.int32())), pa.array(labels, pa.int32()), pa.array(orders, pa.int64())], ["places", "label", "order"])

    tracemalloc.start()
    got = Q.learned(batches(), s)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, Q.learn([(p, y) for _, p, y in sorted(rows, key=lambda r: r[0])], s))
    assert peak < 1.5 * sum(p.nbytes for _, p, _ in rows)


def test_memory_goes_back_when_another_operator_starts(monkeypatch):
    calls = []
    monkeypatch.setattr(caching, "returned", lambda: calls.append(dict(caching._held)))
    monkeypatch.setattr(caching, "_held", {})
    assert [caching.held(x, lambda x=x: x) for x in "aab"] == ["a", "a", "b"]
    assert calls == [{}]


def test_training_gets_small_batches(labelled, spark, monkeypatch):
    """The task that learns, and those that featurise, are handed few rows at once; afterwards the setting is as before."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, inside = spark.conf.get(name), Q.batch_rows
    monkeypatch.setattr(Q, "batch_rows", lambda session, rows: seen.append(rows) or inside(session, rows))
    assert np.any(Q.train(*labelled)) and seen == [Q.BATCH_ROWS] and spark.conf.get(name) == before
