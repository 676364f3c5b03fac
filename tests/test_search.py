"""Indexed search and audited appends."""

import random

import pytest

from marketframe.operators.search import gram_index, search_indexed
from marketframe.sources.rawlog import append_audited, read_audited


def contained(rows, patterns):
    out = []
    for key, *texts in rows:
        text = "\n".join(t for t in texts if t is not None).lower()
        out += [(key, p) for p in {p for p in patterns if p} if p.lower() in text]
    return sorted(out, key=str)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_search_against_every_pattern(spark, threshold):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abAB é\U0001f600", k=rng.randrange(12))), rng.choice([None, "", "xyz", "Ab\nc"])) for i in range(150)] + [(None, "abc", None), (None, "abc", None)]
    patterns = ["".join(rng.choices("abAB é\U0001f600", k=rng.randrange(6))) for _ in range(60)] + [None, "", "zzz", "xyz", "XYZ", "b\nx", "a\nb"]
    df = spark.createDataFrame(rows, "id long, name string, other string")
    asked = spark.createDataFrame([(p,) for p in patterns], "Pattern string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        keyed = df.filter("id IS NOT NULL")
        found = search_indexed(keyed, asked, gram_index(keyed, "id", ["name", "other"]), "id", ["name", "other"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.id, r.Pattern) for r in found.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == contained([r for r in rows if r[0] is not None], patterns)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_search_of_nothing(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "id long, name string")
    index = gram_index(df, "id", "name")
    assert index.count() == 6
    none = spark.createDataFrame([], "Pattern string")
    assert search_indexed(df, none, index, "id", "name").collect() == []


KINDS = {"n": "bigint", "x": "double"}
ROWS = [(1, "5", "1.5"), (2, "five", "2"), (3, None, "x"), (4, "y", "z"), (5, None, None), (6, "7", "")]


def test_append_audits_in_one_pass(spark, tmp_path):
    spark.createDataFrame(ROWS, "id long, n string, x string").write.parquet(str(tmp_path / "in"))
    path = str(tmp_path / "log")
    rows = spark.read.parquet(str(tmp_path / "in"))
    assert append_audited(rows, path, KINDS) == {"n": 2, "x": 3}
    assert append_audited(rows.filter("id = 1"), path, KINDS) == {"n": 0, "x": 0}
    fits, aside = read_audited(spark, path, KINDS)
    assert sorted(((r.id, r.n, r.x) for r in fits.collect()), key=str) == [(1, 5, 1.5), (1, 5, 1.5), (5, None, None)]
    assert sorted((r.id, r.n, r.x, tuple(r["__reasons"])) for r in aside.filter("id <> 3").collect()) == [(2, "five", "2", ("n",)), (4, "y", "z", ("n", "x")), (6, "7", "", ("x",))]
    assert aside.filter("id = 3").first()["__reasons"] == ["x"]


def test_append_of_nothing(spark, tmp_path):
    rows = spark.createDataFrame([], "id long, n string, x string")
    assert append_audited(rows, str(tmp_path / "log"), KINDS) == {"n": 0, "x": 0}
