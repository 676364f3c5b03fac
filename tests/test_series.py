import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketframe.operators import decay, ordered, snapshot

START = datetime(2024, 1, 1)


def recurrence(rows, tau):
    """Mean and deviation by the plain recurrences, in order."""
    out, mean, var, last = [], None, 0.0, None
    for seconds, x in rows:
        if x is None:
            out.append((mean, None if mean is None else math.sqrt(var)))
            continue
        if mean is None:
            mean, last = x, seconds
            out.append((mean, None))
            continue
        a = math.exp(-(seconds - last) / tau)
        var = a * (var + (1 - a) * (x - mean) ** 2)
        mean = a * mean + (1 - a) * x
        last = seconds
        out.append((mean, math.sqrt(var)))
    return out


def frame(spark, series):
    rows = [
        (key, START + timedelta(seconds=t), i, x) for key, points in series.items() for i, (t, x) in enumerate(points)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, x double")


def check(df, series, tau, tol=1e-9):
    got = {(r.k, r.seq): (r.m, r.sd) for r in df.collect()}
    for key, points in series.items():
        for i, (mean, sd) in enumerate(recurrence(points, tau)):
            m, d = got[key, i]
            assert (m is None) == (mean is None) and (d is None) == (sd is None), (key, i)
            if mean is not None:
                assert m == pytest.approx(mean, abs=tol)
            if sd is not None:
                assert d == pytest.approx(sd, abs=tol)


def random_series(seed, keys=3, n=60, scale=100):
    rng = random.Random(seed)
    series = {}
    for k in range(keys):
        t, points = 0.0, []
        for _ in range(n):
            t += rng.choice([0, 0, 1, 5, 60, 3600]) * rng.random() * scale / 100
            t = round(t, 6)
            points.append((t, None if rng.random() < 0.1 else rng.uniform(-50, 500)))
        series[f"k{k}"] = points
    series[None] = series["k0"]
    return series


MEAN, STD = {"m": "x"}, {"sd": "x"}


def test_decay_fixture(spark):
    series = {"a": [(0, 1.0), (60, 2.0), (60, 3.0), (180, 4.0), (100000, 5.0)]}
    out = decay.decay_stats(frame(spark, series), "ts", timedelta(seconds=120), "k", MEAN, STD, "seq")
    check(out, series, 120)
    rows = {r.seq: r for r in out.collect()}
    assert rows[2].m == pytest.approx(rows[1].m, abs=1e-12)  # no time passed: the new value has no weight


@pytest.mark.parametrize("tau", [0.5, 120, 86400])
@pytest.mark.parametrize("split", [{}, {"split_rows": 7}, {"block": 1_000_000}, {"block": 600_000_000}])
def test_decay_matches_the_recurrence(spark, tau, split):
    series = random_series(3)
    out = decay.decay_stats(frame(spark, series), "ts", tau, "k", MEAN, STD, "seq", **split)
    check(out, series, tau)


def test_decay_over_gaps_beyond_the_span(spark):
    series = {"a": [(0, 5.0), (1, 9.0), (2, 7.0), (10_000, 1.0), (10_001, 2.0), (10_400, 3.0), (10_401, 8.0)]}
    out = decay.decay_stats(frame(spark, series), "ts", 1, "k", MEAN, STD, "seq")
    check(out, series, 1)


def test_level_jump_keeps_precision(spark):
    points = [(i, 1e6) for i in range(30)] + [(30 + i, 1.0 + 1e-3 * (i % 2)) for i in range(400)]
    series = {"a": points}
    for split in ({}, {"block": 10_000_000}):
        out = decay.decay_stats(frame(spark, series), "ts", 10, "k", MEAN, STD, "seq", **split)
        check(out, series, 10, tol=1e-5)


def test_mean_and_deviation_alone(spark):
    series = random_series(5, keys=1)
    both = decay.decay_stats(frame(spark, series), "ts", 60, "k", MEAN, STD, "seq")
    mean = decay.ema_time(frame(spark, series), "ts", 60, MEAN, "k", "seq")
    std = decay.emstd_time(frame(spark, series), "ts", 60, STD, "k", "seq")
    assert "sd" not in mean.columns and "m" not in std.columns
    joined = both.filter("k IS NOT NULL").join(mean.select("k", "seq", F.col("m").alias("m2")), ["k", "seq"])
    joined = joined.join(std.select("k", "seq", F.col("sd").alias("sd2")), ["k", "seq"])
    assert joined.filter("abs(m - m2) > 1e-9 OR abs(sd - sd2) > 1e-9").count() == 0


def test_decay_continues_from_states(spark):
    series = random_series(11, keys=2)
    df = frame(spark, series)
    first, second = df.filter("seq < 25"), df.filter("seq >= 25")
    head = decay.decay_stats(first, "ts", 60, "k", MEAN, STD, "seq")
    states = decay.last_states(head, "k", "ts", {"x": ("m", "sd")}, "seq")
    tail = decay.decay_stats(second, "ts", 60, "k", MEAN, STD, "seq", initial=states)
    check(head.unionByName(tail), series, 60)
    merged = decay.merge_states(states, decay.last_states(tail, "k", "ts", {"x": ("m", "sd")}, "seq"), "k")
    assert merged.count() == 3


@pytest.mark.parametrize("split", [{}, {"split_rows": 5}, {"block": 2_000_000}])
def test_previous_row(spark, split):
    series = random_series(2)
    df = frame(spark, series)
    got = {(r.k, r.seq): r.prev for r in ordered.with_previous(df, {"prev": "x"}, "k", "ts", "seq", **split).collect()}
    for key, points in series.items():
        want = [None] + [x for _, x in points[:-1]]
        assert [got[key, i] for i in range(len(points))] == want


def test_hot_key_is_split(spark):
    df = spark.range(3000).selectExpr("IF(id < 2700, 'hot', concat('k', id)) AS k", "timestamp_seconds(id) AS ts")
    assert ordered.plan_cuts(df, "k", "ts", None, 6000) is None
    cuts = ordered.plan_cuts(df, "k", "ts", None, 300)
    assert [r.k for r in cuts.points.collect()] == ["hot"] and cuts.small
    sizes = ordered.with_blocks(df, "k", "ts", cuts=cuts).groupBy("k", ordered.BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 300 and sizes.filter("k = 'hot'").count() >= 9
    hot = ordered.with_blocks(df, "k", "ts", cuts=cuts, hot_only=True)
    assert hot.count() == 2700 and hot.filter("k <> 'hot'").isEmpty()


def test_blocks_follow_the_order(spark):
    """Bursts, equal times and rows without a time are cut as well, by their sequence."""
    at = "CASE WHEN id < 900 THEN timestamp_micros(id * 1000) WHEN id < 2000 THEN timestamp_seconds(5) ELSE timestamp_seconds(id) END"
    df = spark.range(5000).selectExpr("'hot' AS k", "id", f"IF(id % 4 = 0, NULL, {at}) AS ts", "CAST(id AS DOUBLE) AS x").repartition(7)
    cuts = ordered.plan_cuts(df, "k", "ts", "id", 400)
    rows = ordered.with_blocks(df, "k", "ts", "id", cuts=cuts)
    assert rows.groupBy(ordered.BLOCK).count().agg(F.max("count")).first()[0] <= 400
    blocks = [r[0] for r in rows.orderBy(ordered.US, "id").select(ordered.BLOCK).collect()]
    assert blocks == sorted(blocks) and blocks[0] == 0 and blocks[-1] >= 20
    got = ordered.with_previous(df, {"p": "x"}, "k", "ts", "id", split_rows=400)
    plain = ordered.with_previous(df, {"p": "x"}, "k", "ts", "id")
    assert got.exceptAll(plain.select(*got.columns)).isEmpty()
    split = decay.decay_stats(df, "ts", 60, "k", {"m": "x"}, {"sd": "x"}, "id", split_rows=400)
    whole = decay.decay_stats(df, "ts", 60, "k", {"w": "x"}, {"wd": "x"}, "id").select("id", "w", "wd")
    far = F.greatest(F.abs(F.col("m") - F.col("w")), F.abs(F.col("sd") - F.col("wd")))
    assert split.join(whole, "id").agg(F.max(far)).first()[0] < 1e-7


def test_a_row_meets_few_cut_points_whatever_the_size_of_its_key(spark):
    """Thousands of blocks of a key: in levels, for keys of any size and without a key."""
    kind = "CASE WHEN id % 5 > 0 THEN 'hot' WHEN id % 2 = 0 THEN 'cold' WHEN id % 3 = 0 THEN concat('k', id) END"
    df = spark.range(20000).selectExpr(f"{kind} AS k", "id", "IF(id % 1000 = 7, NULL, timestamp_seconds(id)) AS ts", "CAST(id % 11 AS DOUBLE) AS x")
    for seq in (None, "id"):
        cuts = level = ordered.plan_cuts(df, "k", "ts", seq, 8)
        while level:
            assert level.points.agg(F.max(F.size(ordered.CUTS))).first()[0] <= 512
            level = level.coarser
        rows = ordered.with_blocks(df, "k", "ts", seq, cuts=cuts)
        assert rows.filter("ts IS NOT NULL").groupBy("k", ordered.BLOCK).count().agg(F.max("count")).first()[0] <= 8
        blocks = [r[0] for r in rows.filter("k = 'hot'").orderBy(ordered.US, "id").select(ordered.BLOCK).collect()]
        assert blocks == sorted(blocks) and len(set(blocks)) > 512
        hot = ordered.with_blocks(df, "k", "ts", seq, cuts=cuts, hot_only=True)
        assert sorted(r.k or "" for r in hot.select("k").distinct().collect()) == ["", "cold", "hot"]
        assert hot.exceptAll(rows).isEmpty() and hot.count() == rows.filter("k IS NULL OR k NOT LIKE 'k%'").count()
    split = ordered.with_previous(df, {"p": "x"}, "k", "ts", "id", split_rows=8)
    assert split.exceptAll(ordered.with_previous(df, {"p": "x"}, "k", "ts", "id").select(*split.columns)).isEmpty()
    split = decay.decay_stats(df, "ts", 60, "k", {"m": "x"}, {"sd": "x"}, "id", split_rows=8)
    whole = decay.decay_stats(df, "ts", 60, "k", {"w": "x"}, {"wd": "x"}, "id").select("id", "w", "wd")
    far = F.greatest(F.abs(F.col("m") - F.col("w")), F.abs(F.col("sd") - F.col("wd")))
    assert split.join(whole, "id").agg(F.max(far)).first()[0] < 1e-7


def test_no_hot_key_needs_one_shuffle(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 AS k", "timestamp_seconds(id) AS ts", "CAST(id AS DOUBLE) AS x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for out in (ordered.with_previous(df, {"p": "x"}, "k", "ts"), decay.decay_stats(df, "ts", 60, "k", MEAN, STD)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_hot_key_needs_two_scans_and_one_full_shuffle(spark, tmp_path):
    """One scan of all columns and one of those that the blocks' last rows need; the cut points are read from where they were written."""
    spark.range(2000).selectExpr("if(id % 2 = 0, 0, id) AS k", "timestamp_seconds(id) AS ts", "CAST(id AS DOUBLE) AS x", "id AS wide").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for out in (ordered.with_previous(df, {"p": "x"}, "k", "ts", split_rows=200), decay.decay_stats(df, "ts", 60, "k", MEAN, STD, split_rows=200)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "cuts-" not in line]
        assert len(scans) == 2 and sum("wide" in line for line in scans) == 1
        full = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line and "__block" in line]
        assert len(full) == 2 and "SortMergeJoin" not in plan
        assert out.count() == 2000


def test_rows_without_time_stand_first_on_both_paths(spark):
    rows = [("k", None, 1), ("k", -315619200, 2), ("k", -157766400, 3), ("k", 315532800, 4)] + [("k", None, 0)] * 0
    df = spark.createDataFrame(rows, "k string, at long, v int").withColumn("ts", F.timestamp_seconds("at"))
    for split in (None, 2):
        out = ordered.with_previous(df, {"p": "v"}, "k", "ts", split_rows=split)
        assert {r.v: r.p for r in out.collect()} == {1: None, 2: 1, 3: 2, 4: 3}


def test_row_ids_keep_rows_without_part(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "v int, b int")
    out = ordered.with_row_ids(df, ["b", "v"], F.col("b"), "v")
    assert {r.v: r.RequestId for r in out.collect()} == {1: 1, 3: 2, 2: 3}


def test_late_row_has_weight_zero(spark):
    at = "timestamp_seconds(at) AS ts"
    first = spark.createDataFrame([("k", 3600, 10.0)], "k string, at long, x double").selectExpr("k", "x", at)
    late = spark.createDataFrame([("k", 1800, 11.0)], "k string, at long, x double").selectExpr("k", "x", at)
    state = decay.last_states(decay.decay_stats(first, "ts", 120, "k", MEAN, STD), "k", "ts", {"x": (list(MEAN)[0], list(STD)[0])})
    out = decay.decay_stats(late, "ts", 120, "k", MEAN, STD, initial=state).first()
    assert out[list(MEAN)[0]] == 10.0 and out["ts"].minute == 30


def test_returns_and_changes(spark, values):
    series = {"a": [(0, 10.0), (1, 10.0), (2, 0.0), (3, 5.0)], "b": [(0, 1.0)]}
    out = ordered.returns(frame(spark, series), "x", "k", "ts", "seq", split_rows=2)
    assert values(out, "k", "seq", "Last", "Return") == [
        ("a", 0, None, None),
        ("a", 1, 10.0, 0.0),
        ("a", 2, 10.0, -1.0),
        ("a", 3, 0.0, None),
        ("b", 0, None, None),
    ]
    kept = ordered.changed_only(frame(spark, series), "x", "k", "ts", "seq", block=1_000_000)
    assert values(kept, "k", "seq") == [("a", 0), ("a", 2), ("a", 3), ("b", 0)]


def test_row_ids(spark):
    df = spark.range(100).selectExpr("(id * 37) % 100 AS v")
    for rows in (1000, 3):
        out = ordered.with_row_ids(df, "v", F.floor(F.col("v") / 40), "v", start=5, split_rows=rows)
        assert sorted((r.v, r.RequestId) for r in out.collect()) == [(i, i + 5) for i in range(100)]


def test_row_ids_of_a_large_part_in_one_shuffle(spark, tmp_path):
    """Thousands of parts, with equal times, rows without one and repeated rows; joined with nothing but cut points."""
    rows = spark.range(20000).selectExpr("(id * 37) % 9999 AS v", "id % 9 AS w").withColumn("t", F.expr("IF(v % 500 = 3, NULL, v - v % 3)"))
    rows.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ordered.with_row_ids(df, ["t", "v", "w"], F.when(F.col("t") < 9000, 1).when(F.col("t").isNotNull(), 2), "t", split_rows=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and sum("hashpartitioning(__bucket" in line and "__of" not in line for line in plan.splitlines()) == 2
    assert all("__small_" in line for line in plan.splitlines() if "HashJoin [" in line)
    got = [tuple(r) for r in out.orderBy("RequestId").select("t", "v", "w", "RequestId").collect()]
    first = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert [r[3] for r in got] == list(range(1, 20001)) and [r[:3] for r in got] == sorted((r[:3] for r in got), key=first)


GRID = snapshot.TimeGrid(START, START + timedelta(seconds=30), timedelta(seconds=10))


def test_grid(spark):
    assert [r.Timestamp.second for r in GRID.frame(spark).orderBy("Timestamp").collect()] == [0, 10, 20, 30]


def test_snapshot(spark, values):
    series = {"a": [(-5, 1.0), (10, 2.0), (10, 3.0), (29, 4.0), (31, 5.0)], "b": [(12, 7.0)], "c": [(40, 9.0)]}
    df = frame(spark, series)
    history = snapshot.snapshot_when(df, GRID, "k", "ts", "seq", history=True)
    got = values(history.withColumn("at", F.second("SnapTime")), "k", "at", "x")
    assert got == [("a", 0, 1.0), ("a", 10, 3.0), ("a", 20, 3.0), ("a", 30, 4.0), ("b", 20, 7.0), ("b", 30, 7.0)]
    newest = snapshot.snapshot_when(df, GRID, "k", "ts", "seq")
    assert values(newest.withColumn("at", F.second("SnapTime")), "k", "at", "x") == [("a", 30, 4.0), ("b", 30, 7.0)]
