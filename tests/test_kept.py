"""Results kept by streams: levels of changes, known keys, keyed states, learned texts, cancels, bars and moments."""

import math
import random
import re
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketframe.operators.decay import decay_stats
from marketframe.operators.outcomes import enrich_errors
from marketframe.plans import bar_states, moments
from marketframe.plans.beta_hedge import regress
from marketframe.plans.market import BarSize, bars_from_ticks
from marketframe.streaming import keyed, known_keys, outcomes
from marketframe.streaming import streams as s
from marketframe.streaming.changes import BUCKET, Changes, keep_last_rows, last_rows

START = datetime(2024, 1, 1)


def source(spark, tmp_path, batches, schema, name="in"):
    """A stream of one file a batch."""
    path = str(tmp_path / name)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return s.read_files(spark, path, spark.read.parquet(path).schema, maxFilesPerTrigger=1)


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("out", "state", "checkpoint")}


def buckets_read(df):
    """The parts of the buckets that the scan is cut down to, as its plan states them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert filters
    return {int(n) for f in filters for part in re.findall(rf"{BUCKET}#\d+ (?:IN \(([0-9,]+)\)|= (\d+))", f) for n in "".join(part).split(",")}


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_levels_of_many_batches(spark, tmp_path):
    """Forty batches are a few folders, each key has its latest row, and what was merged can go."""
    rng, table, want = random.Random(1), Changes(str(tmp_path), "k", buckets=3), {}
    for i in range(40):
        rows = {rng.choice([None, *range(30)]): i * 100 + j for j in range(5)}
        want |= rows
        table.write(spark.createDataFrame(list(rows.items()), "k long, v long"), i)
        assert len(table.folders(spark)) <= 9
    assert {r.k: r.v for r in table.read(spark).collect()} == want
    assert len(table.folders(spark)) == 4
    gone = table.vacuum(spark)
    assert len(gone) >= 40 and {r.k: r.v for r in table.read(spark).collect()} == want
    one = table.read(spark, [1])
    assert 0 < one.count() < len(want) and buckets_read(one) == {1}


def test_a_failed_or_repeated_batch_is_harmless(spark, tmp_path):
    calls = []

    def merge(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return rows.groupBy("k").agg(F.sum("v").alias("v"))

    table = Changes(str(tmp_path), "k", merge=merge, buckets=2, fan=3)
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    table.write(one, 0)
    table.write(one, 1)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 2, None: 4}
    with pytest.raises(RuntimeError, match="lost"):
        table.write(one, 2)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 2, None: 4}
    table.write(one, 2)
    table.write(one, 2)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 3, None: 6}
    table.write(one.limit(0), 3)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 3, None: 6}
    table.forget(spark, 2)
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": 2, None: 4}
    with pytest.raises(ValueError, match="No batch"):
        Changes(str(tmp_path / "none"), "k").read(spark)


def test_latest_rows_in_levels(spark, tmp_path, paths):
    """A row that comes late replaces no later one."""
    batches = [[("a", 5, "x"), ("a", 4, "w")], [("a", 3, "late"), ("b", 1, "y")], [(None, 1, "n")], [("b", 2, "z")], [("b", 1, "old"), (None, 0, "m")]]
    stream = source(spark, tmp_path, batches, "k string, n long, v string")
    s.run_to_end(keep_last_rows(stream, "k", "n", paths["out"], paths["checkpoint"]))
    table = last_rows(paths["out"], "k", "n")
    assert {r.k: r.v for r in table.read(spark).collect()} == {"a": "x", "b": "z", None: "n"}
    assert len(table.folders(spark)) == 2


def test_first_seen_keys(spark, tmp_path, paths):
    batches = [[("a", 1), ("b", None), ("a", 1)], [("a", 1), ("c", 2), (None, None)], [("b", None), (None, None), ("d", 4)] + [("a", 1)] * 50]
    stream = source(spark, tmp_path, batches, "k string, n long")
    s.run_to_end(known_keys.first_seen_stream(stream, ["k", "n"], paths["out"], paths["state"], paths["checkpoint"], buckets=8))
    got = sorted((r[s.BATCH], str(r.k)) for r in spark.read.parquet(paths["out"]).collect())
    assert got == [(0, "a"), (0, "b"), (1, "None"), (1, "c"), (2, "d")]
    # More rows after a restart.
    more = source(spark, tmp_path, [[("a", 1), ("e", 5)]], "k string, n long")
    s.run_to_end(known_keys.first_seen_stream(more, ["k", "n"], paths["out"], paths["state"], paths["checkpoint"], buckets=8))
    assert spark.read.parquet(paths["out"]).filter(f"{s.BATCH} = 3").select("k").collect() == [("e",)]


def test_parts_without_known_keys_are_not_read(spark, tmp_path):
    known = known_keys.KnownKeys(str(tmp_path), "k", buckets=32)
    seen = spark.range(200).withColumnRenamed("id", "k")
    known.add(seen, 0)
    fresh, maybe, parts = known.split(spark.range(1000, 1200).withColumnRenamed("id", "k"))
    assert fresh.count() >= 198 and len(parts) <= 2
    asked = seen.filter("k IN (7, 70)").unionByName(spark.createDataFrame([(5000,)], "k long"))
    fresh, maybe, parts = known.split(asked)
    assert sorted(r.k for r in maybe.collect()) == [7, 70] and 1 <= len(parts) <= 2
    assert buckets_read(known.keys.read(spark, parts)) == set(parts)
    assert [r.k for r in known.new(asked).collect()] == [5000]


def test_keyed_states(spark, tmp_path, paths):
    """As the batch form has it, over batches and a restart; late, missing and undated values change nothing."""
    rng, rows, t = random.Random(4), [], 0.0
    for i in range(120):
        t += rng.random() * 40
        at = START + timedelta(seconds=round(t, 3))
        rows.append((rng.choice(["a", "b", None]), at, i, None if rng.random() < 0.1 else rng.uniform(0, 9)))
    rows.append(("c", START, 500, 1.0))
    schema = "_k string, ts timestamp_ntz, seq long, x double"
    stream = source(spark, tmp_path, [rows[:40], rows[40:80]], schema)
    go = lambda st: s.run_to_end(keyed.decayed_stream(st, "ts", 120, "_k", "x", "m", "sd", paths["out"], paths["checkpoint"], "seq"))
    go(stream)
    late = [("a", START, 900, 100.0), ("b", None, 901, 100.0)]
    go(source(spark, tmp_path, [rows[80:], late], schema))
    got = {r.seq: (r.m, r.sd) for r in spark.read.parquet(paths["out"]).collect()}
    batch = decay_stats(spark.createDataFrame(rows, schema), "ts", 120, "_k", {"m": "x"}, {"sd": "x"}, "seq").collect()
    assert len(batch) == len(rows) and len(got) == len(rows) + 2
    for r in batch:
        for mine, want in zip(got[r.seq], (r.m, r.sd)):
            assert (mine is None) == (want is None) and (mine is None or math.isclose(mine, want, abs_tol=1e-7))
    last = {k: max((r for r in batch if r["_k"] == k), key=lambda r: r.seq) for k in "ab"}
    assert math.isclose(got[900][0], last["a"].m) and math.isclose(got[901][0], last["b"].m)
    assert got[500] == (1.0, None)


def test_states_end(spark, tmp_path, paths):
    """A key that is away longer than states live starts anew."""
    stream = source(spark, tmp_path, [[("a", START, 1.0)], [("a", START + timedelta(seconds=60), 5.0)]], "k string, ts timestamp, x double")
    live = timedelta(milliseconds=1)
    with pytest.raises(ValueError, match="needs a period"):
        keyed.decayed_stream(stream, "ts", 60, "k", "x", "m", "sd", paths["out"], paths["checkpoint"], time_to_live=live)
    query = keyed.decayed_stream(stream, "ts", 60, "k", "x", "m", "sd", paths["out"], paths["checkpoint"], time_to_live=live, every="1 second")
    until = time.monotonic() + 60
    while query.isActive and time.monotonic() < until and not (query.lastProgress and query.lastProgress["batchId"] >= 2):
        time.sleep(0.5)
    query.stop()
    assert sorted(r.m for r in spark.read.parquet(paths["out"]).collect()) == [1.0, 5.0]


def test_texts_are_learned_over_batches(spark, tmp_path, paths):
    codes = spark.createDataFrame([(1, "known", "a note"), (2, "plain", "")], "ErrorCode long, Message string, Note string")
    schema = "ErrorCode long, Seq long, Error string"
    batches = [[(9, 2, "second"), (9, 1, "first"), (1, 3, "x"), (None, 4, "no code")], [(2, 5, "y"), (7, 6, "seven")], [(9, 7, "third"), (7, 8, "again"), (None, 9, "still none")]]
    stream = source(spark, tmp_path, batches, schema)
    s.run_to_end(outcomes.enrich_errors_stream(stream, codes, "Seq", paths["out"], paths["state"], paths["checkpoint"]))
    out = spark.read.parquet(paths["out"])
    want = {1: ("first", None), 2: ("first", None), 3: ("known", "a note"), 4: ("no code", None), 5: ("plain", None), 6: ("seven", None), 7: ("first", None), 8: ("seven", None), 9: ("no code", None)}
    assert {r.Seq: (r.ErrorDescription, r.Note) for r in out.collect()} == want
    every = spark.createDataFrame([r for b in batches for r in b], schema)
    assert same(enrich_errors(every, codes, "Seq"), out)
    assert outcomes.learned_texts(paths["state"]).read(spark).count() == 3


def test_first_texts_by_time_and_number(spark):
    rows = spark.createDataFrame([(9, START, 2, "b"), (9, START, 1, "a"), (9, START + timedelta(1), 0, "c")], "ErrorCode long, At timestamp, Seq long, Error string")
    none = spark.sql("SELECT 1L AS ErrorCode, '' AS Message, '' AS Note")
    for order in (["At", "Seq"], ["At", "Seq", "Error"]):
        assert {r.ErrorDescription for r in enrich_errors(rows, none, order).collect()} == {"a"}
    plan = enrich_errors(rows, none, ["At", "Seq"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_cancelled_flow(spark, tmp_path, paths):
    def at(minutes):
        return START + timedelta(minutes=minutes)

    flow = [[(1, at(0), 0), (2, at(1), 1)], [(1, at(5), 2), (1, at(10), 3), (2, at(11), 4), (None, at(11), 5)], [(1, at(12), 6), (2, at(30), 7)], [(1, at(100), 8), (-1, at(400), 9)]]
    stops = [[(1, at(5))], [(1, at(11)), (1, at(90)), (-1, at(400))]]
    rows = source(spark, tmp_path, flow, "RequestId long, ts timestamp, n long")
    cancels = source(spark, tmp_path, stops, "RequestId long, CancelTime timestamp", "stops")
    active = outcomes.active_stream(rows, cancels, "ts", "30 MINUTES", "20 minutes")
    query = s.start(active, paths["checkpoint"], s.write_changes(paths["out"]))
    s.run_to_end(query)
    # Stopped at 5 for the time that a cancel counts; the row at 5 came with the cancel, so it stays.
    assert sorted(r.n for r in spark.read.parquet(paths["out"]).collect() if r.n != 9) == [0, 1, 2, 4, 5, 7]
    held = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert held <= 2


TICK = "k string, Timestamp timestamp_ntz, Seq long, Price double, Size long"


def ticks(seed, n=400):
    rng = random.Random(seed)
    at = [START + timedelta(seconds=rng.choice([0, 1, 86400 * 40, rng.randrange(86400 * 3)]) + rng.randrange(100) / 100) for _ in range(n)]
    return [(rng.choice(["a", "b", None]), t, i if rng.random() < 0.9 else None, rng.choice([None, 0.0, rng.uniform(1, 9), 5.0]), rng.choice([None, 0, 3, 10])) for i, t in enumerate(at)]


def close(a, b):
    """Equal rows, numbers up to rounding."""
    key = lambda r: tuple(str(v) for v in (r["k"], r["Timestamp"]))
    a, b = (sorted((r.asDict() for r in df.collect()), key=key) for df in (a, b))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(x[c] == y[c] or math.isclose(x[c], y[c], rel_tol=1e-9) for c in y), (x, y)


def test_bars_of_all_sizes_from_one_pass(spark, tmp_path):
    rows = spark.createDataFrame(ticks(1), TICK)
    rows.write.parquet(str(tmp_path / "ticks"))
    bars = bar_states.bars_of_sizes(spark.read.parquet(str(tmp_path / "ticks")), list(BarSize), "k")
    assert not any("/ticks/" in f for f in bars.inputFiles())
    for size in BarSize:
        close(bars.filter(F.col("BarSize") == size.value).drop("BarSize"), bars_from_ticks(rows, size, "k"))


def test_bars_kept_current(spark, tmp_path, paths):
    """Ticks in any order, also of bars of long ago, over several batches."""
    rows = ticks(2)
    stream = source(spark, tmp_path, [rows[i : i + 80] for i in range(0, 400, 80)], TICK)
    s.run_to_end(bar_states.keep_bars_current(stream, BarSize.HOUR_1, "k", paths["out"], paths["checkpoint"]))
    now = bar_states.finished_bars(bar_states.current_bars(paths["out"], "k").read(spark))
    close(now, bars_from_ticks(spark.createDataFrame(rows, TICK), BarSize.HOUR_1, "k"))


def test_betas_kept_current(spark, tmp_path, paths):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None]), None if rng.random() < 0.1 else 1e6 + rng.gauss(0, 1), None if rng.random() < 0.1 else rng.gauss(0, 2)) for _ in range(300)]
    rows = [(k, 1.0 if k == "c" and x is not None else x, y) for k, x, y in rows] + [("one", 2.0, 3.0), ("none", None, 1.0), ("flat", 1.0, 7.0), ("flat", 2.0, 7.0)]
    schema = "Symbol string, BenchmarkReturn double, Return double"
    stream = source(spark, tmp_path, [rows[i : i + 51] for i in range(0, len(rows), 51)], schema)
    s.run_to_end(moments.keep_betas_current(stream, paths["out"], paths["checkpoint"]))
    kept = moments.current_moments(paths["out"])
    assert len(kept.folders(spark)) <= 4
    got = {r.Symbol: r for r in moments.regression(kept.read(spark)).collect()}
    want = {r.Symbol: r for r in regress(spark.createDataFrame(rows, schema)).collect()}
    assert set(want) - set(got) == {"none"}
    for k, r in got.items():
        for mine, theirs in zip(r[1:], want[k][1:]):
            assert (mine is None) == (theirs is None) and (mine is None or math.isclose(mine, theirs, rel_tol=1e-6, abs_tol=1e-6))
    assert got["c"].Beta is None and got["flat"].R2 == 1.0
