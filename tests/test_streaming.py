import math
import random
from datetime import datetime, timedelta

import pytest

from marketframe.operators.decay import decay_stats
from marketframe.operators.outcomes import active_only
from marketframe.operators.relational import last_by
from marketframe.plans.market import BarSize, bars_from_ticks
from marketframe.session import shared_dir
from marketframe.streaming import streams as s

SCHEMA = "k string, ts timestamp_ntz, seq long, x double"


@pytest.fixture
def source(spark, tmp_path):
    """A folder with three files in time order, read one file per micro-batch."""
    rng = random.Random(4)
    rows, t = [], 0.0
    for i in range(90):
        t += rng.random() * 40
        rows.append((rng.choice("ab") if i < 80 else "c", datetime(2024, 1, 1) + timedelta(seconds=round(t, 3)), i, rng.uniform(0, 9)))
    for part in range(3):
        df = spark.createDataFrame(rows[part * 30 : part * 30 + 30], SCHEMA).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def stream(spark, source):
    return s.read_files(spark, source, spark.read.parquet(source).schema, maxFilesPerTrigger=1)


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("out", "states", "checkpoint")}


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_latest_rows_equal_batch(spark, source, paths):
    s.run_to_end(s.upsert_last_rows(stream(spark, source), "k", ["ts", "seq"], paths["out"], paths["checkpoint"]))
    now = s.read_changes(spark, paths["out"], "k")
    assert same(now, last_by(spark.read.parquet(source), "k", ["ts", "seq"]))
    s.compact_changes(spark, paths["out"], paths["states"], "k")
    assert same(now, s.read_changes(spark, paths["states"], "k"))


def test_decay_continues_over_batches(spark, source, paths):
    q = s.decay_stream(
        stream(spark, source), "ts", timedelta(minutes=2), "k", "x", "m", "sd", paths["out"], paths["states"], paths["checkpoint"], "seq"
    )
    s.run_to_end(q)
    assert spark.read.parquet(paths["out"]).select(s.BATCH).distinct().count() == 3
    got = {r.seq: (r.m, r.sd) for r in spark.read.parquet(paths["out"]).collect()}
    batch = decay_stats(spark.read.parquet(source), "ts", 120, "k", {"m": "x"}, {"sd": "x"}, "seq").collect()
    assert len(batch) == len(got) == 90
    for r in batch:
        m, sd = got[r.seq]
        assert math.isclose(m, r.m, abs_tol=1e-9)
        assert (sd is None) == (r.sd is None) and (sd is None or math.isclose(sd, r.sd, abs_tol=1e-7))


def test_bars(spark, source, paths):
    bars = s.bars_stream(stream(spark, source), BarSize.MIN_1, "k", "ts", "seq", "x", None)
    s.run_to_end(s.start(bars, paths["checkpoint"], s.write_changes(paths["out"]), "update"))
    now = s.read_changes(spark, paths["out"], ["k", "Timestamp"])
    assert same(now, bars_from_ticks(spark.read.parquet(source), BarSize.MIN_1, "k", "ts", "seq", "x", None))


def test_finished_bars_with_watermark(spark, source, paths):
    bars = s.bars_stream(stream(spark, source), BarSize.MIN_1, "k", "ts", "seq", "x", None, watermark="10 seconds")
    s.run_to_end(s.start(bars, paths["checkpoint"], s.write_changes(paths["out"]), "append"))
    done = spark.read.parquet(paths["out"]).drop(s.BATCH)
    whole = bars_from_ticks(spark.read.parquet(source), BarSize.MIN_1, "k", "ts", "seq", "x", None)
    assert 0 < done.count() < whole.count()
    assert done.join(whole, done.columns[:2], "left_anti").count() == 0
    with pytest.raises(ValueError, match="No fixed length"):
        s.bars_stream(stream(spark, source), BarSize.MONTH_1, "k", "ts", "seq", "x")


def test_dimension_is_read_again(spark, source, paths):
    seen = []

    def dimension():
        # Key c becomes known after the first batch only.
        known = "abc" if seen else "ab"
        seen.append(known)
        return spark.createDataFrame([(k, k.upper()) for k in known], "k string, name string")

    q = s.enrich_stream(stream(spark, source), dimension, "k", "name", paths["out"], paths["checkpoint"])
    s.run_to_end(q)
    out = spark.read.parquet(paths["out"])
    assert len(seen) == 3 and out.count() == 90 and out.filter("name IS NULL").count() == 0


def test_first_seen(spark, source, paths):
    s.run_to_end(s.start(s.first_seen(stream(spark, source).select("k"), "k"), paths["checkpoint"], s.write_changes(paths["out"])))
    assert sorted(r.k for r in spark.read.parquet(paths["out"]).collect()) == ["a", "b", "c"]
    assert s.first_seen(stream(spark, source), "k", "ts", "1 hour").isStreaming


def test_snapshots(spark, source, paths):
    s.run_to_end(s.snapshot_periodically(stream(spark, source), "k", ["ts", "seq"], paths["out"], paths["checkpoint"], None))
    snaps = spark.read.parquet(paths["out"])
    assert snaps.groupBy(s.BATCH).count().count() == 3 and "SnapTime" in snaps.columns
    newest = last_by(snaps, "k", s.BATCH)
    assert same(newest.select("k", "seq"), last_by(spark.read.parquet(source), "k", ["ts", "seq"]))


def test_raw_streams_are_appended(spark, source, paths):
    for q in s.tables_to_append({"ticks": stream(spark, source)}, paths["out"], paths["checkpoint"]):
        s.run_to_end(q)
    assert same(spark.read.parquet(paths["out"] + "/ticks"), spark.read.parquet(source))


def test_cancelled_flow_stops(spark, source, paths):
    cancels = spark.sql("SELECT 'a' AS RequestId, timestamp_ntz'2024-01-01 00:05:00' AS CancelTime")
    rows = stream(spark, source).withColumnRenamed("k", "RequestId")
    s.run_to_end(s.start(active_only(rows, cancels, "ts"), paths["checkpoint"], s.write_changes(paths["out"])))
    want = spark.read.parquet(source).filter("k <> 'a' OR ts <= timestamp_ntz'2024-01-01 00:05:00'")
    assert same(spark.read.parquet(paths["out"]).select("seq"), want)


def test_a_repeated_batch_leaves_the_same_result(spark, source, paths):
    rows = spark.read.parquet(source)
    write = s.write_changes(paths["out"])
    write(rows, 0)
    write(rows, 0)
    assert spark.read.parquet(paths["out"]).count() == 90


def test_shared_dir_follows_the_session(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root) and shared_dir(spark, "x") != shared_dir(spark, "x")

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Cluster:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        shared_dir(Cluster(), "x")


