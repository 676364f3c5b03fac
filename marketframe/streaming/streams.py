"""Streams: latest rows, enrichment, decayed means, snapshots, first-seen keys and bars.

Results that change over time are written as one folder of changed rows per micro-batch, under the
path the caller gives (a shared folder). Writing a batch replaces its folder, so a batch that is
run again after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.decay import decay_stats, last_states, merge_states
from ..operators.relational import Names, as_list, last_by, last_by_agg, natural_join
from ..plans.market import BarSize, bars_from_ticks

BATCH = "__batch"


def read_files(spark: SparkSession, path: str, schema, glob: str | None = None, format: str = "parquet", **options):
    """Files of a folder as an append stream; new files are new rows."""
    reader = spark.readStream.format(format).schema(schema).options(**options)
    return reader.load(path, **({"pathGlobFilter": glob} if glob else {}))


def start(
    stream: DataFrame,
    checkpoint: str,
    batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run ``batch`` per micro-batch; over what is there now, or periodically with ``every``."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(batch).start()


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def write_changes(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for changed rows: the later batch's row of a key replaces the earlier one."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(_folder(path, batch_id))

    return batch


def read_changes(spark: SparkSession, path: str, keys: Names) -> DataFrame:
    """Current rows of a folder of changes."""
    return last_by(spark.read.parquet(path), keys, BATCH).drop(BATCH)


def compact_changes(spark: SparkSession, path: str, target: str, keys: Names) -> None:
    """Current rows rewritten as the first batch of a new folder of changes."""
    read_changes(spark, path, keys).write.mode("overwrite").parquet(_folder(target, -1))


def last_by_stream(stream: DataFrame, keys: Names, order: Names) -> DataFrame:
    """Latest row per key, kept current (for update or complete mode)."""
    return last_by_agg(stream, keys, order)


def upsert_last_rows(stream: DataFrame, keys: Names, order: Names, path: str, checkpoint: str, every=None):
    """Keep the latest row per key in a folder of changes: order status, updating bars, positions."""
    return start(last_by_stream(stream, keys, order), checkpoint, write_changes(path), "update", every)


def snapshot_periodically(
    stream: DataFrame, keys: Names, order: Names, path: str, checkpoint: str, every: str | None, stamp="SnapTime"
):
    """At every trigger, all latest rows stamped with the trigger time."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        stamped = rows.withColumn(stamp, F.current_timestamp())
        stamped.write.mode("overwrite").parquet(_folder(path, batch_id))

    return start(last_by_stream(stream, keys, order), checkpoint, batch, "complete", every)


def enrich_stream(
    stream: DataFrame,
    read_dimension: Callable[[], DataFrame],
    on: Names,
    joins: Names | None,
    path: str,
    checkpoint: str,
    every: str | None = None,
):
    """Rows with the columns of a dimension that is read again for every micro-batch. A request is
    logged before its answers arrive, so a row's dimension row is there by then; rows without one
    keep NULLs."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        natural_join(rows, read_dimension(), on, joins).write.mode("overwrite").parquet(_folder(path, batch_id))

    return start(stream, checkpoint, batch, "append", every)


def decay_stream(
    stream: DataFrame,
    ts: str,
    tau: timedelta,
    by: Names,
    column: str,
    mean: str,
    std: str,
    path: str,
    states: str,
    checkpoint: str,
    seq: Names | None = None,
    block: int | None = None,
    every: str | None = None,
):
    """Time-decayed mean and deviation of a stream whose rows arrive in time order per key.

    A micro-batch is computed like a table, continued from the states that earlier ones stored, so a
    busy key is spread over tasks here too. Each batch stores the states of its own keys only, in its
    own folder; every ``COMPACT`` batches the states of all keys are written anew, so that at most
    that many folders are read. Which folders those are follows from the batch's number, so a
    repeated batch is harmless.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = _states_before(spark, states, batch_id, by)
        stats = decay_stats(rows, ts, tau, by, {mean: column}, {std: column}, seq, block, before)
        stats.write.mode("overwrite").parquet(_folder(path, batch_id))
        done = spark.read.parquet(_folder(path, batch_id))
        after = last_states(done, by, ts, {column: (mean, std)}, seq)
        after.write.mode("overwrite").parquet(_folder(states, batch_id))
        if batch_id and batch_id % COMPACT == 0:
            whole = _states_before(spark, states, batch_id + 1, by, compacted=batch_id - COMPACT)
            whole.write.mode("overwrite").parquet(_folder(f"{states}-whole", batch_id))

    return start(stream, checkpoint, batch, "append", every)


#: Batches between rewrites of all states.
COMPACT = 16


def _states_before(spark: SparkSession, states: str, batch_id: int, by: Names, compacted: int | None = None) -> DataFrame | None:
    """States after the batches before ``batch_id``: the last rewrite (or ``compacted``) and what changed since."""
    if not batch_id:
        return None
    whole = (batch_id - 1) // COMPACT * COMPACT if compacted is None else compacted
    first = [spark.read.parquet(_folder(f"{states}-whole", whole))] if whole else [spark.read.parquet(_folder(states, 0))]
    changed = [_folder(states, i) for i in range(whole + 1, batch_id)]
    return merge_states(first[0], spark.read.parquet(*changed), by) if changed else first[0]


def first_seen(stream: DataFrame, keys: Names, ts: str | None = None, watermark: str | None = None) -> DataFrame:
    """First row per key. With a watermark, keys are remembered only that long."""
    if watermark is None:
        return stream.dropDuplicates(as_list(keys))
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(as_list(keys))


def bars_stream(
    ticks: DataFrame,
    size: BarSize,
    keys: Names,
    ts: str = "Timestamp",
    seq: str = "Seq",
    price: str = "Price",
    volume: str | None = "Size",
    watermark: str | None = "1 day",
) -> DataFrame:
    """Bars of a fixed length over a stream. Append mode emits bars that the watermark has finished;
    update mode keeps the current bar up to date. State is dropped behind the watermark, and rows that
    come later than it are left out; ``watermark=None`` keeps all state for ever."""
    if size.seconds is None:
        raise ValueError(f"No fixed length: {size.value}")
    rows = ticks.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    window = F.window(ts, f"{size.seconds} seconds")
    bars = bars_from_ticks(rows, size, keys, ts, seq, price, volume, window)
    return bars.withColumn("Timestamp", F.col("Timestamp.start"))


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a run over available data to finish; its failure is raised."""
    query.awaitTermination()


def tables_to_append(streams: Mapping[str, DataFrame], path: str, checkpoint: str) -> list[StreamingQuery]:
    """Append each raw stream to its own folder."""
    return [
        df.writeStream.outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(availableNow=True)
        .format("parquet")
        .start(f"{path}/{name}")
        for name, df in streams.items()
    ]
