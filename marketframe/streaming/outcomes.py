"""Request outcomes over streams: errors described by code, and flows that stop when they are cancelled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.outcomes import enrich_errors, first_texts, known_codes
from ..operators.relational import Names, without_keys
from .changes import Changes
from .streams import start, write_changes


def _first(rows: DataFrame) -> DataFrame:
    """The text of the earliest batch; a code is learned in one batch only, unless that batch ran twice."""
    return rows.groupBy("ErrorCode").agg(F.min_by("ErrorDescription", "Learned").alias("ErrorDescription"), F.min("Learned").alias("Learned"))


def learned_texts(path: str) -> Changes:
    """First texts of codes: one row a code, so few rows whatever the length of the log."""
    return Changes(path, "ErrorCode", merge=_first, buckets=1)


def enrich_errors_stream(
    stream: DataFrame, codes: DataFrame, order: Names, path: str, texts: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Errors with description and note, one folder a batch.

    A code absent from ``codes`` is described by the first text that ever came with it: of the first batch
    that has the code, in ``order`` within it. Texts learned so far are kept under ``texts`` and joined to
    their batch and all later ones by broadcast, if they are few; a batch that is run again learns the same.
    """
    learned, write = learned_texts(texts), write_changes(path)

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        learned.forget(spark, batch_id)
        unknown = known_codes(rows, codes).filter(F.col("__known").isNull())
        if learned.folders(spark):
            unknown = without_keys(unknown, learned.read(spark), "ErrorCode")
        learned.write(first_texts(unknown, order).withColumn("Learned", F.lit(batch_id).cast("long")), batch_id)
        write(enrich_errors(rows, codes, order, learned.read(spark).drop("Learned")), batch_id)

    return start(stream, checkpoint, batch, "append", every)


def active_stream(rows: DataFrame, cancels: DataFrame, at: str, within: str, delay: str) -> DataFrame:
    """Rows of a stream whose request wasn't cancelled in the time ``within`` before them.

    A request that is cancelled sends nothing after a while, so a cancel is remembered only that long; a row
    waits until no cancel from before it can come any more, which the watermarks (``delay`` behind the
    latest time of either stream) decide. State is therefore what ``within`` and ``delay`` hold. Rows
    of no request pass; rows that come later than ``delay``, or without a time, are left out. Quiet streams
    need heartbeats (of any request number) in both, as only later rows move the watermarks.
    """
    timed = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    stops = cancels.select(F.col("RequestId").alias("__RequestId"), F.col("CancelTime").cast("timestamp").alias("__CancelTime"))
    stops = stops.withWatermark("__CancelTime", delay)
    behind = F.expr(f"RequestId = __RequestId AND __CancelTime < {at} AND __CancelTime >= {at} - INTERVAL {within}")
    return timed.join(stops, behind, "leftOuter").filter("__CancelTime IS NULL").drop("__RequestId", "__CancelTime")
