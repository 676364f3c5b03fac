"""Rows of a table as micro-batches in time order, with a restart of the stream between each two."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timefmt import micros
from ..session import shared_dir
from ..streaming.streams import run_to_end


def run_in_batches(t, name: str, run: Callable[[DataFrame, str, str], StreamingQuery], rows: DataFrame | None = None, n: int = 4) -> str:
    """Write ``rows`` (the events) in ``n`` folders by time, and ``run(stream, out, checkpoint)`` once for each.

    One parted write makes the folders. A run sees the folders so far and, by its checkpoint, takes the
    files that it hasn't seen; so each is a micro-batch of its own, after a restart. Rows without a time are in
    the first. Gives the folder whose ``out`` the runs wrote.
    """
    rows = t.events if rows is None else rows
    folder = shared_dir(t.spark, name)
    us = micros(F.col("ts"))
    ends = rows.agg(F.min(us).alias("low"), F.max(us).alias("high")).first()
    low, length = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0) + 1
    part = F.coalesce(F.least(F.floor((us - low) * n / length), F.lit(n - 1)), F.lit(0)).cast("int")
    rows.withColumn("__part", part).write.partitionBy("__part").parquet(f"{folder}/in")
    found = {r[0] for r in t.spark.read.parquet(f"{folder}/in").select("__part").distinct().collect()}
    for i in range(n):
        if i not in found:
            continue
        seen = ",".join(str(p) for p in sorted(found) if p <= i)
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in/__part={{{seen}}}").select(*rows.columns)
        run_to_end(run(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return folder
