"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CHECKPOINT_DIR, shared_dir

#: Characters that separate words, inside a regular expression's brackets.
SPACES = r"\x20\x09-\x0D"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the cluster's shared folder: later jobs read it instead of redoing the work.

    A lost executor loses none of it, and the plan starts anew from the files.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside hand Python functions batches of at most so many rows; the session's setting then is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    # No limit is 0 or less.
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that ``spark.checkpoint.dir`` names, or one of our own if it is unset."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(df.sparkSession.conf.get(CHECKPOINT_DIR, None) or shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once even if ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def starts(sizes: Column) -> Column:
    """Where each of a row of parts starts, from structs of the ``gap`` before it and its own ``size``.

    Prefix sums in two levels of 64, so that they need no array that grows element by element.
    """
    step = 64

    def summed(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x["gap"] + x["size"])

    def of(all_sizes: Column) -> Column:
        def blocks(sums: Column) -> Column:
            before = F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, x: a + x))
            return let(
                before,
                lambda at: F.transform(
                    all_sizes,
                    lambda x, i: F.get(at, F.floor(i / step).cast("int"))
                    + summed(F.slice(all_sizes, (F.floor(i / step) * step + 1).cast("int"), i % step))
                    + x["gap"],
                ),
            )

        count = F.ceil(F.size(all_sizes) / step).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count - 1), lambda b: summed(F.slice(all_sizes, b * step + 1, F.lit(step))))
        return let(sums, blocks)

    return let(sizes, of)


def remainder(key: str, n: int) -> Column:
    """crc32 of a key as text, modulo ``n``; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` rows, else as it is (a shuffled join follows)."""
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(df: DataFrame) -> DataFrame:
    """``df``; sends this package's modules to the executors once a session, for functions that run there."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_package_shipped", False):
        package = Path(__file__).resolve().parent.parent
        handle, path = tempfile.mkstemp(suffix=".zip", prefix=f"{package.name}-")
        os.close(handle)
        with zipfile.ZipFile(path, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(path)
        context._package_shipped = True
    return df
