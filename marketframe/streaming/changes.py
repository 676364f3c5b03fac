"""Current rows of a stream, kept as mergeable changes in levels.

Every micro-batch writes its changed rows as one folder. When a level has ``fan`` folders they are merged
into one of the next level, so a table of any number of batches is a few folders. A manifest, written
last, names the folders that are valid after a batch: a batch that failed or is run again starts from
the manifest before it, and readers never see half a merge. Folders are parted by a hash of the key.

One path belongs to one checkpoint, as batches are known by their number.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import Names, as_list, last_by
from .streams import start

FOLDER, BUCKET, VERSION = "__folder", "__bucket", "__version"


class Changes:
    """A table of one row per key.

    ``merge`` makes one row per key of several (sums of moments, bars); by default the row of the latest
    batch replaces earlier ones. ``buckets`` is the number of parts by key.
    """

    def __init__(self, path: str, keys: Names, merge: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 8, fan: int = 4):
        self.path, self.keys, self.merge, self.buckets, self.fan = path, as_list(keys), merge, buckets, fan

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch's rows, at most one per key. Merging moves a row at most once a level."""
        spark = rows.sparkSession
        before = self._manifest(spark, batch_id - 1) if batch_id > 0 else None
        folders = list(before["folders"]) if before else []
        if self.merge is None:
            rows = rows.withColumn(VERSION, F.lit(batch_id).cast("long"))
        folders.append(self._stored(rows, f"0-{batch_id}"))
        level = 0
        while len(same := [f for f in folders if f.startswith(f"{level}-")]) >= self.fan:
            merged = self._merged(self._read(spark, same, rows.schema))
            level += 1
            folders = [f for f in folders if f not in same] + [self._stored(merged, f"{level}-{batch_id}")]
        manifest = json.dumps({"folders": folders, "schema": rows.schema.json()})
        one = spark.range(1).select(F.lit(manifest).alias("value"))
        one.coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/{batch_id}")

    def sink(self) -> Callable[[DataFrame, int], None]:
        return self.write

    def folders(self, spark: SparkSession) -> list[str]:
        """Names of the folders that hold the table now."""
        now = self._latest(spark)
        return now["folders"] if now else []

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The current rows, of some buckets only if given; these are the only files read then."""
        now = self._latest(spark)
        if now is None:
            raise ValueError(f"No batch was written: {self.path}")
        rows = self._read(spark, now["folders"], T.StructType.fromJson(json.loads(now["schema"])))
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        return self._merged(rows).drop(VERSION)

    def bucket(self) -> F.Column:
        """The bucket of a row, by its key."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Delete folders that neither the latest manifest nor the one before names; what they held was merged."""
        ids = self._ids(spark)
        valid = {f for i in ids[-2:] for f in self._manifest(spark, i)["folders"]}
        gone = [n for n in _children(spark, f"{self.path}/data") if n.startswith(f"{FOLDER}=") and n.partition("=")[2] not in valid]
        for name in gone:
            fs, path = _file_system(spark, f"{self.path}/data/{name}")
            fs.delete(path, True)
        return gone

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Take back a batch and what followed: its manifests go, so the table is as the batch before left it."""
        for i in self._ids(spark):
            if i >= batch_id:
                fs, path = _file_system(spark, f"{self.path}/manifest/{i}")
                fs.delete(path, True)

    def _merged(self, rows: DataFrame) -> DataFrame:
        rows = rows.drop(FOLDER, BUCKET)
        return self.merge(rows) if self.merge else last_by(rows, self.keys, VERSION)

    def _stored(self, rows: DataFrame, name: str) -> str:
        parted = rows.withColumn(BUCKET, self.bucket()).repartition(self.buckets, BUCKET)
        parted.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/{FOLDER}={name}")
        return name

    def _read(self, spark: SparkSession, names: Sequence[str], schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        paths = [f"{self.path}/data/{FOLDER}={n}" for n in names]
        return spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*paths)

    def _manifest(self, spark: SparkSession, batch_id: int) -> dict:
        return json.loads(spark.read.text(f"{self.path}/manifest/{batch_id}").first()[0])

    def _ids(self, spark: SparkSession) -> list[int]:
        names = [n for n in _children(spark, f"{self.path}/manifest") if n.lstrip("-").isdigit()]
        return sorted(int(n) for n in names if "_SUCCESS" in _children(spark, f"{self.path}/manifest/{n}"))

    def _latest(self, spark: SparkSession) -> dict | None:
        ids = self._ids(spark)
        return self._manifest(spark, ids[-1]) if ids else None


def last_rows(path: str, keys: Names, order: Names, **of) -> Changes:
    """The latest row of each key by ``order``, kept under a path; a row that comes late replaces no later one."""
    return Changes(path, keys, merge=lambda rows: last_by(rows, keys, order), **of)


def keep_last_rows(stream: DataFrame, keys: Names, order: Names, path: str, checkpoint: str, every: str | None = None, **of) -> StreamingQuery:
    """Merge every micro-batch's latest rows into those under ``path``: order status, updating bars, positions.

    No key is held in memory: a batch's rows are cut to one per key before its shuffle, and levels merge.
    """
    kept = last_rows(path, keys, order, **of)
    return start(stream, checkpoint, lambda rows, batch_id: kept.write(last_by(rows, keys, order), batch_id), "append", every)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if it doesn't exist."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
