"""First-seen keys in bounded memory.

Known keys lie in files parted by a hash of the key, with a Bloom filter a part. A micro-batch's keys
are made distinct before the shuffle, which cuts a hot key down in the tasks that read it. Keys that no
filter knows are new without reading any file; only the parts of the others are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import Names, as_list, without_keys
from .changes import BUCKET, Changes
from .streams import BATCH, start, write_changes

#: Bits of one row of a filter, as Spark's bitmap functions have them.
ROW_BITS = 32768
#: Places that a key takes in its part's filter.
HASHES = 2
PART = "__part"


def _or(rows: DataFrame) -> DataFrame:
    return rows.groupBy(BUCKET + "_of", PART).agg(F.expr("bitmap_or_agg(bits)").alias("bits"))


class KnownKeys:
    """Keys seen so far, under a path.

    ``filter_rows`` rows of ``ROW_BITS`` bits make a part's filter: with 8 rows 1 % of unknown keys are
    looked up in vain at about 14,000 keys a part. All filters together have ``buckets * filter_rows * 4``
    KB whatever the number of keys, which bounds what is broadcast.
    """

    def __init__(self, path: str, keys: Names, buckets: int = 64, filter_rows: int = 8):
        self.names, self.filter_rows = as_list(keys), filter_rows
        self.keys = Changes(f"{path}/keys", keys, buckets=buckets)
        self.filters = Changes(f"{path}/filters", [BUCKET + "_of", PART], merge=_or, buckets=1)
        self.held: list[DataFrame] = []

    def _places(self, rows: DataFrame) -> DataFrame:
        """A row for each place of each key in its part's filter, counted from 1."""
        bits = self.filter_rows * ROW_BITS
        places = [F.pmod(F.xxhash64(F.lit(i), *self.names), F.lit(bits)) for i in range(1, HASHES + 1)]
        rows = rows.select(*self.names, self.keys.bucket().alias(BUCKET + "_of"), F.explode(F.array(*places)).alias("__place"))
        return rows.withColumn(PART, F.floor(F.col("__place") / ROW_BITS)).withColumn("__bit", F.col("__place") % ROW_BITS)

    def split(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None, list[int]]:
        """Keys of ``rows`` that are surely new, those that may be known (None at first), and the latters' parts."""
        spark = rows.sparkSession
        keys = rows.select(*self.names).distinct()
        if not self.filters.folders(spark):
            return keys, None, []
        filters = F.broadcast(self.filters.read(spark))
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.coalesce(F.getbit(byte, (F.col("__bit") % 8).cast("int")), F.lit(0))
        tested = self._places(keys).join(filters, [BUCKET + "_of", PART], "left").withColumn("__set", is_set)
        found = tested.groupBy(*self.names, BUCKET + "_of").agg(F.min("__set").alias("__maybe")).persist()
        self.held.append(found)
        parts = [r[0] for r in found.filter("__maybe = 1").select(BUCKET + "_of").distinct().collect()]
        return found.filter("__maybe = 0").select(*self.names), found.filter("__maybe = 1").select(*self.names), sorted(parts)

    def new(self, rows: DataFrame) -> DataFrame:
        """Keys of ``rows`` not seen before, each once; NULL is a key like others."""
        fresh, maybe, parts = self.split(rows)
        if not parts:
            return fresh
        known = self.keys.read(rows.sparkSession, parts)
        return fresh.unionByName(without_keys(maybe, known, self.names))

    def add(self, new: DataFrame, batch_id: int) -> None:
        """Remember the keys of a batch; run again with the same batch it leaves the same."""
        self.keys.write(new, batch_id)
        bits = F.expr("bitmap_construct_agg(__bit)").alias("bits")
        self.filters.write(self._places(new).groupBy(BUCKET + "_of", PART).agg(bits), batch_id)
        while self.held:
            self.held.pop().unpersist()


def first_seen_stream(stream: DataFrame, keys: Names, path: str, state: str, checkpoint: str, every: str | None = None, **of) -> StreamingQuery:
    """Write each key once, in the folder of the batch that brought it first.

    State is what ``KnownKeys`` writes; no key stays in memory. A batch that is run again after a failure
    starts from the keys known before it.
    """
    known = KnownKeys(state, keys, **of)
    write = write_changes(path)

    def batch(rows: DataFrame, batch_id: int) -> None:
        # What an earlier run of this batch remembered would make its keys known ones.
        for table in (known.keys, known.filters):
            table.forget(rows.sparkSession, batch_id)
        write(known.new(rows), batch_id)
        new = rows.sparkSession.read.parquet(f"{path}/{BATCH}={batch_id}")
        known.add(new, batch_id)

    return start(stream.select(*as_list(keys)), checkpoint, batch, "append", every)

