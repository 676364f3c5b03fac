"""Regular time grids and snapshots of the latest row per key at each grid time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.timefmt import micros
from .ordered import US, to_micros
from .relational import Names, as_list, last_by


def _epoch_micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@dataclass(frozen=True)
class TimeGrid:
    """Trigger times ``start, start + period, ...`` up to and including ``end``."""

    start: datetime
    end: datetime
    period: timedelta

    @property
    def first(self) -> int:
        return _epoch_micros(self.start)

    @property
    def step(self) -> int:
        return to_micros(self.period)

    @property
    def count(self) -> int:
        return (_epoch_micros(self.end) - self.first) // self.step + 1

    @property
    def last(self) -> int:
        return self.first + (self.count - 1) * self.step

    def frame(self, spark: SparkSession, name: str = "Timestamp") -> DataFrame:
        """The trigger times as a table."""
        at = F.lit(self.first) + F.col("id") * F.lit(self.step)
        return spark.range(self.count).select(F.timestamp_micros(at).alias(name))

    def tick_of(self, us: Column) -> Column:
        """First trigger time at or after a time, in microseconds."""
        past = F.greatest(us - F.lit(self.first), F.lit(0))
        return F.lit(self.first) + past + F.pmod(-past, F.lit(self.step))


def snapshot_when(
    df: DataFrame,
    grid: TimeGrid,
    keys: Names,
    ts: str,
    seq: Names | None = None,
    stamp: str = "SnapTime",
    history: bool = False,
) -> DataFrame:
    """Latest row per key at the grid's newest trigger, or at every trigger with ``history``.

    Rows are cut to one per (key, trigger) before the shuffle; each then covers the triggers up to
    the key's next row, so nothing is matched against the grid.
    """
    keys = as_list(keys)
    rows = df.withColumn(US, micros(F.col(ts))).filter(F.col(US) <= F.lit(grid.last))
    order = [US, *as_list(seq)]
    if not history:
        newest = last_by(rows, keys, order)
        return newest.withColumn(stamp, F.timestamp_micros(F.lit(grid.last))).drop(US)
    latest = last_by(rows.withColumn("__tick", grid.tick_of(F.col(US))), [*keys, "__tick"], order)
    following = F.lead("__tick").over(Window.partitionBy(*keys).orderBy("__tick"))
    until = F.coalesce(following - F.lit(grid.step), F.lit(grid.last))
    ticks = F.sequence(F.col("__tick"), F.col("__until"), F.lit(grid.step))
    return (
        latest.withColumn("__until", until)
        .withColumn(stamp, F.explode(ticks))
        .withColumn(stamp, F.timestamp_micros(stamp))
        .drop(US, "__tick", "__until")
    )
