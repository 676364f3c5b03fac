"""Time-decayed mean and deviation as state per key in the state store.

A key's state is three numbers: last time, mean and variance. A micro-batch reads and writes the states
of its own keys only, whatever the number of keys. Spark offers arbitrary state per key to Python
programs through pandas only, so rows pass through Python workers here; ``decay_stream`` is the form in
native expressions, which spreads a busy key's batch over tasks and rewrites folders of states instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.ordered import to_micros
from ..operators.relational import Names, as_list
from .streams import start, write_changes

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _processor(tau_us: int, order: list[str], time_to_live: timedelta | None) -> StatefulProcessor:
    """The processor as a class of its own, so that workers get it by value."""

    class Decayed(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            live = None if time_to_live is None else time_to_live // timedelta(milliseconds=1)
            self.state = handle.getValueState("decayed", "t long, m double, v double", live)

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import math

            import pandas as pd

            batch = pd.concat(list(rows)).sort_values(order, na_position="first", kind="stable")
            t, m, v = self.state.get() if self.state.exists() else (None, None, None)
            means, deviations = [], []
            for at, x in zip(batch["us"], batch["x"]):
                if not (pd.isna(x) or pd.isna(at)):
                    first = t is None
                    if first:
                        t, m, v = int(at), float(x), 0.0
                    else:
                        # A row from before the state counts as of its time.
                        a = math.exp(min(0.0, (t - int(at)) / tau_us))
                        v = a * (v + (1 - a) * (x - m) ** 2)
                        m = a * m + (1 - a) * x
                        t = max(t, int(at))
                    deviations.append(None if first else math.sqrt(v))
                else:
                    deviations.append(None if t is None else math.sqrt(v))
                means.append(m)
            if t is not None:
                self.state.update((t, m, v))
            yield batch.drop(columns=["us", "x"]).assign(mean=pd.Series(means, batch.index, float), std=pd.Series(deviations, batch.index, float))

        def close(self) -> None:
            pass

    return Decayed()


def decayed(stream: DataFrame, ts: str, tau: timedelta | int | float, by: Names, column: str, mean: str, std: str, seq: Names | None = None, time_to_live: timedelta | None = None) -> DataFrame:
    """The key, sequence columns and time of every row with its decayed mean and deviation.

    Rows of a batch are taken in (ts, seq) order; a row from before its key's state has weight 0. NULL values
    and values without a time leave the state as it is, and the first value's deviation is NULL. With
    ``time_to_live`` a key that isn't seen for so long starts anew, so state doesn't grow with all keys
    ever met. A micro-batch's rows of one key meet in one task: the trigger bounds them.
    """
    keys, order = as_list(by), as_list(seq)
    # Workers get rows as named tuples, which have names of their own for some columns: these are safe.
    safe = {c: f"c{i}" for i, c in enumerate([*keys, *order])}
    numbered = stream.select(
        *[F.col(c).alias(n) for c, n in safe.items()], F.col(ts).alias("ts"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.col(column).cast("double").alias("x")
    )
    fields = [T.StructField(n, stream.schema[c].dataType) for c, n in safe.items()]
    fields += [T.StructField("ts", stream.schema[ts].dataType), T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType())]
    rows = numbered.groupBy(*[safe[k] for k in keys]).transformWithStateInPandas(
        statefulProcessor=_processor(to_micros(tau), ["us", *[safe[c] for c in order]], time_to_live),
        outputStructType=T.StructType(fields),
        outputMode="Append",
        timeMode="ProcessingTime" if time_to_live else "None",
    )
    number = [F.when(~F.isnan(c), F.col(c)).alias(name) for c, name in (("mean", mean), ("std", std))]
    return rows.select(*[F.col(n).alias(c) for c, n in safe.items()], F.col("ts").alias(ts), *number)


def decayed_stream(stream: DataFrame, ts: str, tau, by: Names, column: str, mean: str, std: str, path: str, checkpoint: str, seq: Names | None = None, time_to_live: timedelta | None = None, every: str | None = None) -> StreamingQuery:
    """Write :func:`decayed` rows, one folder a batch. The states are in the checkpoint, in RocksDB.

    States that end by themselves make Spark run batch after batch, so ``time_to_live`` needs a period ``every``:
    a run over what is there now would never be over.
    """
    if time_to_live and not every:
        raise ValueError("time_to_live needs a period")
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start(decayed(stream, ts, tau, by, column, mean, std, seq, time_to_live), checkpoint, write_changes(path), "append", every)
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
