"""Session defaults and the shared folder used for checkpoints and written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def builder(app: str = "marketframe") -> SparkSession.Builder:
    """A session builder with the settings the library relies on.

    Master, memory and ``spark.sql.shuffle.partitions`` stay with the cluster: AQE coalesces small
    shuffle partitions and splits skewed join partitions at run time.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``. A machine-local folder is used only in local
    mode with nothing configured; on a cluster a missing setting is an error, since executors could
    not see a local folder and its content would be lost with its machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} is not set: it must name a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "marketframe")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
