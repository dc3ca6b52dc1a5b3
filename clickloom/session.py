"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything here is a plain Spark setting; an existing session may leave them out.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst (file statistics) and AQE (measured shuffle size) check a join side
    # against these limits before they broadcast it; larger sides are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Open windows live on local disk with changelog checkpoints, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A hot session is folded on the map side before it is shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_local_root: str | None = None


def build_session(app: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="clickloom-")
        root = _local_root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
