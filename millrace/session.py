"""Session defaults and the scratch folder shared by all executors."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` adds to them or replaces them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        # Rendered timestamps and hour buckets must not depend on the machine.
        "spark.sql.session.timeZone": "UTC",
        # Field names of events are case-sensitive.
        "spark.sql.caseSensitive": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`, which every executor can reach; it goes when the application ends.

    Where that is not set, as in tests, folders stand in the warehouse; but not on a cluster, where its default is a folder
    of the driver's machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
