"""Session factory and the shared working folder.

The session pins UTC (event micros are zone-less wall clock, see
``functions.time``), turns AQE on, and only adds lake-catalog settings when
a catalog URI is given, so the same code runs in a laptop test and on a
cluster with an Iceberg REST catalog.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Broadcast joins are left to AQE, which
# measures the real size of a join side at run time before choosing.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.scheduler.mode": "FAIR",  # the streaming queries of one session share its cores evenly
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def create_session(
    app_name: str = "attrlake",
    master: str | None = None,
    catalog: str | None = None,
    catalog_uri: str | None = None,
    warehouse: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.

    ``catalog``/``catalog_uri`` switch on an Iceberg REST catalog; this needs
    the Iceberg runtime jar on the class path and is otherwise skipped.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if catalog and catalog_uri:
        conf.update({
            "spark.sql.extensions":
                "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
            f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
            f"spark.sql.catalog.{catalog}.type": "rest",
            f"spark.sql.catalog.{catalog}.uri": catalog_uri,
        })
        if warehouse:
            conf[f"spark.sql.catalog.{catalog}.warehouse"] = warehouse
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-JVM session for tests and the bench."""
    return create_session(
        master=f"local[{cores}]",
        extra={
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("ATTRLAKE_DRIVER_MEMORY", "16g"),
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (tests, a laptop) a folder
    is created and registered, so every later ``checkpoint()`` and staging
    table lands in the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        return configured or _own_folder(spark.conf.get("spark.master", "local"))
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(configured or _own_folder(sc.master))
    return sc.getCheckpointDir()


def _own_folder(master: str) -> str:
    """A fresh local folder, where driver and executors share one machine."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="attrlake-")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root for one run."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/runs/{label}-{uuid.uuid4().hex[:12]}"
