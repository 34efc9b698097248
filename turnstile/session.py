"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session gets. Event text carries no zone, so the session zone is pinned to UTC
# (the graph store of the original pipeline read the same text as UTC as well).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Partitions sized for executor memory at large scale; AQE coalesces small ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder that the session names in ``spark.checkpoint.dir``; a local session that names
    none gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if shared is None and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='turnstile-')}/{uuid.uuid4().hex}"


def build_session(
    app_name: str = "turnstile",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings the operators assume.

    On a cluster leave ``master`` as None (spark-submit decides) and size
    ``shuffle_partitions`` to the data (AQE coalesces from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate hands back an existing session: make the runtime SQL settings hold there too.
    # Static settings (a warehouse folder, say) were taken by the builder or cannot change any more.
    for key, value in conf.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark
