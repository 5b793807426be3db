"""Session settings the operators rely on, and the shared state folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def builder(master: str | None = None, app_name: str = "tidemark", shuffle_partitions: int | None = None):
    """A SparkSession builder with the settings the library assumes.

    * UTC session zone: every timestamp the library produces is
      ``timestamp_ntz`` so results do not depend on it, but literals do.
    * AQE on, with skew-join splitting and partition coalescing: joins pick
      broadcast or sort-merge from measured sizes at run time.
    * Dynamic partition overwrite: bucketed history and upsert targets
      rewrite only the buckets a batch touches.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    spark = builder(f"local[{cores}]", shuffle_partitions=shuffle_partitions or cores).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def state_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables (snapshots, incremental targets).

    Uses the shared folder the cluster names in ``spark.checkpoint.dir``.  Only
    when it is unset *and* Spark runs in local mode (tests, a laptop) is a
    fresh scratch folder created and registered; on a cluster an unset value is
    an error, since a machine-local folder would not survive a lost executor.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        return conf_dir.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "so written intermediate tables survive executor loss"
        )
    scratch = tempfile.mkdtemp(prefix="tidemark-state-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    try:  # some versions refuse core configs at run time; the context has it anyway
        spark.conf.set("spark.checkpoint.dir", scratch)
    except Exception:  # noqa: BLE001
        pass
    return spark.sparkContext.getCheckpointDir().rstrip("/")
