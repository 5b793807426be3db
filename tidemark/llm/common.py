"""Helpers the operators of this package share."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import state_dir

_roots: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """A new folder below the cluster's shared folder; removed when the driver ends.

    Tables that cut lineage go here.  Lost executors can read them again, which
    a machine-local folder or a local checkpoint would not allow.
    """
    top = f"{state_dir(spark)}/llm-{spark.sparkContext.applicationId}"
    if top not in _roots:
        _roots.add(top)
        atexit.register(_remove, spark, top)
    return f"{top}/{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  (the session may be gone already; only scratch is left behind)
        pass


def written(df: DataFrame, name: str = "t", root: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage is cut there)."""
    spark = df.sparkSession
    path = f"{root or scratch_root(spark)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which is set for the data's size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` texts in an Arrow batch, so that long texts do not add up."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def broadcast_if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A written table of a few numbers a row, to be broadcast if it has at most ``rows``; else joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def as_row(df: DataFrame, *more) -> DataFrame:
    """``df`` with its columns in one struct, ``row``, and ``more`` beside it: working names can't clash with a user's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of queries that are over.

    It removes a shuffle's files when the driver's collector finds nothing that refers to it,
    which by default may be half an hour later; a chain of large stages can't wait so long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
