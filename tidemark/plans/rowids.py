"""Uniqueness of row ids over all loads of an appended table.

A unique check by grouping reads every row ever loaded.  Here the ids seen so far are
an index: 128-bit fingerprints in buckets by their hash, each load a run of its own in
the buckets it touches.  A new load is joined with the buckets it touches, and added.
Runs are merged as a history's closed partitions are (``storage.compact``), so a
bucket's folders do not grow with the number of loads.  Fingerprints are MD5 of the id; ids
that are equal are reported, and so, once in 2^64 pairs or so, are two that are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from tidemark import manifest
from tidemark.plans import storage

INDEX = StructType([StructField("fp", BinaryType()), StructField(storage.BUCKET, IntegerType()), StructField(storage.PART, StringType())])


def _fingerprints(rows: DataFrame, column: str, n_buckets: int) -> DataFrame:
    """The load's ids, each once, with how often it has them; NULL ids are not compared."""
    fp = F.unhex(F.md5(F.col(column).cast("string").cast("binary"))).alias("fp")
    ids = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("id"), fp).agg(F.count(F.lit(1)).alias("times"))
    return ids.withColumn(storage.BUCKET, F.pmod(F.xxhash64("fp"), F.lit(n_buckets)).cast("int"))


def _state(spark: SparkSession, path: str, n_buckets: int) -> dict:
    state = manifest.read(spark, path) or {"upto": 0, "merged": [], "starts": {}, "tag": 0, "load": None, "n_buckets": n_buckets}
    if state["n_buckets"] != n_buckets:
        raise ValueError(f"{path} was written with {state['n_buckets']} buckets, not {n_buckets}")
    return state


def _run(state: dict, load_id: str) -> int:
    """The run of a load: its own if it was the last one added, else a new one."""
    return state["tag"] if state["load"] == load_id else state["tag"] + 1


def touched_index(spark: SparkSession, path: str, load_id: str, buckets: list[int], n_buckets: int) -> DataFrame:
    """The fingerprints of other loads in these buckets; only their folders are read."""
    state = _state(spark, path, n_buckets)
    if not manifest.exists(spark, path):
        return spark.createDataFrame([], INDEX)
    index = storage.visible(spark.read.schema(INDEX).parquet(path), state)
    own = storage.closed_name(f"{_run(state, load_id):06d}")
    return storage.in_buckets(index, buckets).filter(F.col(storage.PART) != own)


def repeated_ids(spark: SparkSession, path: str, load_id: str, rows: DataFrame, column: str = "_dlt_id", n_buckets: int = 64) -> DataFrame:
    """``id, times, seen_before``: ids that the load has more than once or that another load has."""
    ids = _fingerprints(rows, column, n_buckets)
    buckets = sorted(r[0] for r in ids.select(storage.BUCKET).distinct().collect())  # at most n_buckets numbers
    old = touched_index(spark, path, load_id, buckets, n_buckets).select("fp", F.lit(True).alias("before")).distinct()
    found = ids.join(old, "fp", "left").withColumn("seen_before", F.coalesce("before", F.lit(False)))
    return found.filter("times > 1 or seen_before").select("id", "times", "seen_before")


def add_ids(spark: SparkSession, path: str, load_id: str, rows: DataFrame, column: str = "_dlt_id", n_buckets: int = 64, fan: int = storage.FAN) -> None:
    """Add a load's ids; adding the same load again replaces them if no other was added since."""
    state = _state(spark, path, n_buckets)
    run = _run(state, load_id)
    ids = _fingerprints(rows, column, n_buckets).select("fp", storage.BUCKET, F.lit(storage.closed_name(f"{run:06d}")).alias(storage.PART))
    manifest.remove_folders(spark, f"{path}/{storage.BUCKET}=*/{storage.PART}={storage.closed_name(f'{run:06d}')}")
    storage.write_parts(ids, path, replace_all=False)
    manifest.write(spark, path, {**state, "tag": run, "load": load_id})
    storage.compact(spark, path, [], run - 1, fan)  # the last run may still be replaced


def visible_index(spark: SparkSession, path: str) -> DataFrame:
    return storage.visible(spark.read.schema(INDEX).parquet(path), manifest.read(spark, path))
