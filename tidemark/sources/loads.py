"""Two-phase loads: rows are staged, then a commit record makes them count.

Layout below a root in the shared folder::

    target_table=<table>/_dlt_load_id=<load>/*.parquet    staged rows
    _dlt_loads/commit=<load>-<flow>/*.parquet             commit record: one row a table

A flow stages its tables, any number of jobs, and then writes its commit record
in one job; only loads with a record are read.  A flow that dies before leaves rows that
do not count, and its rerun replaces them.  A committed flow is not run again.
The record counts the rows as written, the pages its landing lacked, the hash of the
schema and the violations of the declared constraints.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import manifest
from tidemark.sources import schemas
from tidemark.sources.rawload import LOAD_ID

TABLE = "target_table"
LEDGER = "_dlt_loads"
LEDGER_SCHEMA = ("load_id string, schema_name string, status bigint, inserted_at timestamp_ntz, schema_version_hash string, "
                 "row_count bigint, failed_pages bigint, absent_pages bigint, violations bigint, flow string, target_table string")
#: Loads that a reader names one by one, which prunes folders; more are joined.
NAMED = 1000


def _record(root: str, load_id: str, flow: str) -> str:
    return f"{root}/{LEDGER}/commit={load_id}-{flow}"


def _staged(root: str, table: str, load_id: str) -> str:
    return f"{root}/{TABLE}={table}/{LOAD_ID}={load_id}"


def is_committed(spark: SparkSession, root: str, load_id: str, flow: str) -> bool:
    return manifest.any_file(spark, f"{_record(root, load_id, flow)}/part-*")


def begin(spark: SparkSession, root: str, load_id: str, flow: str, tables: list[str]) -> bool:
    """Whether the flow has this load still to do; what an earlier attempt staged is removed."""
    if is_committed(spark, root, load_id, flow):
        return False
    for t in tables:
        manifest.remove_folders(spark, _staged(root, t, load_id))
    return True


def stage(df: DataFrame, root: str, table: str | None = None) -> None:
    """Write stamped rows of one load below ``table``, or below the table each row names (``target_table``)."""
    out = df if table is None else df.withColumn(TABLE, F.lit(table))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(TABLE, LOAD_ID).parquet(root))


def staged(spark: SparkSession, root: str, table: str, load_id: str, schema: StructType) -> DataFrame:
    """The rows staged for one load, committed or not."""
    if not manifest.exists(spark, _staged(root, table, load_id)):
        return spark.createDataFrame([], schema)
    inside = StructType([f for f in schema.fields if f.name != LOAD_ID])
    rows = spark.read.schema(inside).parquet(_staged(root, table, load_id)).withColumn(LOAD_ID, F.lit(load_id))
    return rows.select(*schema.fieldNames())


def commit(spark: SparkSession, root: str, load_id: str, flow: str, tables: dict[str, tuple[StructType, str]],
           gaps: DataFrame | None = None, violations: dict[str, int] | None = None) -> None:
    """The record of a load: one row for each of ``tables`` (name: schema, schema name).

    ``gaps``: one row with ``failed_pages`` and ``absent_pages`` of the flow's landing."""
    rows = []
    for name, (schema, schema_name) in tables.items():
        version = hashlib.md5(schema.simpleString().encode()).hexdigest()
        counted = staged(spark, root, name, load_id, schema).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
        rows.append(counted.select(
            F.lit(load_id).alias("load_id"), F.lit(schema_name).alias("schema_name"), F.lit(0).cast("bigint").alias("status"),
            F.current_timestamp().cast("timestamp_ntz").alias("inserted_at"), F.lit(version).alias("schema_version_hash"), "row_count",
            F.lit((violations or {}).get(name, 0)).cast("bigint").alias("violations"), F.lit(flow).alias("flow"), F.lit(name).alias("target_table")))
    record = reduce(DataFrame.unionByName, rows)
    if gaps is None:
        record = record.withColumns({c: F.lit(0).cast("bigint") for c in ("failed_pages", "absent_pages")})
    else:
        pages = gaps.first()
        record = record.withColumns({c: F.lit(pages[c]).cast("bigint") for c in ("failed_pages", "absent_pages")})
    names = [f.split()[0] for f in LEDGER_SCHEMA.split(", ")]
    record.select(*names).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_record(root, load_id, flow))


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """All commit records."""
    if not manifest.exists(spark, f"{root}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/{LEDGER}")


def landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The committed loads of a table with their rows: ``load_id, rows``, without a look at the table."""
    mine = ledger(spark, root).filter((F.col("target_table") == table) & (F.col("row_count") > 0))
    return mine.groupBy("load_id").agg(F.sum("row_count").alias("rows"))


def read_table(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """The rows of committed loads, with the columns of ``schema``; the load id is the folder, so loads are pruned."""
    loads = landed(spark, root, table).select("load_id")
    known = [r[0] for r in loads.limit(NAMED + 1).collect()]
    if not known:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{root}/{TABLE}={table}").select(*schema.fieldNames())
    if len(known) <= NAMED:
        return rows.filter(F.col(LOAD_ID).isin(known))
    return rows.join(loads.withColumnRenamed("load_id", LOAD_ID), LOAD_ID, "left_semi").select(*schema.fieldNames())


def read_raw(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The four raw tables of the movie and person build, as committed, and their landed loads."""
    names = [t for t in schemas.RAW_TABLES if t in ("tmdb_movies", "movie_changes", "tmdb_persons", "person_changes")]
    raw = {n: read_table(spark, root, n, schemas.struct_of(schemas.RAW_TABLES[n])) for n in names}
    return raw, {n: landed(spark, root, n) for n in names}
