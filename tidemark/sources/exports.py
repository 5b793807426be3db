"""Daily export files (A1, A2, A3, G1).

An export is a gzip file of JSON lines, one record per line.  gzip cannot be
split, so each file is read by one task; ``spread`` deals its records to more
before heavy work.  A malformed line fails the read (``FAILFAST``), as the
line parser of the reference raises.  Lines have numbers in their file
(``number_lines``), so "the first N" means lines of the file, however it was split.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.timefmt import EXPORT_DATE_FORMAT

# Fixed value: file name pattern of a daily export.
EXPORT_FILE_PATTERN = "{entity}_ids_{date}.json.gz"


def default_as_of(today: _dt.date) -> _dt.date:
    """The export of a run is the previous day's (A2).  ``today`` is an argument."""
    return today - _dt.timedelta(days=1)


def export_file_name(entity: str, as_of: _dt.date) -> str:
    """File name for ``entity`` and date, e.g. ``movie_ids_05_15_2024.json.gz`` (A2)."""
    return EXPORT_FILE_PATTERN.format(entity=entity, date=as_of.strftime(EXPORT_DATE_FORMAT))


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files at ``path``: ``value, file, line`` (from 1).

    Rows of a block follow one another in the scan, so a line's number is its place in the
    block plus the lines of its file's earlier blocks.  A gzip file is one block; a plain file is
    split, and only the blocks' counts, one row each, are added up."""
    rows = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_m"))
    blocks = rows.groupBy("file", "_block").agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    out = rows.join(blocks, ["file", "_block"])
    return out.select("value", "file", (F.col("_before") + F.col("_m") - F.col("_first") + 1).alias("line"))


def read_export_lines(spark: SparkSession, path: str, schema: StructType,
                      limit: int | None = None, spread: bool = False) -> DataFrame:
    """Scan JSON lines with a declared schema (A1); optionally the first ``limit``
    lines of each file (G1).  ``spread`` deals the records of unsplittable files
    to tasks of even size."""
    if limit is None:
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    else:
        first = number_lines(spark, path).filter(F.col("line") <= limit)
        first = first.filter(F.trim("value") != "").orderBy("file", "line")  # the reader skips blank lines too
        df = first.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return df.hint("rebalance") if spread else df


def tag_entity(df: DataFrame, entity: str, column: str = "_entity_type") -> DataFrame:
    """Tag every record with its entity type (A3)."""
    return df.withColumn(column, F.lit(entity))


def first_lines(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` records in an explicit order (G1).  Planned as a per-task
    top-n followed by one merge of ``n`` rows per task."""
    return df.orderBy(*order_by).limit(n)
