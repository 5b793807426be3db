"""Operator 5 [native]: contiguous shards of near-equal bytes, by prefix sums.

Rows are laid out by doc_id.  A narrow copy (no texts) is dealt into ranges and
written with each row's range; the ranges' totals of bytes and rows, one row a
range, give every range its base by a prefix sum; within a range a running sum
adds the rest.  The axis of all bytes is cut at equal targets: a row goes to
the shard in which its middle byte lies.  Shards are contiguous, so a shard's
slots count from the first row it has.

Size: UTF-8 bytes of the text (NULL: none) plus 8.  A NULL doc_id comes first;
rows with equal doc_id are ordered by their text's checksum, then as read;
a very long text is one row, in the shard of its middle byte, which may leave shards
beside it empty; repeated rows are rows of their own; other columns are ignored; an empty table gives an empty table.  A shard's bytes differ
from the target by at most one row's size.  Equal texts are not kept together:
the law is equal bytes, and a hot group may hold more than a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, scratch_root, written


def byte_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    spark = docs.sparkSession
    root = scratch_root(spark)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),  # spreads a doc_id that many rows share
    )
    order = ["doc_id", "text_crc32", "row"]
    ranged = narrow.repartitionByRange(partitions(spark), *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranged", root)
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base_rows"),
        F.sum("bytes").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumns({"upto": F.sum("size").over(inside), "nth": F.row_number().over(Window.partitionBy("part").orderBy(*order))}).join(bases, "part")
    # twice the middle byte, in whole numbers; decimals, as bytes times shards may pass 64 bits
    middle = (2 * (F.col("base_bytes") + F.col("upto")) - F.col("size")).cast("decimal(20,0)")
    shard = F.floor(middle * shards / (2 * F.col("all_bytes").cast("decimal(20,0)"))).cast("int")
    cut = written(placed.select("doc_id", "size", "text_crc32", (F.col("base_rows") + F.col("nth") - 1).alias("nth"), shard.alias("shard")), "cut", root)
    first = cut.groupBy("shard").agg(F.min("nth").alias("first"))  # one row a shard
    return cut.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("nth") - F.col("first")).alias("slot"))
