"""Newly landed export files appended to raw exactly once.

The reference re-runs a batch ingest per day and skips files it already has.
Here a file-source stream over the landing folder does that bookkeeping: the
stream's checkpoint (in the shared ``spark.checkpoint.dir``) records which
files were loaded, ``trigger(availableNow=True)`` processes what is new and
stops, and each micro-batch is appended by ``foreachBatch``.

Each landed file is one load.  Its load id is the file's modification time as
epoch text, and row ids hash (load id, key, content), so a micro-batch that is
replayed after a failure writes the same rows again.  The raw table is
partitioned by micro-batch id and written with dynamic partition overwrite: a
replay replaces exactly its own output, and two batches never overwrite each
other (even for files that share a modification time).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.timefmt import micros_to_ntz
from tidemark.sources import rawload
from tidemark.sources.exports import tag_entity

BATCH = "_batch"


def landed_exports(spark: SparkSession, landing_dir: str, schema: StructType, entity: str | None,
                   max_files_per_trigger: int | None = None, flatten: bool = False) -> DataFrame:
    """Streaming DataFrame of the JSON-lines exports landed under ``landing_dir``.

    ``flatten`` turns nested objects into ``parent__child`` columns (A12);
    ``entity`` tags export rows (change tables carry no tag)."""
    r = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(landing_dir)
    # The instant in UTC, whatever the session's time zone.
    lid = rawload.load_id_of(micros_to_ntz(F.unix_micros("_metadata.file_modification_time")))
    df = df.withColumn(rawload.LOAD_ID, lid)
    if flatten:
        df = rawload.flatten_nested(df)
    return tag_entity(df, entity) if entity else df


def append_new_exports(spark: SparkSession, landing_dir: str, schema: StructType, entity: str | None,
                       raw_path: str, ledger_path: str, checkpoint: str, key: list[str],
                       flatten: bool = False, max_files_per_trigger: int | None = None) -> None:
    """Load every export file not loaded before, then stop."""
    stream = landed_exports(spark, landing_dir, schema, entity, max_files_per_trigger, flatten=flatten)
    content = [c for c in stream.columns if c not in key and c != rawload.LOAD_ID]

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn(rawload.ROW_ID, rawload.row_id_col(rawload.LOAD_ID, key, content))
        (stamped.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(raw_path))
        stored = StructType([*stamped.schema, StructField(BATCH, IntegerType())])
        written = spark.read.schema(stored).parquet(raw_path).filter(F.col(BATCH) == batch_id)
        version = hashlib.md5(schema.simpleString().encode()).hexdigest()
        ledger = rawload.load_ledger(written, entity or "changes", F.current_timestamp(), version)
        (ledger.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(ledger_path))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
