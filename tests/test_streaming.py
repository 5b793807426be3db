"""Landing stream: new export files are loaded once, replays do not duplicate."""

import gzip
import os
import time
import uuid

from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.session import state_dir
from tidemark.streaming.landing_stream import append_new_exports

SCHEMA = StructType([StructField("id", LongType()), StructField("adult", BooleanType())])


def _land(d, name, ids):
    with gzip.open(os.path.join(d, name), "wt") as f:
        for i in ids:
            f.write(f'{{"id": {i}, "adult": false}}\n')


def test_new_files_loaded_once(spark, tmp_path):
    root = f"{state_dir(spark)}/stream-{uuid.uuid4().hex}"
    landing = tmp_path / "landing"
    landing.mkdir()
    _land(landing, "movie_ids_01_01_2025.json.gz", [1, 2, 3])
    args = dict(spark=spark, landing_dir=str(landing), schema=SCHEMA, entity="movie",
                raw_path=f"{root}/raw", ledger_path=f"{root}/ledger", checkpoint=f"{root}/ckpt", key=["id"])
    append_new_exports(**args)
    assert spark.read.parquet(f"{root}/raw").count() == 3
    time.sleep(1.1)
    _land(landing, "movie_ids_01_02_2025.json.gz", [3, 4])
    append_new_exports(**args)
    append_new_exports(**args)  # nothing new: no change
    raw = spark.read.parquet(f"{root}/raw")
    assert raw.count() == 5
    assert raw.select("_dlt_load_id").distinct().count() == 2
    assert raw.select("_dlt_id").distinct().count() == 5
    ledger = spark.read.parquet(f"{root}/ledger")
    assert sorted(r.row_count for r in ledger.collect()) == [2, 3]


def test_files_with_one_mtime_in_separate_batches(spark, tmp_path):
    """Two files sharing a modification time, loaded in two micro-batches, both stay."""
    root = f"{state_dir(spark)}/stream-{uuid.uuid4().hex}"
    landing = tmp_path / "landing"
    landing.mkdir()
    _land(landing, "a.json.gz", [1, 2])
    _land(landing, "b.json.gz", [3])
    t = time.time() - 10
    for n in ("a.json.gz", "b.json.gz"):
        os.utime(landing / n, (t, t))
    append_new_exports(spark=spark, landing_dir=str(landing), schema=SCHEMA, entity="movie",
                       raw_path=f"{root}/raw", ledger_path=f"{root}/ledger", checkpoint=f"{root}/ckpt",
                       key=["id"], max_files_per_trigger=1)
    raw = spark.read.parquet(f"{root}/raw")
    assert raw.select("_batch").distinct().count() == 2
    assert raw.count() == 3 and raw.select("_dlt_load_id").distinct().count() == 1
