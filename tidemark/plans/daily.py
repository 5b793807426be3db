"""A daily run: ingest, then one build.

``daily_flow`` is the reference's: the ingest flows over the landed exports, listing pages
and detail responses (``plans.ingest``), each a committed load, then
``plans.build.build`` over the committed loads, of which it reads the new ones only.
``daily_run`` builds from complete records instead: the landing stream appends each
new file once (nested objects flattened, lists kept as JSON text).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import build as builds
from tidemark.plans import ingest, storage
from tidemark.sources import changes, loads, schemas
from tidemark.sources.rawload import apply_schema
from tidemark.streaming.landing_stream import append_new_exports

# Raw tables of the build, their declared columns and entity tag.
RAW = {
    "tmdb_movies": (schemas.TMDB_MOVIES, "movie"),
    "movie_changes": (schemas.MOVIE_CHANGES, None),
    "tmdb_persons": (schemas.TMDB_PERSONS, "person"),
    "person_changes": (schemas.PERSON_CHANGES, None),
}


def raw_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A raw table as loaded so far, typed to its contract (empty if nothing landed)."""
    columns = RAW[name][0]
    df = storage.read_target(spark, f"{root}/raw/{name}")
    if df is None:
        return spark.createDataFrame([], schemas.struct_of(columns))
    return apply_schema(df, columns, keep_extra=False)


def daily_run(spark: SparkSession, landing: dict[str, str], root: str, run_date,
              n_buckets: int = 64) -> dict[str, DataFrame]:
    """Append every newly landed file of each raw table, then build the marts."""
    for name, folder in landing.items():
        columns, entity = RAW[name]
        append_new_exports(
            spark, folder, schemas.landed_schema(columns), entity,
            raw_path=f"{root}/raw/{name}", ledger_path=f"{root}/raw/_dlt_loads_{name}",
            checkpoint=f"{root}/checkpoints/{name}", key=["id"], flatten=True,
        )
    raw = {name: raw_table(spark, root, name) for name in RAW}
    return builds.build(spark, raw, root, run_date, n_buckets=n_buckets)


def daily_flow(spark: SparkSession, landing: dict[str, dict[str, tuple[str, str]]], root: str, run_date, load_id: str,
               start=None, end=None, n_buckets: int = 64, strict: bool = False, **how) -> dict[str, DataFrame]:
    """One day: ``landing["exports"][entity]`` is (ids, details) and ``landing["changes"][entity]``
    (listing pages, details), all of them folders; the marts, built from every committed load.

    The window of changes is by default the day before ``run_date``.  Run again under its
    ``load_id``, a day does what it had not finished: committed loads stay as they are, and
    the build reads no load twice."""
    first, last = changes.default_window(_date(run_date), start and _date(start), end and _date(end))
    raw_root = f"{root}/raw"
    for entity, (ids, details) in landing.get("exports", {}).items():
        ingest.ingest_export(spark, ids, details, entity, raw_root, load_id, strict=strict)
    for entity, (listed, details) in landing.get("changes", {}).items():
        ingest.ingest_changes(spark, listed, details, entity, first, last, raw_root, load_id, strict=strict)
    raw, landed = loads.read_raw(spark, raw_root)
    return builds.build(spark, raw, root, run_date, n_buckets=n_buckets, landed=landed, **how)


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))
