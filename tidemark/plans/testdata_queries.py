"""The operator inventory run over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole tables.  Column names match the SQL in ``testdata_oracle``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timefmt import to_day
from tidemark.operators import checks, history, incremental, latest, marts, staging, unions
from tidemark.plans import fixtures
from tidemark.plans.build import build_events
from tidemark.sources import catalog, changes, enrich, exports, pages, rawload, routing

T = fixtures.table

# Fixed parameters of the query set.
RUN_DATE = "2024-02-01"
EXPORT_AS_OF = dt.date(2024, 1, 31)
SNAPSHOT_CUTOFF = "2024-01-15 00:00:00"
FACT_CUTOFF_DATE = "2000-01-01 00:00:00"
FACT_CUTOFF_TS = "2024-01-15 12:00:00"
TARGET_BUILD_DATE = "1999-12-01"
LOAD_ID = "1704067200.000000"
EVENT_COLUMNS = ["event_id", "user_id", "ts", "event_type", "value", "props"]


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# 1 ---------------------------------------------------------------------------
def export_scan_limit(spark: SparkSession, d: str) -> DataFrame:
    ev = exports.tag_entity(T(spark, d, "events"), "event")
    return exports.first_lines(ev, 50, ["event_id"]).withColumn(
        "source_file", F.lit(exports.export_file_name("event", EXPORT_AS_OF)))


# 2 ---------------------------------------------------------------------------
def route_by_entity(spark: SparkSession, d: str) -> DataFrame:
    cust = T(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
    supp = T(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    both = unions.union_all([exports.tag_entity(cust, "customer"), exports.tag_entity(supp, "supplier")])
    return routing.route(both, known=("customer", "supplier"))


# 3 ---------------------------------------------------------------------------
def change_pages_flatten(spark: SparkSession, d: str) -> DataFrame:
    return pages.flatten_pages(fixtures.order_pages(spark, d), listing=["l_orderkey"], require_first=True)


# 4 ---------------------------------------------------------------------------
def change_window(spark: SparkSession, d: str) -> DataFrame:
    o = changes.change_window(T(spark, d, "orders"), "o_orderdate", "1998-01-01", "1998-01-31")
    return o.withColumn("change_date", to_day("o_orderdate"))


# 5 ---------------------------------------------------------------------------
def enrich_found_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = T(spark, d, "orders").select("o_custkey")
    details = T(spark, d, "customer").withColumn(
        "status", F.when(F.col("c_acctbal") > 0, F.lit(200)).otherwise(F.lit(404)))
    return enrich.enrich_found(ids, details, key="c_custkey", ids_key="o_custkey")


# 6 ---------------------------------------------------------------------------
CUSTOMER_RAW = [("c_custkey", "bigint"), ("c_name", "text"), ("c_nationkey", "bigint"),
                ("c_acctbal", "double"), ("c_mktsegment", "text")]


def raw_append_stamp(spark: SparkSession, d: str) -> DataFrame:
    typed = rawload.apply_schema(T(spark, d, "customer"), CUSTOMER_RAW, keep_extra=False)
    return rawload.stamp_load(typed, LOAD_ID, key=["c_custkey"])


# 7 ---------------------------------------------------------------------------
EVENTS_SCHEMA_HASH = "events:event_id,user_id,ts,event_type,value,props"


def load_ledger(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events")
    raw = ev.withColumn(rawload.LOAD_ID, rawload.load_id_of(F.date_trunc("DAY", "ts").cast("timestamp_ntz")))
    return rawload.load_ledger(raw, "events", "ts", hashlib.md5(EVENTS_SCHEMA_HASH.encode()).hexdigest())


# 8 ---------------------------------------------------------------------------
def flatten_nested(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events").select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.from_json("props", "struct<k:bigint>").alias("props"))
    return rawload.flatten_nested(ev)


# 9 ---------------------------------------------------------------------------
def schema_evolution_union(spark: SparkSession, d: str) -> DataFrame:
    old = T(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    new = T(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"))
    return rawload.evolve(old, new)


# 10 --------------------------------------------------------------------------
def detect_iso_timestamp(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"))
    return rawload.promote_iso_timestamps(ev, ["ts_text", "day_text"])


# 11 --------------------------------------------------------------------------
def constraint_checks(spark: SparkSession, d: str) -> DataFrame:
    li = checks.constraint_report(
        T(spark, d, "lineitem"), "lineitem",
        not_null=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        unique=[["l_orderkey", "l_linenumber"]])
    od = checks.constraint_report(T(spark, d, "orders"), "orders", primary_key=["o_orderkey"])
    return li.unionByName(od)


# 12 --------------------------------------------------------------------------
def source_catalog(spark: SparkSession, d: str) -> DataFrame:
    return catalog.describe_source(T(spark, d, "lineitem"), "lineitem", catalog.LINEITEM_CATALOG)


# 13 --------------------------------------------------------------------------
STAGED_EVENTS = ["tmdb_id", "event_id", "event_type", "value", "props", "load_id", "dlt_id"]


def stage_rename(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_events(T(spark, d, "events"))
    st = staging.stage(raw, STAGED_EVENTS, load_date=None)
    return st.withColumn("department", F.lit(marts.ACTING)).withColumn("character", F.lit(None).cast("string"))


# 14 --------------------------------------------------------------------------
def epoch_to_local(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_events(T(spark, d, "events"))
    return staging.stage(raw, ["event_id", "load_id", "load_date"])


# 15 --------------------------------------------------------------------------
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events")
    changed = ev.filter(F.col("ts") < _ts(SNAPSHOT_CUTOFF)).drop("props")
    exported = exports.tag_entity(ev.filter(F.col("ts") >= _ts(SNAPSHOT_CUTOFF)), "event")
    return unions.union_shared([changed, exported])


# 16 --------------------------------------------------------------------------
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return latest.latest_per_key(T(spark, d, "events"), ["user_id"], ["ts", "event_id"])


# 17, 18 ----------------------------------------------------------------------
def _snapshot_runs(spark: SparkSession, d: str):
    ev = T(spark, d, "events").select(*EVENT_COLUMNS)
    run1 = latest.latest_per_key(ev.filter(F.col("ts") < _ts(SNAPSHOT_CUTOFF)), ["user_id"], ["ts", "event_id"])
    h1 = history.snapshot_first(run1, ["user_id"], "ts")
    run2 = latest.latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return h1, run2


def snapshot_first_run(spark: SparkSession, d: str) -> DataFrame:
    return _snapshot_runs(spark, d)[0]


def snapshot_second_run(spark: SparkSession, d: str) -> DataFrame:
    h1, run2 = _snapshot_runs(spark, d)
    return history.snapshot_merge(h1, run2, ["user_id"], "ts")


# 19 --------------------------------------------------------------------------
def version_validity(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events").select("event_id", "user_id", "ts")
    h = history.history_from_changes(ev, ["user_id"], ["ts", "event_id"])
    h = history.add_validity(h.withColumn("is_current", history.current_flag_open()))
    return h.select("event_id", "user_id", history.SCD_ID, history.VALID_FROM, history.VALID_TO,
                    "is_current", "valid_from", "valid_to")


# 20 --------------------------------------------------------------------------
def dimension_full_refresh(spark: SparkSession, d: str) -> DataFrame:
    return marts.dimension(snapshot_second_run(spark, d), "dim_event_id", ["user_id", "event_id", "event_type"])


# 21 --------------------------------------------------------------------------
def bridge_weights(spark: SparkSession, d: str) -> DataFrame:
    v = fixtures.order_versions(spark, d)
    return marts.bridge_equal_weights(
        v, "genres", version_alias="version_id", item_alias="item_id", weight_alias="item_weight",
        bridge_id="bridge_id")


# 22 --------------------------------------------------------------------------
def two_array_dimension(spark: SparkSession, d: str) -> DataFrame:
    v = fixtures.order_versions(spark, d)
    return marts.two_array_dimension(
        v, "credits", key="o_custkey", version_alias="version_id", key_alias="cust_key",
        person_alias="person_id", id_alias="credit_key")


# 23 --------------------------------------------------------------------------
def distinct_lookup(spark: SparkSession, d: str) -> DataFrame:
    rec = fixtures.packed_orders(spark, d)
    return marts.distinct_lookup(rec, "genres", {"id": "int", "name": "string"},
                                 {"id": "genre_id", "name": "genre_name"}, run_date=RUN_DATE)


# 24 --------------------------------------------------------------------------
def _order_facts(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey", to_day("o_orderdate").alias("fact_date"), "o_totalprice", "o_orderstatus")


def append_after_date(spark: SparkSession, d: str) -> DataFrame:
    o = T(spark, d, "orders")
    target = _order_facts(o.filter(F.col("o_orderdate") < _ts(FACT_CUTOFF_DATE)))
    new = incremental.append_after_date(target, o, "fact_date", ts_col="o_orderdate",
                                        keys=["o_orderkey"], order=["o_orderdate"])
    return _order_facts(new)


# 25 --------------------------------------------------------------------------
def append_after_timestamp(spark: SparkSession, d: str) -> DataFrame:
    ev = T(spark, d, "events")
    facts = lambda df: df.select("event_id", "user_id", "value", to_day("ts").alias("fact_date"))
    target = facts(ev.filter(F.col("ts") < _ts(FACT_CUTOFF_TS)))
    return facts(incremental.append_after_timestamp(target, ev, "ts", "fact_date"))


# 26 --------------------------------------------------------------------------
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def upsert_single_key(spark: SparkSession, d: str) -> DataFrame:
    c = T(spark, d, "customer").select(*CUSTOMER_COLUMNS)
    target = c.filter(F.col("c_mktsegment") != F.lit("MACHINERY"))
    batch = c.filter(F.col("c_nationkey") == 3).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(1.0))
    return incremental.upsert(target, batch, ["c_custkey"])


# 27 --------------------------------------------------------------------------
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def upsert_composite_key(spark: SparkSession, d: str) -> DataFrame:
    o = T(spark, d, "orders").select(*ORDER_COLUMNS)
    target = o.filter(F.col("o_orderdate") < _ts(FACT_CUTOFF_DATE)).withColumn(
        "load_date", F.lit(TARGET_BUILD_DATE).cast("date"))
    source = o.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)).withColumn(
        "load_date", F.lit(RUN_DATE).cast("date"))
    return incremental.upsert_after(target, source, ["o_custkey", "o_orderkey"], "o_orderdate", "load_date")


# 28 --------------------------------------------------------------------------
def build_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.session import state_dir

    root = f"{state_dir(spark)}/tidemark-build-{uuid.uuid4().hex}"
    raw = fixtures.raw_events(T(spark, d, "events"))
    first = raw.filter(F.col("ts") < _ts(SNAPSHOT_CUTOFF))
    build_events(spark, first, root, n_buckets=8)
    return build_events(spark, raw, root, n_buckets=8)["fact"]


# 29 --------------------------------------------------------------------------
def movie_marts_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """The movie/person build (staging, latest per key, two snapshots, all
    marts) run twice: with the loads before 1998, then with every load.
    Returns the genre bridge, which the second build upserts."""
    from tidemark.plans.build import build
    from tidemark.session import state_dir

    root = f"{state_dir(spark)}/tidemark-movies-{uuid.uuid4().hex}"
    # Land the raw tables once, as the ingest does; the builds read them.
    raw = fixtures.land_movie_raw(spark, d, root)
    build(spark, fixtures.raw_until(raw, fixtures.MOVIE_LOAD_CUTOFF), root, run_date="1998-01-01", n_buckets=16)
    return build(spark, raw, root, run_date="2001-09-01", n_buckets=16)["dim_movies_genres"]


# 30 --------------------------------------------------------------------------
def movie_marts_compared(spark: SparkSession, d: str) -> DataFrame:
    """The same two builds; one narrow row for each row of all seven marts
    (a row without validity counts as current on its day), with a hash of every
    column that is not among them (a movie's credits are compared in their own mart)."""
    from tidemark.functions.keys import ts_text
    from tidemark.plans.build import MOVIE_DIM_COLUMNS, MOVIE_MEASURES, PERSON_DIM_COLUMNS, build
    from tidemark.session import state_dir

    root = f"{state_dir(spark)}/tidemark-marts-{uuid.uuid4().hex}"
    raw = fixtures.land_movie_raw(spark, d, root)
    build(spark, fixtures.raw_until(raw, fixtures.MOVIE_LOAD_CUTOFF), root, run_date="1998-01-01", n_buckets=4)
    m = build(spark, raw, root, run_date="2001-09-01", n_buckets=4)

    def text(mart, c):
        t = m[mart].schema[c].dataType.simpleString()
        out = F.col(c).cast("decimal(18,2)").cast("string") if t == "double" else ts_text(c) if t == "timestamp_ntz" else F.col(c).cast("string")
        return F.coalesce(out, F.lit("-"))

    def rows(mart, id=None, ref=None, name=None, value=None, day="valid_from", until=None, current=None, every=()):
        col = lambda c, t: (F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c).cast(t)
        return m[mart].select(
            F.lit(mart).alias("mart"), col(id, "string").alias("id"), col(ref, "string").alias("ref"),
            col(name, "string").alias("name"), col(value, "double").alias("value"), col(day, "date").alias("day"),
            col(until or day, "date").alias("until"), col(F.lit(1) if current is None else current, "int").alias("is_current"),
            F.md5(F.concat_ws("|", F.lit(""), *[text(mart, c) for c in every])).alias("every"))

    dated = {"until": "valid_to", "current": "is_current"}
    credit = F.concat_ws("|", "credit_id", F.coalesce("character", F.lit("-")), "department", "job")
    return unions.union_all([
        rows("dim_movies", "dim_movie_id", "tmdb_id", "title", every=[c for c in MOVIE_DIM_COLUMNS if c != "credits"], **dated),
        rows("dim_persons", "dim_person_id", "tmdb_id", "name", "popularity", every=PERSON_DIM_COLUMNS, **dated),
        rows("dim_movies_genres", "dim_movie_genre_id", "genre_id", "dim_movie_id", "genre_weight", every=["dbt_valid_from", "dbt_valid_to"], **dated),
        rows("dim_credits", "dim_credit_id", "tmdb_person_id", credit, every=["dim_movie_id", "tmdb_movie_id"], **dated),
        rows("dim_genres", ref="genre_id", name="genre_name", day="load_date"),
        rows("fact_movies_daily_measures", "dim_movie_id", "vote_count", value="popularity", day="fact_date", every=MOVIE_MEASURES),
        rows("fact_person_popularity", "dim_person_id", value="popularity", day="fact_date"),
    ])


QUERIES = {
    "export_scan_limit": export_scan_limit,
    "route_by_entity": route_by_entity,
    "change_pages_flatten": change_pages_flatten,
    "change_window": change_window,
    "enrich_found_ids": enrich_found_ids,
    "raw_append_stamp": raw_append_stamp,
    "load_ledger": load_ledger,
    "flatten_nested": flatten_nested,
    "schema_evolution_union": schema_evolution_union,
    "detect_iso_timestamp": detect_iso_timestamp,
    "constraint_checks": constraint_checks,
    "source_catalog": source_catalog,
    "stage_rename": stage_rename,
    "epoch_to_local": epoch_to_local,
    "union_sources": union_sources,
    "latest_per_key": latest_per_key,
    "snapshot_first_run": snapshot_first_run,
    "snapshot_second_run": snapshot_second_run,
    "version_validity": version_validity,
    "dimension_full_refresh": dimension_full_refresh,
    "bridge_weights": bridge_weights,
    "two_array_dimension": two_array_dimension,
    "distinct_lookup": distinct_lookup,
    "append_after_date": append_after_date,
    "append_after_timestamp": append_after_timestamp,
    "upsert_single_key": upsert_single_key,
    "upsert_composite_key": upsert_composite_key,
    "build_end_to_end": build_end_to_end,
    "movie_marts_end_to_end": movie_marts_end_to_end,
    "movie_marts_compared": movie_marts_compared,
}
