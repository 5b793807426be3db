"""Independent DuckDB SQL for every query in ``testdata_queries``.

Written the way the reference's models are: ``ROW_NUMBER`` windows, ``LEAD``,
scalar subqueries and ``UNION ALL``, not the Spark plans.  Timestamps inside
hashes use one explicit text form in both engines.
"""

from __future__ import annotations

import hashlib

from tidemark.plans import fixtures
from tidemark.plans import testdata_queries as q
from tidemark.sources.catalog import LINEITEM_CATALOG


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def epoch_text(x: str) -> str:
    return (f"((epoch_us({x}) // 1000000)::VARCHAR || '.' || "
            f"lpad((epoch_us({x}) % 1000000)::VARCHAR, 6, '0'))")


def row_id(*parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(({p})::VARCHAR, '\\N')" for p in parts) + "))"


def scd(key: str, ts: str) -> str:
    return f"md5(concat_ws('|', coalesce({key}::VARCHAR, ''), coalesce({ts_text(ts)}, '')))"


def local(text: str) -> str:
    return f"(to_timestamp(CAST({text} AS DOUBLE)) AT TIME ZONE 'America/Argentina/Buenos_Aires')"


def ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


OPEN_END = "DATE '9999-12-31'"


def day_before(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) - INTERVAL 1 DAY AS DATE)"


BRAND = "TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER)"

LINES = f"""
tagged AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus,
         p.p_brand, p.p_type, coalesce(CAST(l.l_suppkey // {fixtures.SUPPLIER_BLOCK} AS BIGINT), -1) AS part_no
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

VERSIONS = LINES + f""",
rec AS (SELECT l_orderkey, part_no, count(*) AS n_items FROM tagged GROUP BY l_orderkey, part_no),
ver AS (
  SELECT o_orderkey, o_custkey,
         md5(concat_ws('|', o_custkey::VARCHAR, {ts_text('o_orderdate')}, o_orderkey::VARCHAR)) AS version_id,
         o_orderdate AS dbt_valid_from,
         lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS dbt_valid_to,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders),
vt AS (
  SELECT t.*, r.n_items, v.version_id, v.o_custkey, v.dbt_valid_from, v.dbt_valid_to,
         CASE WHEN v.rn = 1 THEN 1 ELSE 0 END AS is_current,
         CAST(v.dbt_valid_from AS DATE) AS valid_from,
         CASE WHEN v.rn = 1 THEN {OPEN_END} ELSE {day_before('v.dbt_valid_to')} END AS valid_to
  FROM tagged t
  JOIN rec r ON t.l_orderkey = r.l_orderkey AND t.part_no = r.part_no
  JOIN ver v ON v.o_orderkey = t.l_orderkey)"""


def _latest(where: str = "") -> str:
    return (f"SELECT event_id, user_id, ts, event_type, value, props FROM events {where} "
            f"QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")


SNAP_COLS = "event_id, user_id, ts, event_type, value, props"

SNAPSHOT2 = f"""
r1 AS ({_latest(f"WHERE ts < {ts(q.SNAPSHOT_CUTOFF)}")}),
h1 AS (SELECT {SNAP_COLS}, {scd('user_id', 'ts')} AS dbt_scd_id, ts AS dbt_updated_at,
              ts AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM r1),
r2 AS ({_latest()}),
kept AS (SELECT h1.event_id, h1.user_id, h1.ts, h1.event_type, h1.value, h1.props, h1.dbt_scd_id,
                h1.dbt_updated_at, h1.dbt_valid_from,
                CASE WHEN r2.ts > h1.dbt_valid_from THEN r2.ts END AS dbt_valid_to
         FROM h1 LEFT JOIN r2 ON h1.user_id = r2.user_id),
ins AS (SELECT r2.event_id, r2.user_id, r2.ts, r2.event_type, r2.value, r2.props,
               {scd('r2.user_id', 'r2.ts')} AS dbt_scd_id, r2.ts AS dbt_updated_at, r2.ts AS dbt_valid_from,
               CAST(NULL AS TIMESTAMP) AS dbt_valid_to
        FROM r2 LEFT JOIN h1 ON r2.user_id = h1.user_id
        WHERE h1.user_id IS NULL OR r2.ts > h1.dbt_valid_from),
snap AS (SELECT * FROM kept UNION ALL BY NAME SELECT * FROM ins)"""


def _not_null(table: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{col}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS violations FROM {table}")


def _unique(table: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in cols)
    return (f"SELECT '{table}' AS table_name, 'unique' AS check_name, '{','.join(cols)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {c} FROM {table} WHERE {nn} "
            f"GROUP BY {c} HAVING count(*) > 1)")


def _catalog() -> str:
    parts = []
    for c, t, d in LINEITEM_CATALOG:
        parts.append(f"SELECT 'lineitem' AS table_name, '{c}' AS column_name, '{t}' AS data_type, "
                     f"'{d}' AS description, CAST(count({c}) AS BIGINT) AS non_null FROM lineitem")
    return "\nUNION ALL ".join(parts)


EV_LOAD = epoch_text("ts")

OD_LOAD = epoch_text("o.o_orderdate")

MOVIE = f"(o.o_custkey * {fixtures.MOVIES_PER_CUSTOMER} + r.part_no + 1)"

MOVIE_SNAPSHOT = f"""{LINES},
rec AS (SELECT l_orderkey, part_no, count(*) AS n_items FROM tagged GROUP BY l_orderkey, part_no),
st AS (
  SELECT {MOVIE} AS tmdb_id, {OD_LOAD} AS load_id, {local(OD_LOAD)} AS load_date,
         {row_id(OD_LOAD, MOVIE, 'o.o_orderkey')} AS dlt_id,
         r.l_orderkey, r.part_no, r.n_items, o.o_orderpriority AS title, o.o_totalprice AS popularity
  FROM rec r JOIN orders o ON o.o_orderkey = r.l_orderkey),
r1 AS (SELECT * FROM st WHERE load_id < '{fixtures.MOVIE_LOAD_CUTOFF}'
       QUALIFY row_number() OVER (PARTITION BY tmdb_id ORDER BY load_id DESC, dlt_id DESC) = 1),
r2 AS (SELECT * FROM st
       QUALIFY row_number() OVER (PARTITION BY tmdb_id ORDER BY load_id DESC, dlt_id DESC) = 1),
v1 AS (SELECT r1.tmdb_id, r1.l_orderkey, r1.part_no, r1.n_items, r1.title, r1.popularity, {scd('r1.tmdb_id', 'r1.load_date')} AS scd_id,
              r1.load_date AS dbt_updated_at, r1.load_date AS dbt_valid_from,
              CASE WHEN r2.load_date > r1.load_date THEN r2.load_date END AS dbt_valid_to
       FROM r1 LEFT JOIN r2 ON r1.tmdb_id = r2.tmdb_id),
v2 AS (SELECT r2.tmdb_id, r2.l_orderkey, r2.part_no, r2.n_items, r2.title, r2.popularity, {scd('r2.tmdb_id', 'r2.load_date')} AS scd_id,
              r2.load_date AS dbt_updated_at, r2.load_date AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
       FROM r2 LEFT JOIN r1 ON r1.tmdb_id = r2.tmdb_id
       WHERE r1.tmdb_id IS NULL OR r2.load_date > r1.load_date),
snap AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tmdb_id ORDER BY dbt_updated_at DESC) AS rn FROM snap)"""

MOVIE_BRIDGE = f"""
WITH {MOVIE_SNAPSHOT}
SELECT md5(v.scd_id || ({BRAND})::VARCHAR) AS dim_movie_genre_id, v.scd_id AS dim_movie_id, {BRAND} AS genre_id,
       1.0::DOUBLE / v.n_items AS genre_weight, v.dbt_valid_from, v.dbt_valid_to,
       CASE WHEN v.rn = 1 THEN 1 ELSE 0 END AS is_current, CAST(v.dbt_valid_from AS DATE) AS valid_from,
       CASE WHEN v.rn = 1 THEN {OPEN_END} ELSE {day_before('v.dbt_valid_to')} END AS valid_to
FROM ranked v JOIN tagged t ON t.l_orderkey = v.l_orderkey AND t.part_no = v.part_no"""

MOVIE_DATED = f"""CAST(v.dbt_valid_from AS DATE), CASE WHEN v.rn = 1 THEN {OPEN_END} ELSE {day_before('v.dbt_valid_to')} END,
       CASE WHEN v.rn = 1 THEN 1 ELSE 0 END"""
NO_DOUBLE = "CAST(NULL AS DOUBLE)"
P1, P2 = local(repr(fixtures.PERSON_LOAD_1)), local(repr(fixtures.PERSON_LOAD_2))



def every(*parts: str) -> str:
    """The hash of further columns of a mart's row."""
    return "md5(" + " || '|' || ".join(["''", *(f"coalesce(({p})::VARCHAR, '-')" for p in parts)]) + ")"


def cents(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18, 2))"


MOVIE_EVERY = every(
    "v.tmdb_id", "'tt' || o_orderkey::VARCHAR", "o_orderstatus", "o_orderpriority || ' of ' || o_custkey::VARCHAR", "strftime(o_orderdate, '%Y-%m-%d')",
    "v.part_no + 60", "lower(o_orderstatus)", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "v.title", "NULL", "o_custkey", "o_orderpriority",
    "NULL", "NULL", "o_orderstatus = 'P'", "NULL")
PERSON_EVERY = every(
    "v.tmdb_id", "NULL", "NULL", "NULL", "NULL", "NULL", "v.name", "NULL", "NULL", cents("v.popularity"), "NULL", "v.load_id", ts_text("v.dbt_valid_from"),
    row_id("v.load_id", "v.tmdb_id"), "NULL", "NULL")
MEASURES_EVERY = every(cents("popularity"), cents("n_items / 4"), "n_items", "CAST(round(o_totalprice) AS BIGINT)", "NULL")

MOVIE_MARTS = f"""
WITH {MOVIE_SNAPSHOT},
lines AS (SELECT v.*, t.* EXCLUDE (l_orderkey, part_no) FROM ranked v
          JOIN tagged t ON t.l_orderkey = v.l_orderkey AND t.part_no = v.part_no),
f1 AS (SELECT {scd('tmdb_id', 'load_date')} AS id, l_orderkey, n_items, popularity, CAST(load_date AS DATE) AS day FROM r1),
f2 AS (SELECT scd_id AS id, l_orderkey, n_items, popularity, CAST(dbt_valid_from AS DATE) AS day FROM snap
       WHERE dbt_valid_to IS NULL AND CAST(dbt_valid_from AS DATE) > (SELECT max(day) FROM f1)),
ppl AS (SELECT c_custkey AS tmdb_id, c_name AS name, c_acctbal AS popularity, '{fixtures.PERSON_LOAD_1}' AS load_id, {P1} AS dbt_valid_from,
               CASE WHEN c_nationkey = 3 THEN {P2} END AS dbt_valid_to, CASE WHEN c_nationkey = 3 THEN 2 ELSE 1 END AS rn
        FROM customer
        UNION ALL
        SELECT c_custkey, c_name, c_acctbal + 1.0, '{fixtures.PERSON_LOAD_2}', {P2}, NULL, 1 FROM customer WHERE c_nationkey = 3),
people AS (SELECT *, {scd('tmdb_id', 'dbt_valid_from')} AS scd_id FROM ppl),
g1 AS (SELECT DISTINCT {BRAND} AS genre_id, p_type FROM r1
       JOIN tagged t ON t.l_orderkey = r1.l_orderkey AND t.part_no = r1.part_no),
g2 AS (SELECT DISTINCT {BRAND} AS genre_id, p_type FROM r2
       JOIN tagged t ON t.l_orderkey = r2.l_orderkey AND t.part_no = r2.part_no
       WHERE r2.load_date > {ts('1998-01-01 00:00:00')})
SELECT 'dim_movies' AS mart, v.scd_id AS id, v.tmdb_id::VARCHAR AS ref, v.title AS name, {NO_DOUBLE} AS value,
       {MOVIE_DATED.replace(", CASE", " AS day, CASE", 1).replace("END,", "END AS until,", 1)} AS is_current, {MOVIE_EVERY} AS every
FROM ranked v JOIN orders o ON o.o_orderkey = v.l_orderkey
UNION ALL SELECT 'dim_persons', v.scd_id, v.tmdb_id::VARCHAR, v.name, v.popularity, {MOVIE_DATED}, {PERSON_EVERY} FROM people v
UNION ALL SELECT 'dim_movies_genres', md5(v.scd_id || ({BRAND})::VARCHAR), ({BRAND})::VARCHAR, v.scd_id,
       1.0::DOUBLE / v.n_items, {MOVIE_DATED}, {every(ts_text('v.dbt_valid_from'), ts_text('v.dbt_valid_to'))} FROM lines v
UNION ALL SELECT 'dim_credits', md5(v.scd_id || l_partkey::VARCHAR || c), l_partkey::VARCHAR,
       c || '|' || l_returnflag || '|Acting|Acting', {NO_DOUBLE}, {MOVIE_DATED}, {every('v.scd_id', 'v.tmdb_id')}
FROM (SELECT *, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR AS c FROM lines) v
UNION ALL SELECT 'dim_credits', md5(v.scd_id || l_suppkey::VARCHAR || c), l_suppkey::VARCHAR,
       c || '|-|' || l_linestatus || '|' || l_returnflag || l_linestatus, {NO_DOUBLE}, {MOVIE_DATED}, {every('v.scd_id', 'v.tmdb_id')}
FROM (SELECT *, l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_suppkey::VARCHAR AS c FROM lines) v
UNION ALL SELECT 'dim_genres', NULL, genre_id::VARCHAR, p_type, {NO_DOUBLE}, DATE '1998-01-01', DATE '1998-01-01', 1, md5('')
FROM g1 WHERE genre_id NOT IN (SELECT genre_id FROM g2)
UNION ALL SELECT 'dim_genres', NULL, genre_id::VARCHAR, p_type, {NO_DOUBLE}, DATE '2001-09-01', DATE '2001-09-01', 1, md5('') FROM g2
UNION ALL SELECT 'fact_movies_daily_measures', id, n_items::VARCHAR, NULL, popularity, day, day, 1, {MEASURES_EVERY}
FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) f JOIN orders o ON o.o_orderkey = f.l_orderkey
UNION ALL SELECT 'fact_person_popularity', {scd('c_custkey', P1)}, NULL, NULL, c_acctbal, CAST({P1} AS DATE), CAST({P1} AS DATE), 1, md5('')
FROM customer
UNION ALL SELECT 'fact_person_popularity', scd_id, NULL, NULL, popularity, CAST(dbt_valid_from AS DATE), CAST(dbt_valid_from AS DATE), 1, md5('')
FROM people WHERE dbt_valid_from > CAST(CAST({P1} AS DATE) AS TIMESTAMP)"""

ORACLE = {
    "export_scan_limit": f"""
SELECT event_id, ts, user_id, event_type, value, props, 'event' AS _entity_type,
       'event_ids_01_31_2024.json.gz' AS source_file
FROM events ORDER BY event_id LIMIT 50""",

    "route_by_entity": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       'customer' AS _entity_type, 'tmdb_customers' AS target_table FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier', 'tmdb_suppliers' FROM supplier""",

    "change_pages_flatten": f"""
WITH {LINES}
SELECT l_orderkey, part_no + 3 AS page, l_partkey AS id, (l_returnflag = 'R') AS adult FROM tagged""",

    "change_window": """
SELECT *, CAST(o_orderdate AS DATE) AS change_date FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'""",

    "enrich_found_ids": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_acctbal > 0 AND c_custkey IN (SELECT o_custkey FROM orders)""",

    "raw_append_stamp": f"""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       '{q.LOAD_ID}' AS _dlt_load_id,
       {row_id(repr(q.LOAD_ID), 'c_custkey', 'c_name', 'CAST(c_nationkey AS BIGINT)', 'c_acctbal', 'c_mktsegment')}
         AS _dlt_id
FROM customer""",

    "load_ledger": f"""
SELECT {epoch_text("date_trunc('day', ts)")} AS load_id, 'events' AS schema_name,
       CAST(0 AS BIGINT) AS status, max(ts) AS inserted_at,
       '{hashlib.md5(q.EVENTS_SCHEMA_HASH.encode()).hexdigest()}' AS schema_version_hash,
       count(*) AS row_count
FROM events GROUP BY 1""",

    "flatten_nested": """
SELECT event_id, user_id, ts, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k
FROM events""",

    "schema_evolution_union": """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS mktsegment FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",

    "detect_iso_timestamp": """
SELECT event_id, ts AS ts_text, strftime(ts, '%Y-%m-%d') AS day_text FROM events""",

    "constraint_checks": "\nUNION ALL ".join(
        [_not_null("lineitem", c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]]
        + [_unique("lineitem", ["l_orderkey", "l_linenumber"]),
           _not_null("orders", "o_orderkey"), _unique("orders", ["o_orderkey"])]),

    "source_catalog": _catalog(),

    "stage_rename": f"""
SELECT user_id AS tmdb_id, event_id, event_type, value, props, {EV_LOAD} AS load_id,
       {row_id(EV_LOAD, 'event_id')} AS dlt_id,
       'Acting' AS department, CAST(NULL AS VARCHAR) AS "character"
FROM events""",

    "epoch_to_local": f"""
SELECT event_id, {EV_LOAD} AS load_id, {local(EV_LOAD)} AS load_date FROM events""",

    "union_sources": f"""
SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < {ts(q.SNAPSHOT_CUTOFF)}
UNION ALL
SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= {ts(q.SNAPSHOT_CUTOFF)}""",

    "latest_per_key": _latest(),

    "snapshot_first_run": f"""
WITH r1 AS ({_latest(f"WHERE ts < {ts(q.SNAPSHOT_CUTOFF)}")})
SELECT {SNAP_COLS}, {scd('user_id', 'ts')} AS dbt_scd_id, ts AS dbt_updated_at, ts AS dbt_valid_from,
       CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM r1""",

    "snapshot_second_run": f"WITH {SNAPSHOT2}\nSELECT * FROM snap",

    "version_validity": f"""
SELECT event_id, user_id, {scd('user_id', 'ts')} AS dbt_scd_id, ts AS dbt_valid_from,
       lead(ts) OVER w AS dbt_valid_to,
       CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS is_current,
       CAST(ts AS DATE) AS valid_from,
       CASE WHEN lead(ts) OVER w IS NULL THEN {OPEN_END} ELSE {day_before('lead(ts) OVER w')} END AS valid_to
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",

    "dimension_full_refresh": f"""
WITH {SNAPSHOT2},
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dbt_updated_at DESC) AS rn FROM snap)
SELECT dbt_scd_id AS dim_event_id, user_id, event_id, event_type,
       CASE WHEN rn = 1 THEN 1 ELSE 0 END AS is_current, CAST(dbt_valid_from AS DATE) AS valid_from,
       CASE WHEN rn = 1 THEN {OPEN_END} ELSE {day_before('dbt_valid_to')} END AS valid_to
FROM ranked""",

    "bridge_weights": f"""
WITH {VERSIONS}
SELECT md5(version_id || ({BRAND})::VARCHAR) AS bridge_id, version_id, {BRAND} AS item_id,
       1.0::DOUBLE / n_items AS item_weight, dbt_valid_from, dbt_valid_to, is_current, valid_from, valid_to
FROM vt""",

    "two_array_dimension": f"""
WITH {VERSIONS},
credits AS (
  SELECT version_id, o_custkey, TRY_CAST(l_partkey AS INTEGER) AS person_id,
         l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR AS credit_id,
         l_returnflag AS "character", 'Acting' AS department, 'Acting' AS job,
         is_current, valid_from, valid_to FROM vt
  UNION ALL
  SELECT version_id, o_custkey, TRY_CAST(l_suppkey AS INTEGER),
         l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_suppkey::VARCHAR,
         CAST(NULL AS VARCHAR), l_linestatus, l_returnflag || l_linestatus,
         is_current, valid_from, valid_to FROM vt)
SELECT md5(version_id || person_id::VARCHAR || credit_id) AS credit_key, version_id, o_custkey AS cust_key,
       person_id, credit_id, "character", department, job, is_current, valid_from, valid_to
FROM credits""",

    "distinct_lookup": f"""
SELECT DISTINCT {BRAND} AS genre_id, p_type AS genre_name, DATE '{q.RUN_DATE}' AS load_date
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",

    "append_after_date": f"""
WITH target AS (SELECT CAST(o_orderdate AS DATE) AS fact_date FROM orders
                WHERE o_orderdate < {ts(q.FACT_CUTOFF_DATE)}),
batch AS (SELECT * FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fact_date, o_totalprice, o_orderstatus FROM batch
WHERE CAST(o_orderdate AS DATE) > (SELECT max(fact_date) FROM target)""",

    "append_after_timestamp": f"""
WITH target AS (SELECT CAST(ts AS DATE) AS fact_date FROM events WHERE ts < {ts(q.FACT_CUTOFF_TS)})
SELECT event_id, user_id, value, CAST(ts AS DATE) AS fact_date FROM events
WHERE ts > CAST((SELECT max(fact_date) FROM target) AS TIMESTAMP)""",

    "upsert_single_key": """
WITH target AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
                WHERE c_mktsegment <> 'MACHINERY'),
batch AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1.0 AS c_acctbal, c_mktsegment FROM customer
          WHERE c_nationkey = 3)
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.c_custkey = t.c_custkey)
UNION ALL SELECT * FROM batch""",

    "upsert_composite_key": f"""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
                       DATE '{q.TARGET_BUILD_DATE}' AS load_date
                FROM orders WHERE o_orderdate < {ts(q.FACT_CUTOFF_DATE)}),
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
               o_orderpriority, DATE '{q.RUN_DATE}' AS load_date FROM orders),
batch AS (SELECT * FROM src WHERE o_orderdate > CAST((SELECT max(load_date) FROM target) AS TIMESTAMP))
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_custkey = t.o_custkey AND b.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM batch""",

    "build_end_to_end": f"""
WITH st AS (SELECT user_id AS tmdb_id, value, ts, {EV_LOAD} AS load_id, {local(EV_LOAD)} AS load_date,
                   {row_id(EV_LOAD, 'event_id')} AS dlt_id FROM events),
r1 AS (SELECT * FROM st WHERE ts < {ts(q.SNAPSHOT_CUTOFF)}
       QUALIFY row_number() OVER (PARTITION BY tmdb_id ORDER BY load_id DESC, dlt_id DESC) = 1),
r2 AS (SELECT * FROM st
       QUALIFY row_number() OVER (PARTITION BY tmdb_id ORDER BY load_id DESC, dlt_id DESC) = 1),
f1 AS (SELECT {scd('tmdb_id', 'load_date')} AS dim_event_id, CAST(load_date AS DATE) AS fact_date, value FROM r1),
new_open AS (SELECT r2.* FROM r2 LEFT JOIN r1 ON r1.tmdb_id = r2.tmdb_id
             WHERE r1.tmdb_id IS NULL OR r2.load_date > r1.load_date),
open2 AS (SELECT tmdb_id, load_date, value FROM new_open
          UNION ALL
          SELECT tmdb_id, load_date, value FROM r1
          WHERE NOT EXISTS (SELECT 1 FROM new_open n WHERE n.tmdb_id = r1.tmdb_id)),
f2 AS (SELECT {scd('tmdb_id', 'load_date')} AS dim_event_id, CAST(load_date AS DATE) AS fact_date, value
       FROM open2 WHERE CAST(load_date AS DATE) > (SELECT max(fact_date) FROM f1))
SELECT * FROM f1 UNION ALL SELECT * FROM f2""",

    "movie_marts_end_to_end": MOVIE_BRIDGE,

    "movie_marts_compared": MOVIE_MARTS,
}
