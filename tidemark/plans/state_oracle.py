"""Independent DuckDB SQL for the queries of ``state_queries``."""

from __future__ import annotations

from tidemark.plans import fixtures
from tidemark.plans import state_queries as q

B = fixtures.SUPPLIER_BLOCK


def _epoch(x: str) -> str:
    return f"((epoch_us({x}) // 1000000)::VARCHAR || '.' || lpad((epoch_us({x}) % 1000000)::VARCHAR, 6, '0'))"


def _listed(name: str, table: str, day: str, block: str, item: str) -> str:
    """A listing's pages, what became of them, and the ids of the usable ones, in the window."""
    return f"""
{name}_items AS (SELECT DISTINCT CAST(date_trunc('month', {day}) AS DATE) AS m, {block} AS page, {item} AS id FROM {table}
                 WHERE CAST(date_trunc('month', {day}) AS DATE) BETWEEN DATE '{q.WINDOW[0]}' AND DATE '{q.WINDOW[1]}'),
{name}_pages AS (SELECT DISTINCT m, page, (month(m) + page) % 4 AS kind FROM {name}_items),
{name}_expected AS (SELECT m, unnest(generate_series(1, max(page))) AS page FROM {name}_pages GROUP BY m),
{name}_usable AS (SELECT i.* FROM {name}_items i WHERE (month(m) + page) % 4 > 1),
{name}_gaps AS (SELECT count(*) FILTER (WHERE kind = 1) AS failed, count(*) FILTER (WHERE e.page > 1 AND (kind IS NULL OR kind = 0)) AS absent
                FROM {name}_expected e LEFT JOIN {name}_pages p ON p.m = e.m AND p.page = e.page)"""


DAY_1, DAY_2 = "DATE '2024-01-01'", "DATE '2024-01-02'"

STATE_ORACLE = {
    "page_gaps": f"""
WITH lines AS (SELECT DISTINCT l_orderkey, coalesce(CAST(l_suppkey // {B} AS BIGINT), -1) + 3 AS page FROM lineitem),
expected AS (SELECT l_orderkey, unnest(generate_series(1, max(page))) AS page FROM lines GROUP BY l_orderkey),
landed AS (SELECT l_orderkey, page FROM lines WHERE (l_orderkey + page) % 5 <> 0)
SELECT e.l_orderkey, {_epoch('o_orderdate')} AS load_id, CAST(e.page AS BIGINT) AS page,
       CASE WHEN e.page = 2 THEN 'failed' ELSE 'absent' END AS state
FROM expected e JOIN orders o ON o.o_orderkey = e.l_orderkey
WHERE e.page = 2 OR (e.page > 2 AND NOT EXISTS (SELECT 1 FROM landed l WHERE l.l_orderkey = e.l_orderkey AND l.page = e.page))""",

    "daily_flow_marts": f"""
WITH {_listed('movie', 'lineitem', 'l_shipdate', f'l_suppkey // {B} + 2', 'l_partkey')},
{_listed('person', 'orders', 'o_orderdate', 'o_custkey // 500 + 2', 'o_custkey')},
movies AS (SELECT *, TRY_CAST(split_part(p_brand, '#', 2) AS BIGINT) AS brand,
                  p_partkey IN (SELECT id FROM movie_usable) AS changed FROM part WHERE p_size <= 40),
persons AS (SELECT *, c_custkey IN (SELECT id FROM person_usable) AS changed FROM customer WHERE c_acctbal >= 0)
SELECT 'ledger' AS what, 'tmdb_movies' AS id, '{q.DAY_1}' AS name, count(*)::DOUBLE AS value, 0::BIGINT AS n, 0::BIGINT AS more FROM movies
UNION ALL SELECT 'ledger', 'tmdb_persons', '{q.DAY_1}', count(*), 0, 0 FROM persons
UNION ALL SELECT 'ledger', 'ids_movies_changes', '{q.DAY_2}', (SELECT count(*) FROM movie_usable), failed, absent FROM movie_gaps
UNION ALL SELECT 'ledger', 'movie_changes', '{q.DAY_2}', (SELECT count(*) FROM movies WHERE changed), failed, absent FROM movie_gaps
UNION ALL SELECT 'ledger', 'ids_persons_changes', '{q.DAY_2}', (SELECT count(*) FROM person_usable), failed, absent FROM person_gaps
UNION ALL SELECT 'ledger', 'person_changes', '{q.DAY_2}', (SELECT count(*) FROM persons WHERE changed), failed, absent FROM person_gaps
UNION ALL SELECT 'dim_movies', p_partkey::VARCHAR, p_brand, p_size, CASE WHEN changed THEN 0 ELSE 1 END, p_size FROM movies
UNION ALL SELECT 'dim_movies', p_partkey::VARCHAR, p_brand, p_size, 1, p_size FROM movies WHERE changed
UNION ALL SELECT 'dim_persons', c_custkey::VARCHAR, c_name, c_acctbal, CASE WHEN changed THEN 0 ELSE 1 END, -1 FROM persons
UNION ALL SELECT 'dim_persons', c_custkey::VARCHAR, c_name, c_acctbal + 1.0, 1, -1 FROM persons WHERE changed
UNION ALL SELECT DISTINCT 'dim_genres', CASE WHEN brand IN (SELECT brand FROM movies WHERE changed) THEN '2024-01-03' ELSE '2024-01-02' END, p_type, brand, -1, -1
  FROM movies x WHERE changed OR brand NOT IN (SELECT brand FROM movies WHERE changed)
UNION ALL SELECT 'fact_movies', {DAY_1}::VARCHAR, NULL, p_retailprice, -1, -1 FROM movies
UNION ALL SELECT 'fact_movies', {DAY_2}::VARCHAR, NULL, p_retailprice + 1.0, -1, -1 FROM movies WHERE changed
UNION ALL SELECT 'fact_persons', {DAY_1}::VARCHAR, NULL, c_acctbal, -1, -1 FROM persons
UNION ALL SELECT 'fact_persons', {DAY_1}::VARCHAR, NULL, c_acctbal, -1, -1 FROM persons
UNION ALL SELECT 'fact_persons', {DAY_2}::VARCHAR, NULL, c_acctbal + 1.0, -1, -1 FROM persons, (VALUES (1), (2)) AS twice WHERE changed""",

    "export_lines": """
SELECT *, 'customer' AS _entity_type FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) <= 100""",

    "timestamps_over_loads": """
SELECT event_id, ts AS at, CASE WHEN ts >= TIMESTAMP '2024-01-15' AND event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d')
                                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS day FROM events""",

    "repeated_row_ids": f"""
WITH ids AS (SELECT l_partkey::VARCHAR || '-' || l_suppkey::VARCHAR AS id, l_shipdate < TIMESTAMP '{q.SECOND_LOAD}' AS early FROM lineitem),
later AS (SELECT id, count(*) AS times FROM ids WHERE NOT early GROUP BY id)
SELECT id, times, id IN (SELECT id FROM ids WHERE early) AS seen_before FROM later
WHERE times > 1 OR id IN (SELECT id FROM ids WHERE early)""",

    "history_compaction": f"""
WITH runs AS (SELECT *, {' + '.join(f"(CASE WHEN ts >= TIMESTAMP '{c}' THEN 1 ELSE 0 END)" for c in q.COMPACTION_DAYS)} AS run FROM events),
versions AS (SELECT * FROM runs WHERE run < {len(q.COMPACTION_DAYS)}
             QUALIFY row_number() OVER (PARTITION BY user_id, run ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_id, user_id, ts, event_type, value, props,
       md5(concat_ws('|', coalesce(user_id::VARCHAR, ''), coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), ''))) AS dbt_scd_id,
       ts AS dbt_updated_at, ts AS dbt_valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY run) AS dbt_valid_to
FROM versions""",

    "lists_kept_as_json": """
SELECT l_orderkey, l_linenumber,
       to_json([{'id': l_partkey, 'name': l_returnflag}, {'id': l_suppkey, 'name': l_linestatus}])::VARCHAR AS parties,
       l_suppkey AS origin__sold_by__id, l_linestatus AS origin__sold_by__name, to_json([l_linenumber])::VARCHAR AS origin__places,
       to_json({'id': l_partkey, 'name': l_returnflag})::VARCHAR AS whole
FROM lineitem""",

    "layer_materialization": """
SELECT event_id, user_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
}
