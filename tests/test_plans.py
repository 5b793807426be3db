"""Plan checks and the oracle comparison on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_udf_no_cartesian(spark, name):
    if name == "build_end_to_end":
        pytest.skip("writes state; covered by the oracle test")
    p = _plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_column_pruning_and_pushdown(spark):
    df = E.queries()["change_window"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    facts = E.queries()["append_after_timestamp"](spark, SF)
    p = _plan(facts)
    assert "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_watermark_is_scalar_subquery(spark):
    p = _plan(E.queries()["append_after_date"](spark, SF))
    assert "Subquery" in p or "subquery" in p


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dim_event_id", "user_id", "event_id", "event_type", "is_current", "valid_from", "valid_to"]


def test_every_query_has_oracle():
    """Only the optional queries, which SQL cannot all express, may lack one."""
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E.queries()) - set(E.oracle_sql()) <= set(E.LLM_QUERIES)


def test_oracle_matches_smallest_scale(spark):
    import scripts.check_oracle as chk

    con = duckdb.connect()
    for t in chk.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name in E.oracle_sql():
        df = E.queries()[name](spark, SF)
        s = df.toPandas()
        o = con.execute(E.oracle_sql()[name]).df()
        if len(s) != len(o) or sorted(s.columns) != sorted(o.columns) or chk.digest(s) != chk.digest(o):
            bad.append(name)
        elif chk.arrow_types(df.toArrow()) != chk.arrow_types(con.execute(E.oracle_sql()[name]).to_arrow_table()):
            bad.append(f"{name} (types)")
    assert bad == []


# Upper bounds on shuffles and scans of the core operators (regressions fail).
PLAN_BOUNDS = {
    "latest_per_key": (1, 1),          # partial + final aggregate, one exchange
    "snapshot_second_run": (2, 2),     # two latest-per-key; the merge join reuses their partitioning
    "dimension_full_refresh": (2, 2),
    "constraint_checks": (4, 2),       # one scan and one key shuffle per table
    "change_window": (0, 1),
    "union_sources": (0, 2),
    "stage_rename": (0, 1),
    "version_validity": (3, 4),        # window per (key, bucket); stats and summary over hot keys
    "enrich_found_ids": (1, 2),        # partial distinct of ids, semi join
    "upsert_single_key": (1, 3),       # distinct batch keys, anti join
    "load_ledger": (1, 1),
}


@pytest.mark.parametrize("name", sorted(PLAN_BOUNDS))
def test_plan_bounds(spark, name):
    from scripts.plan_audit import audit

    a = audit(E.queries()[name](spark, SF))
    max_shuffles, max_scans = PLAN_BOUNDS[name]
    assert a["shuffles"] <= max_shuffles and len(a["scans"]) <= max_scans, a
