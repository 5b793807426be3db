"""Both ingest flows over toy landed files."""

import datetime as dt
import gzip
import json
import os
import uuid

import pytest

from tidemark.plans.ingest import ingest_changes, ingest_export
from tidemark.session import state_dir
from tidemark.sources import loads, schemas


def _lines(path, records, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if gz else open
    with opener(path, "wt") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def _raw(spark, root, table):
    return loads.read_table(spark, root, table, schemas.struct_of(schemas.RAW_TABLES[table]))


def _detail(i, status=200):
    return {"id": i, "title": f"m{i}", "status": "Released", "http_status": status, "genres": [{"id": 28, "name": "Action"}],
            "belongs_to_collection": {"id": 5, "name": "x"}}


def test_ingest_export(spark, tmp_path):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    _lines(str(tmp_path / "exp" / "movie_ids_01_01_2025.json.gz"), [{"id": 1}, {"id": 2}, {"id": 3}], gz=True)
    _lines(str(tmp_path / "det" / "d.json"), [_detail(1), _detail(2, 404), _detail(3)])
    ingest_export(spark, str(tmp_path / "exp"), str(tmp_path / "det"), "movie", raw, "1764800000.000000", limit=2)
    got = _raw(spark, raw, "tmdb_movies").collect()
    assert [(r.id, r._entity_type, r.belongs_to_collection__name) for r in got] == [(1, "movie", "x")]
    assert json.loads(got[0].genres) == [{"id": 28, "name": "Action"}]
    row = loads.ledger(spark, raw).first()
    assert (row.row_count, row.target_table, row.violations) == (1, "tmdb_movies", 0)


def test_ingest_export_failing_detail(spark, tmp_path):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    _lines(str(tmp_path / "exp" / "e.json.gz"), [{"id": 1}], gz=True)
    _lines(str(tmp_path / "det" / "d.json"), [_detail(1, 500)])
    with pytest.raises(Exception, match="status 500"):
        ingest_export(spark, str(tmp_path / "exp"), str(tmp_path / "det"), "movie", raw, "1.0")


def test_ingest_changes(spark, tmp_path):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    pages_df = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1, 1, [(1, False)]), (dt.date(2025, 1, 2), 1, 2, [(2, False)]),
         (dt.date(2025, 1, 2), 2, 2, None), (dt.date(2025, 1, 3), 1, 1, [(3, False)])],
        "change_date date, page int, total_pages int, results array<struct<id:bigint, adult:boolean>>")
    pages_df.write.partitionBy("change_date").parquet(str(tmp_path / "pages"))
    _lines(str(tmp_path / "det" / "d.json"), [_detail(1), _detail(2), _detail(3)])
    ingest_changes(spark, str(tmp_path / "pages"), str(tmp_path / "det"), "movie",
                   "2025-01-01", "2025-01-02", raw, "1764800000.000000")
    assert sorted(r.id for r in _raw(spark, raw, "ids_movies_changes").collect()) == [1, 2]
    assert {(r.failed_pages, r.absent_pages) for r in loads.ledger(spark, raw).collect()} == {(1, 0)}
    ch = _raw(spark, raw, "movie_changes")
    assert sorted(r.id for r in ch.collect()) == [1, 2] and "_entity_type" not in ch.columns


def test_ids_listed_twice_keep_apart(spark, tmp_path):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    pages_df = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1, 2, [(1, False), (1, False)]), (dt.date(2025, 1, 1), 2, 2, [(1, False)])],
        "change_date date, page int, total_pages int, results array<struct<id:bigint, adult:boolean>>")
    pages_df.write.partitionBy("change_date").parquet(str(tmp_path / "pages"))
    _lines(str(tmp_path / "det" / "d.json"), [_detail(1)])
    ingest_changes(spark, str(tmp_path / "pages"), str(tmp_path / "det"), "movie",
                   "2025-01-01", "2025-01-02", raw, "1764800000.000000")
    ids = _raw(spark, raw, "ids_movies_changes")
    assert ids.columns == ["id", "adult", "_dlt_load_id", "_dlt_id"]
    assert (ids.count(), ids.select("_dlt_id").distinct().count()) == (3, 3)
    ledger = {r.schema_name: r for r in loads.ledger(spark, raw).collect()}
    assert ledger["ids_movies_changes"].row_count == 3 and ledger["movie_changes"].row_count == 1
    assert all(len(r.schema_version_hash) == 32 for r in ledger.values())


def _land_changes(spark, tmp_path, statuses=()):
    pages_df = spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1, 4, [(1, False), (2, False)]), (dt.date(2025, 1, 1), 3, 4, [(3, False)])],
        "change_date date, page int, total_pages int, results array<struct<id:bigint, adult:boolean>>")
    pages_df.write.mode("overwrite").partitionBy("change_date").parquet(str(tmp_path / "pages"))
    _lines(str(tmp_path / "det" / "d.json"), [_detail(i, dict(statuses).get(i, 200)) for i in (1, 2, 3)])
    return str(tmp_path / "pages"), str(tmp_path / "det")


@pytest.mark.parametrize("where", ["stage", "staged", "commit", "write"])
def test_a_load_that_died_is_run_again(spark, tmp_path, monkeypatch, where):
    """Killed before, between and after its jobs: nothing counts before the rerun, and each row once after it."""
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    listed, details = _land_changes(spark, tmp_path)
    run = lambda load="1764800000.000000": ingest_changes(spark, listed, details, "movie", "2025-01-01", "2025-01-01", raw, load)
    assert run("1764700000.000000")
    before = {t: sorted(map(str, _raw(spark, raw, t).collect())) for t in ("ids_movies_changes", "movie_changes")}

    real, calls = {n: getattr(loads, n) for n in ("stage", "staged", "commit")}, []

    def dies(*a, **k):
        calls.append(a)
        if where == "stage" and len(calls) == 1:  # the first table is staged, the second is not
            return real["stage"](*a, **k)
        raise RuntimeError("executor lost")

    if where == "write":  # the record itself is not written
        monkeypatch.setattr(loads, "_record", dies)
        monkeypatch.setattr(loads, "begin", lambda *a: True)
    else:
        monkeypatch.setattr(loads, where, dies)
    with pytest.raises(RuntimeError, match="executor lost"):
        run()
    monkeypatch.undo()
    assert {t: sorted(map(str, _raw(spark, raw, t).collect())) for t in before} == before
    assert run() and not run()  # the rerun commits; a third run does nothing
    ledger = {(r.load_id, r.target_table): r for r in loads.ledger(spark, raw).collect()}
    assert {k: (r.row_count, r.failed_pages, r.absent_pages, r.violations) for k, r in ledger.items()} == {
        (load, t): (3, 0, 2, 0) for load in ("1764700000.000000", "1764800000.000000") for t in before}
    for t in before:
        assert sorted((r["id"], r["_dlt_load_id"]) for r in _raw(spark, raw, t).collect()) == [
            (i, load) for i in (1, 2, 3) for load in ("1764700000.000000", "1764800000.000000")]


def test_a_smaller_rerun_leaves_nothing_of_the_larger(spark, tmp_path, monkeypatch):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    listed, details = _land_changes(spark, tmp_path)
    run = lambda: ingest_changes(spark, listed, details, "movie", "2025-01-01", "2025-01-01", raw, "1.0")
    monkeypatch.setattr(loads, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run()
    monkeypatch.undo()
    _land_changes(spark, tmp_path, {1: 404, 2: 404, 3: 404})
    assert run() and _raw(spark, raw, "movie_changes").count() == 0 and _raw(spark, raw, "ids_movies_changes").count() == 3


def test_row_ids_that_repeat_are_counted_or_refused(spark, tmp_path):
    raw = f"{state_dir(spark)}/ingest-{uuid.uuid4().hex}"
    listed, details = _land_changes(spark, tmp_path)
    _lines(str(tmp_path / "det" / "again.json"), [_detail(2)])  # one response landed twice
    with pytest.raises(ValueError, match="movie_changes: 1 violations"):
        ingest_changes(spark, listed, details, "movie", "2025-01-01", "2025-01-01", raw, "1.0", strict=True)
    assert ingest_changes(spark, listed, details, "movie", "2025-01-01", "2025-01-01", raw, "1.0")
    assert {r.target_table: r.violations for r in loads.ledger(spark, raw).collect()} == {"ids_movies_changes": 0, "movie_changes": 1}
