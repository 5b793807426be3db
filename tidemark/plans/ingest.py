"""The two ingest flows, composed from the landing operators.

Daily export: export ids (gzip JSON lines) -> entity tag -> join with the
landed detail responses (404 skipped, other errors fail) -> nested objects
flattened -> typed -> stamped -> ``tmdb_<entity>s``.

Changes: landed listing pages in a date window -> items -> ids for
``ids_<entity>s_changes`` -> joined with landed details -> flattened, typed,
stamped -> ``<entity>_changes``.

Each run is one load, staged and then committed with its ledger rows
(``sources.loads``): row counts, pages that failed or never landed, and the
violations of the declared constraints, row ids compared with those of all
earlier loads (``plans.rowids``).  A run that died is run again and
replaces what it left; a committed one is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.operators import checks
from tidemark.plans import rowids
from tidemark.sources import catalog, changes, enrich, exports, loads, pages, rawload, routing, schemas

ID_SCHEMA = StructType([StructField("id", LongType(), True)])
HTTP_STATUS = "http_status"
CONTRACTS = {
    "movie": (schemas.TMDB_MOVIES, schemas.MOVIE_CHANGES),
    "person": (schemas.TMDB_PERSONS, schemas.PERSON_CHANGES),
}


def read_details(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Landed detail responses: the record in its landed (nested) shape plus
    the HTTP status of the request as ``http_status`` (records have their own
    ``status``)."""
    schema = schemas.landed_schema(CONTRACTS[entity][0]).add(HTTP_STATUS, IntegerType())
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def _typed(found: DataFrame, columns) -> DataFrame:
    return rawload.apply_schema(rawload.flatten_nested(found), columns, keep_extra=False)


def _violations(spark: SparkSession, root: str, table: str, load_id: str, strict: bool) -> int:
    """Declared constraints (A16) of a staged load: NULLs, and row ids that repeat in it or in earlier loads."""
    schema = schemas.struct_of(schemas.RAW_TABLES[table])
    rows = loads.staged(spark, root, table, load_id, schema)
    nulls = checks.constraint_report(rows, table, not_null=schemas.NOT_NULL).agg(F.sum("violations")).first()[0] or 0
    index = f"{root}/_row_ids/{table}"
    found = nulls + sum(rowids.repeated_ids(spark, index, load_id, rows, c[0]).count() for c in schemas.UNIQUE)
    if found and strict:
        raise ValueError(f"{table}: {found} violations of the declared constraints in load {load_id}")
    rowids.add_ids(spark, index, load_id, rows, schemas.UNIQUE[0][0])
    return found


def _commit(spark: SparkSession, root: str, load_id: str, flow: str, tables: dict[str, str], strict: bool,
            gaps: DataFrame | None = None) -> None:
    violations = {t: _violations(spark, root, t, load_id, strict) for t in tables}
    described = {t: (schemas.struct_of(schemas.RAW_TABLES[t]), name) for t, name in tables.items()}
    loads.commit(spark, root, load_id, flow, described, gaps, violations)


def ingest_export(spark: SparkSession, export_path: str, details_path: str, entity: str,
                  raw_root: str, load_id: str, limit: int | None = None, strict: bool = False) -> bool:
    """§3.1: the daily export of ``entity`` as one load of its raw table; False if it is committed already."""
    flow, tables = f"export_{entity}", [f"{routing.TABLE_PREFIX}{e}s" for e in routing.KNOWN_ENTITIES if e == entity]
    if not loads.begin(spark, raw_root, load_id, flow, tables):
        return False
    ids = exports.tag_entity(exports.read_export_lines(spark, export_path, ID_SCHEMA, limit), entity)
    found = enrich.enrich_found(ids, read_details(spark, details_path, entity), key="id", status=HTTP_STATUS)
    typed = _typed(found.withColumn("_entity_type", F.lit(entity))
                   .withColumn(rawload.LOAD_ID, F.lit(load_id)), CONTRACTS[entity][0])
    stamped = rawload.stamp_load(typed.drop(rawload.ROW_ID), load_id, key=["id"])
    loads.stage(catalog.described(routing.route(stamped), tables[0]), raw_root)
    _commit(spark, raw_root, load_id, flow, {t: flow for t in tables}, strict)
    return True


def ingest_changes(spark: SparkSession, pages_path: str, details_path: str, entity: str,
                   start, end, raw_root: str, load_id: str, strict: bool = False) -> bool:
    """§3.2: changed ids of ``entity`` in [start, end] and their details as one load; False if it is committed already."""
    flow, ids_table, table = f"changes_{entity}", f"ids_{entity}s_changes", f"{entity}_changes"
    if not loads.begin(spark, raw_root, load_id, flow, [ids_table, table]):
        return False
    listed = changes.read_change_window(spark, pages_path, start, end)
    items = pages.flatten_pages(listed, listing=["change_date"], position="place")
    # An id may be listed more than once in a load; where it was listed keeps the row ids apart.
    where = ["change_date", "page", "place"]
    named = rawload.stamp_load(items.select("id", "adult", *where), load_id, key=["id"]).drop(*where)
    loads.stage(catalog.described(named, ids_table), raw_root, ids_table)
    ids = loads.staged(spark, raw_root, ids_table, load_id, schemas.struct_of(schemas.IDS_CHANGES))
    found = enrich.enrich_found(ids, read_details(spark, details_path, entity), key="id", status=HTTP_STATUS)
    typed = _typed(found.withColumn(rawload.LOAD_ID, F.lit(load_id)), CONTRACTS[entity][1])
    loads.stage(catalog.described(rawload.stamp_load(typed.drop(rawload.ROW_ID), load_id, key=["id"]), table), raw_root, table)
    gaps = pages.gap_counts(pages.page_gaps(listed, ["change_date"]))
    _commit(spark, raw_root, load_id, flow, {ids_table: ids_table, table: table}, strict, gaps)
    return True
