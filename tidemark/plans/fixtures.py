"""Change-history inputs derived from the driver's tables.

The driver ships TPC-H-like tables, not movie exports.  These functions derive
the shapes the operators consume, in Spark, from the whole tables:

* ``events`` is a change log: key ``user_id``, version time ``ts``;
* ``raw_events`` stamps events as landed raw rows (load id, row id);
* ``packed_orders`` packs each order's lines into records holding JSON arrays
  (a genres-like list and a credits-like object) and a page of items;
* ``order_versions`` makes orders versions of their customer and attaches
  each order's records;
* ``movie_raw`` / ``land_movie_raw`` derive and land the four raw tables of the
  movie and person build.

A line's record is set by its order and its block of ``SUPPLIER_BLOCK``
suppliers, whatever the size of the order: an order that holds a third of all
lines spreads over every block, and suppliers grow with the lines, so no
``collect_list`` gathers a group that grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import row_id, ts_text
from tidemark.functions.timefmt import epoch_seconds_text
from tidemark.operators.history import history_from_changes
from tidemark.plans.storage import CODEC, release_shuffles

SUPPLIER_BLOCK = 50
#: Records of one customer's order are movies of their own: customer times this, plus the block.
MOVIES_PER_CUSTOMER = 100_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events(events: DataFrame) -> DataFrame:
    """Events as landed raw rows: ``id`` = user, load id = epoch text of ts,
    row id = md5(load id | event id)."""
    lid = epoch_seconds_text("ts")
    return events.select(
        F.col("user_id").alias("id"), "event_id", "ts", "event_type", "value", "props",
        lid.alias("_dlt_load_id"), row_id(lid, F.col("event_id")).alias("_dlt_id"),
    )


def brand_no(c: str = "p_brand") -> Column:
    return F.substring_index(F.col(c), "#", -1).cast("int")


def supplier_block(c: str = "l_suppkey") -> Column:
    """Number of the supplier's block from 0; -1 without a supplier."""
    return F.coalesce(F.floor(F.col(c) / F.lit(SUPPLIER_BLOCK)).cast("bigint"), F.lit(-1).cast("bigint"))


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part's brand and type and the record (``part_no``) they go to."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = li.join(part, li.l_partkey == part.p_partkey, "inner").drop("p_partkey")
    return lines.withColumn("part_no", supplier_block())


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a paged listing: an empty page 1, a failed page 2 (no
    results), and its records as the pages from 3 on."""
    rec = packed_orders(spark, sf_dir).select("l_orderkey", (F.col("part_no") + 3).alias("page"), "results")
    item = rec.schema["results"].dataType
    heads = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct().select("l_orderkey", F.explode(
        F.array(F.struct(F.lit(1).cast("bigint").alias("page"), F.array().cast(item).alias("results")),
                F.struct(F.lit(2).cast("bigint").alias("page"), F.lit(None).cast(item).alias("results")))).alias("h"))
    return rec.unionByName(heads.select("l_orderkey", "h.*"))


def packed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per (order, part_no) with ``genres`` (JSON list of
    ``{id: brand number, name: part type}``), ``credits`` (JSON object with a
    ``cast`` list of parts and a ``crew`` list of suppliers), ``results`` (an
    array of ``{id: part, adult: returned}`` items), ``n_items``."""
    lines = tagged_lines(spark, sf_dir)
    ok, ln = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    genre = F.struct(brand_no().alias("id"), F.col("p_type").alias("name"))
    cast_el = F.struct(F.col("l_partkey").alias("id"),
                       F.concat_ws("-", ok, ln, F.col("l_partkey").cast("string")).alias("credit_id"),
                       F.col("l_returnflag").alias("character"))
    crew_el = F.struct(F.col("l_suppkey").alias("id"),
                       F.concat_ws("-", ok, ln, F.col("l_suppkey").cast("string")).alias("credit_id"),
                       F.col("l_linestatus").alias("department"),
                       F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("job"))
    item = F.struct(F.col("l_partkey").alias("id"), (F.col("l_returnflag") == F.lit("R")).alias("adult"))
    return lines.groupBy("l_orderkey", "part_no").agg(
        F.to_json(F.collect_list(genre)).alias("genres"),
        F.to_json(F.struct(F.collect_list(cast_el).alias("cast"), F.collect_list(crew_el).alias("crew"))).alias("credits"),
        F.collect_list(item).alias("results"),
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
    )


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a type 2 history of their customer (version time
    ``o_orderdate``, ties broken by order key, valid until the customer's next
    order), with each order's packed records attached.

    The validity is computed on the narrow ``orders`` table; the packed records
    (one per order and supplier block) join it by order key.  An order
    without lines is still a version: it ends the one before it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    vid = F.md5(F.concat_ws("|", F.col("o_custkey").cast("string"), ts_text("o_orderdate"),
                            F.col("o_orderkey").cast("string")))
    hist = history_from_changes(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], version_id=vid)
    rec = packed_orders(spark, sf_dir)
    return rec.join(hist, rec.l_orderkey == hist.o_orderkey, "inner").drop("l_orderkey")


def movie_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw tables of the movie/person build, derived from the driver
    tables, all loads landed so far.

    Movies: each packed order record is a landed row of the movie of its
    customer and supplier block (so records of one order are different movies),
    loaded at ``o_orderdate`` (load id = its epoch text), with the record's
    genres and credits JSON; finished orders (status F) land in the export
    table, the others in the changes table.  Persons: every customer in the
    export table's load, then the customers of nation 3 again in a load of the
    changes table with a new popularity."""
    from tidemark.sources.rawload import apply_schema
    from tidemark.sources.schemas import MOVIE_CHANGES, PERSON_CHANGES, TMDB_MOVIES, TMDB_PERSONS

    rec = packed_orders(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    m = rec.join(orders, rec.l_orderkey == orders.o_orderkey, "inner")
    lid = epoch_seconds_text("o_orderdate")
    movie = F.col("o_custkey") * F.lit(MOVIES_PER_CUSTOMER) + F.col("part_no") + 1
    base = m.select(
        movie.alias("id"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("popularity"),
        F.col("n_items").alias("vote_count"), "genres", "credits",
        F.concat(F.lit("tt"), F.col("o_orderkey").cast("string")).alias("imdb_id"),
        F.concat(F.col("o_orderpriority"), F.lit(" of "), F.col("o_custkey").cast("string")).alias("original_title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"), (F.col("part_no") + 60).alias("runtime"),
        F.lower("o_orderstatus").alias("original_language"), (F.col("o_orderstatus") == "P").alias("adult"),
        F.col("o_custkey").alias("belongs_to_collection__id"), F.col("o_orderpriority").alias("belongs_to_collection__name"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("budget"), (F.col("n_items") / 4).alias("vote_average"),
        lid.alias("_dlt_load_id"),
        row_id(lid, movie, F.col("o_orderkey")).alias("_dlt_id"),
    )
    # One frame for both movie tables, routed by ``raw_table`` (export rows
    # tagged), so landing packs the lines once.
    movies = apply_schema(
        base.withColumn("_entity_type", F.when(F.col("status") == "F", F.lit("movie"))),
        TMDB_MOVIES, keep_extra=False,
    ).withColumn("raw_table", F.when(F.col("status") == "F", F.lit("tmdb_movies")).otherwise(F.lit("movie_changes")))

    cust = table(spark, sf_dir, "customer")
    p1 = cust.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                     F.col("c_acctbal").alias("popularity"), F.lit(PERSON_LOAD_1).alias("_dlt_load_id"),
                     F.lit("person").alias("_entity_type"))
    p2 = (cust.filter(F.col("c_nationkey") == 3)
          .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                  (F.col("c_acctbal") + F.lit(1.0)).alias("popularity"),
                  F.lit(PERSON_LOAD_2).alias("_dlt_load_id"), F.lit("person").alias("_entity_type")))
    stamped = lambda p: p.withColumn("_dlt_id", row_id(F.col("_dlt_load_id"), F.col("id")))
    return {
        "movies": movies,
        "tmdb_persons": apply_schema(stamped(p1), TMDB_PERSONS, keep_extra=False),
        "person_changes": apply_schema(stamped(p2), PERSON_CHANGES, keep_extra=False),
    }


def land_movie_raw(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """Write the derived raw tables under ``root/raw`` (the two movie tables in
    one routed write) and return the four raw tables read back."""
    from tidemark.sources.schemas import MOVIE_CHANGES, TMDB_MOVIES, struct_of

    derived = movie_raw(spark, sf_dir)
    derived["movies"].write.mode("overwrite").option("compression", CODEC).partitionBy("raw_table").parquet(f"{root}/raw/movies")
    schema = struct_of(TMDB_MOVIES).add("raw_table", "string")
    movies = spark.read.schema(schema).parquet(f"{root}/raw/movies")
    raw = {
        "tmdb_movies": movies.filter(F.col("raw_table") == "tmdb_movies").select(*[c for c, _ in TMDB_MOVIES]),
        "movie_changes": movies.filter(F.col("raw_table") == "movie_changes").select(*[c for c, _ in MOVIE_CHANGES]),
    }
    for name in ("tmdb_persons", "person_changes"):
        df = derived[name]
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{root}/raw/{name}")
        raw[name] = spark.read.schema(df.schema).parquet(f"{root}/raw/{name}")
    release_shuffles(spark)
    return raw


# Fixed parameters of the movie build over the driver tables.
MOVIE_LOAD_CUTOFF = "883612800.000000"   # 1998-01-01 00:00:00 UTC as a load id
PERSON_LOAD_1 = "852076800.000000"       # 1997-01-01 00:00:00 UTC
PERSON_LOAD_2 = "999302400.000000"       # 2001-09-01 00:00:00 UTC


def raw_until(raw: dict[str, DataFrame], load_id: str) -> dict[str, DataFrame]:
    """The raw tables as they stood when loads up to ``load_id`` (excluded) had landed."""
    return {k: v.filter(F.col("_dlt_load_id") < F.lit(load_id)) for k, v in raw.items()}
