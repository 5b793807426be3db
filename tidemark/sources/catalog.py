"""Source catalog: declared tables with described columns.

``describe_source`` returns one row per declared column with its declared
type, description and the number of non-NULL values found in the data: one
aggregate pass over the table, unpivoted with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Descriptions of the raw change-history tables (our own wording).
LOAD_NOTES = {
    "_dlt_load_id": "id of the load that landed the row (epoch seconds)",
    "_dlt_id": "unique id of the landed row",
    "_entity_type": "entity the export row belongs to",
}
RAW_DESCRIPTIONS = {
    "tmdb_movies": {
        "adult": "whether the movie is for adults only",
        "backdrop_path": "path of the background image",
        "belongs_to_collection__id": "id of the series the movie is part of",
        "belongs_to_collection__name": "name of that series",
        "belongs_to_collection__poster_path": "path of the series' poster",
        "belongs_to_collection__backdrop_path": "path of the series' background image",
        "budget": "production budget",
        "homepage": "web address of the movie",
        "id": "movie id in the source catalogue",
        "imdb_id": "movie id in the other catalogue",
        "original_language": "language code of the original",
        "original_title": "title in the original language",
        "genres": "JSON list of genres (id, name)",
        "production_companies": "JSON list of companies",
        "production_countries": "JSON list of countries",
        "spoken_languages": "JSON list of languages",
        "origin_country": "JSON list of country codes",
        "credits": "JSON object with cast and crew lists",
        "overview": "summary of the plot",
        "popularity": "popularity score on the load day",
        "poster_path": "path of the poster",
        "release_date": "day of release, as text",
        "revenue": "revenue so far",
        "runtime": "length in minutes",
        "status": "production status",
        "tagline": "advertising line",
        "title": "title in the language of the request",
        "video": "whether the entry is a video",
        "vote_average": "mean vote on the load day",
        "vote_count": "number of votes on the load day",
        **LOAD_NOTES,
    },
    "tmdb_persons": {
        "adult": "whether the person works in films for adults",
        "biography": "biography",
        "birthday": "day of birth, as text",
        "gender": "code of the gender",
        "id": "person id in the source catalogue",
        "imdb_id": "person id in the other catalogue",
        "known_for_department": "department the person is best known for",
        "name": "name",
        "also_known_as": "JSON list of alternative names",
        "place_of_birth": "place of birth",
        "popularity": "popularity score on the load day",
        "profile_path": "path of the portrait",
        "deathday": "day of death, as text",
        "homepage": "web address of the person",
        **LOAD_NOTES,
    },
    "ids_movies_changes": {
        "id": "id that a change listing named",
        "adult": "whether the listing marks it for adults only",
        **LOAD_NOTES,
    },
    "_dlt_loads": {
        "load_id": "id of a committed load (epoch seconds)",
        "schema_name": "name of the loaded table's schema",
        "status": "0 for a completed load",
        "inserted_at": "when the load was committed",
        "schema_version_hash": "hash of the schema the load was written with",
    },
}
TABLE_DESCRIPTIONS = {
    "tmdb_movies": "movies of the daily export with their details",
    "movie_changes": "details of the movies that change listings named",
    "tmdb_persons": "persons of the daily export with their details",
    "person_changes": "details of the persons that change listings named",
    "ids_movies_changes": "movie ids as change listings named them",
    "ids_persons_changes": "person ids as change listings named them",
    "_dlt_loads": "one row for each table of a committed load",
}

# Change tables share the descriptions of their export table.
DESCRIBED_AS = {"movie_changes": "tmdb_movies", "person_changes": "tmdb_persons", "ids_persons_changes": "ids_movies_changes"}


def notes(table: str) -> dict[str, str]:
    """The description of each declared column of a raw table."""
    return RAW_DESCRIPTIONS.get(DESCRIBED_AS.get(table, table), {})


def described(df: DataFrame, table: str) -> DataFrame:
    """``df`` with its columns' descriptions as comments, which Parquet files and catalogs keep."""
    known = notes(table)
    return df.select(*[F.col(c).alias(c, metadata={"comment": known[c]}) if c in known else F.col(c) for c in df.columns])

# Descriptions of the driver's lineitem table, used by the catalog query.
LINEITEM_CATALOG = [
    ("l_orderkey", "bigint", "order the line belongs to"),
    ("l_partkey", "bigint", "part sold on the line"),
    ("l_suppkey", "bigint", "supplier of the part"),
    ("l_linenumber", "int", "line number within the order"),
    ("l_quantity", "double", "quantity sold"),
    ("l_extendedprice", "double", "price before discount"),
    ("l_discount", "double", "discount rate"),
    ("l_tax", "double", "tax rate"),
    ("l_returnflag", "string", "return flag"),
    ("l_linestatus", "string", "line status"),
    ("l_shipdate", "timestamp_ntz", "ship date"),
]


def describe_source(df: DataFrame, table_name: str, columns: list[tuple[str, str, str]]) -> DataFrame:
    counts = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, (c, _, _) in enumerate(columns)])
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    stack = ", ".join(
        "{}, {}, {}, n{}".format(*map(quoted, (c, t, d)), i)
        for i, (c, t, d) in enumerate(columns)
    )
    return counts.selectExpr(
        f"stack({len(columns)}, {stack}) as (column_name, data_type, description, non_null)"
    ).select(
        F.lit(table_name).alias("table_name"), "column_name", "data_type", "description",
        F.col("non_null").cast("bigint").alias("non_null"),
    )


def raw_catalog(raw: dict[str, DataFrame]) -> DataFrame:
    """The source declaration of the raw tables (A17): every declared column of
    each table with its type, description and non-NULL count, one aggregate
    pass per table."""
    from functools import reduce

    from tidemark.sources.schemas import RAW_TABLES, spark_type

    parts = []
    for name, df in raw.items():
        cols = [(c, spark_type(t), notes(name)[c]) for c, t in RAW_TABLES[name]]
        parts.append(describe_source(df, name, cols))
    return reduce(lambda a, b: a.unionByName(b), parts)
