"""Records routed to a table by entity type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entity types with a table, and the table name pattern
# ``tmdb_{entity}s``.
KNOWN_ENTITIES = ("movie", "person")
TABLE_PREFIX = "tmdb_"


def table_for(entity: str | Column, known=KNOWN_ENTITIES, prefix: str = TABLE_PREFIX) -> Column:
    """``prefix || entity || 's'``; an unknown entity raises."""
    e = F.col(entity) if isinstance(entity, str) else entity
    return F.when(e.isin(*known), F.concat(F.lit(prefix), e, F.lit("s"))).otherwise(
        F.raise_error(F.concat(F.lit("entity type not supported: "), F.coalesce(e, F.lit("NULL"))))
    )


def route(df: DataFrame, entity_col: str = "_entity_type", known=KNOWN_ENTITIES,
          prefix: str = TABLE_PREFIX, out: str = "target_table") -> DataFrame:
    return df.withColumn(out, table_for(entity_col, known, prefix))


def write_routed(df: DataFrame, base_path: str, table_col: str = "target_table") -> None:
    """Append each row under ``base_path/target_table=<name>``: one write job
    for all tables, each task writing only the tables it holds."""
    df.write.mode("append").partitionBy(table_col).parquet(base_path)
