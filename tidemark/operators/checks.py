"""Declared constraints checked against data.

The result is a table ``(table_name, check_name, column_name, violations)``:
``not_null`` counts NULL rows; ``unique`` counts key values that occur more
than once (NULL keys are not compared).  Not-null checks share one pass; each
unique check is a partial/final count per key, so a hot key is folded map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stack(counts: DataFrame, table_name: str, rows: list[tuple[str, str, str]]) -> DataFrame:
    """One output row per (check, column, count column) of a one-row aggregate."""
    triples = ", ".join(f"'{chk}', '{col}', {src}" for chk, col, src in rows)
    return counts.selectExpr(
        f"stack({len(rows)}, {triples}) as (check_name, column_name, violations)"
    ).select(F.lit(table_name).alias("table_name"), "check_name", "column_name",
             F.col("violations").cast("bigint").alias("violations"))


def constraint_report(df: DataFrame, table_name: str, not_null: list[str] = (),
                      unique: list[list[str]] = (), primary_key: list[str] | None = None) -> DataFrame:
    """One pass per unique constraint, the not-null counts riding along with
    the first: per key group the row count and the NULLs of each not-null
    column (partial/final aggregate), then one global sum over the groups,
    unpivoted by a single ``stack``."""
    spark = df.sparkSession
    not_null = list(not_null)
    unique = [list(u) for u in unique]
    if primary_key:
        not_null += [c for c in primary_key if c not in not_null]
        if list(primary_key) not in unique:
            unique.append(list(primary_key))

    parts = []
    for j, cols in enumerate(unique):
        carry = not_null if j == 0 else []
        groups = df.groupBy(*cols).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(carry)])
        keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        totals = groups.agg(
            F.count_if(keyed & (F.col("_n") > 1)).alias("dup"),
            *[F.coalesce(F.sum(f"_z{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(carry))])
        rows = [("unique", ",".join(cols), "dup")] + [("not_null", c, f"n{i}") for i, c in enumerate(carry)]
        parts.append(_stack(totals, table_name, rows))
    if not_null and not unique:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)])
        parts.append(_stack(counts, table_name, [("not_null", c, f"n{i}") for i, c in enumerate(not_null)]))
    if not parts:
        return spark.createDataFrame([], "table_name string, check_name string, column_name string, violations bigint")
    return reduce(lambda a, b: a.unionByName(b), parts)
