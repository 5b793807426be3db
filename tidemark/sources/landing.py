"""Writing a fetched batch as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_batch(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """One JSON document per row, written by every task in parallel."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
