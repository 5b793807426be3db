"""Change listings restricted to a date window (A5)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def default_window(today: _dt.date, start: _dt.date | None = None,
                   end: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """Each bound defaults to the day before ``today``, separately."""
    y = today - _dt.timedelta(days=1)
    return (start or y, end or y)


def in_window(c: str | Column, start: _dt.date | str, end: _dt.date | str) -> Column:
    """``start <= day(c) <= end``, both ends inclusive, written on the raw column
    (``c >= start AND c < end + 1 day``) so it reaches the Parquet scan."""
    col = F.col(c) if isinstance(c, str) else c
    s = _dt.date.fromisoformat(str(start))
    e = _dt.date.fromisoformat(str(end)) + _dt.timedelta(days=1)
    return (col >= F.lit(s.isoformat()).cast("timestamp_ntz")) & (col < F.lit(e.isoformat()).cast("timestamp_ntz"))


def change_window(df: DataFrame, column: str, start, end) -> DataFrame:
    return df.filter(in_window(column, start, end))


def read_change_window(spark: SparkSession, path: str, start, end,
                       partition_col: str = "change_date") -> DataFrame:
    """Landed changes partitioned by ``change_date``: the window prunes
    partitions, so only the days asked for are listed and read."""
    return spark.read.parquet(path).filter(
        F.col(partition_col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    )
