"""Epochs, zones and dates.

Everything here returns ``timestamp_ntz`` or ``date``, so results do not
depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference's staging models and marts.
LOCAL_ZONE = "America/Argentina/Buenos_Aires"
OPEN_END_DATE = "9999-12-31"
EXPORT_DATE_FORMAT = "%m_%d_%Y"

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` (read as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _col(ts))


def epoch_seconds_text(ts) -> Column:
    """Exact ``seconds.micros`` text of a timestamp, the form of a load id."""
    m = epoch_micros(ts)
    secs = F.floor(m / F.lit(1_000_000)).cast("bigint")
    frac = F.pmod(m, F.lit(1_000_000))
    return F.concat(secs.cast("string"), F.lit("."), F.lpad(frac.cast("string"), 6, "0"))


def micros_to_ntz(micros) -> Column:
    return F.timestamp_add("MICROSECOND", _col(micros), F.expr(_EPOCH_NTZ))


def epoch_text_to_local(text, zone: str = LOCAL_ZONE) -> Column:
    """Load id text -> double -> instant -> wall clock in ``zone``.

    Micros are rounded, not truncated (T6).  A text that is not a number
    raises under ANSI mode, as a bad cast does in the reference.
    """
    micros = F.round(_col(text).cast("double") * F.lit(1_000_000.0)).cast("bigint")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), micros_to_ntz(micros))


def to_day(ts) -> Column:
    """Timestamp -> DATE."""
    return F.to_date(_col(ts))


def day_before(d) -> Column:
    """DATE minus one day, still a DATE."""
    return F.date_sub(_col(d), 1)


def open_end() -> Column:
    """The open-ended validity date."""
    return F.lit(OPEN_END_DATE).cast("date")


def run_date_col(run_date: _dt.date | str | None) -> Column:
    """Build date stamp (H13): an argument, ``current_date()`` only if None."""
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def day_start(d) -> Column:
    """Midnight of a DATE as ``timestamp_ntz`` (C4: a date compares as midnight)."""
    return _col(d).cast("timestamp_ntz")
