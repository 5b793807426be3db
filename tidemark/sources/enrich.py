"""Ids enriched with their detail records.

Detail responses are landed with their HTTP status.  An id whose detail is
404 is skipped; any status other than 200 or 404 fails the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOUND, NOT_FOUND = 200, 404


# Fixed value: a response body that means "no such id" even with status 200.
NOT_FOUND_TEXT = "Not found"


def usable_details(details: DataFrame, status: str = "status", body: str | None = None) -> DataFrame:
    """Found details only.  404, or a ``body`` equal to the not-found text,
    is skipped; any status other than 200 and 404 raises, a missing one too."""
    st = F.col(status)
    found = st == FOUND
    if body is not None:
        found = found & ~F.coalesce(F.col(body) == F.lit(NOT_FOUND_TEXT), F.lit(False))
    keep = F.when(
        st.isNull() | ~st.isin(FOUND, NOT_FOUND),
        F.raise_error(F.concat(F.lit("detail request failed with status "), F.coalesce(st.cast("string"), F.lit("NULL")))),
    ).otherwise(found)
    out = details.filter(keep).drop(status)
    return out.drop(body) if body is not None else out


def enrich_found(ids: DataFrame, details: DataFrame, key: str, ids_key: str | None = None,
                 status: str = "status", body: str | None = None) -> DataFrame:
    """Detail rows of the listed ids that were found: an inner equi-join,
    written as a semi join (each detail once however often its id is listed).
    The id side is de-duplicated by a partial/final aggregate first, so a hot
    id folds before the shuffle; AQE broadcasts whichever side is small."""
    ids_key = ids_key or key
    wanted = ids.select(F.col(ids_key).alias(key)).distinct()
    return usable_details(details, status, body).join(wanted, key, "left_semi")
