"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: NULL marker of the common surrogate-key macro.
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def contact_key(email: Column, first: Column, last: Column, sep: str = "") -> Column:
    """MD5 of lower-trimmed email, first and last name, NULL -> ''. No
    separator by default (kept for compatibility: ('ab','c') and ('a','bc')
    collide); pass ``sep`` to avoid that."""
    parts = [F.lower(F.trim(F.coalesce(p, F.lit("")))) for p in (email, first, last)]
    return F.md5(F.concat_ws(sep, *parts))


def surrogate_key(*cols: Column) -> Column:
    """MD5 of the parts cast to string, NULL -> marker, joined by ``-``."""
    parts = [F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
