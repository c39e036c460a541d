"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: str | Column, sep: str = "") -> Column:
    """``bigint`` from the first 15 hex digits of ``md5(c1 || sep || c2 ...)``.

    15 hex digits = 60 bits, so the value always fits a signed 64-bit integer.
    The default ``sep=''`` keeps the original key layout, where ``('ab','c')``
    and ``('a','bc')`` hash alike; NULL in any part gives NULL.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    joined = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    if sep:
        # concat_ws skips NULLs; keep the NULL-in, NULL-out rule
        any_null = F.lit(False)
        for p in parts:
            any_null = any_null | p.isNull()
        joined = F.when(~any_null, joined)
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")
