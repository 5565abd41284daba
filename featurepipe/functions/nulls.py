"""Sentinel text -> NULL (B1, B2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_sentinel(c: str | Column, sentinels: Iterable[str], trim: bool = True) -> Column:
    """NULL when the (optionally trimmed) text is a sentinel, else the (trimmed) text.

    With ``trim=True`` the value is cast to string and SQL-trimmed (spaces only), and blank
    sentinels are ignored, so a blank cell stays ``''``. With ``trim=False`` the match is exact
    and blank sentinels count. Case-sensitive either way. Sentinels travel as literals, never
    through SQL text, so backslashes are kept as written.
    """
    col = _col(c).cast("string")
    if trim:
        values = [s for s in sentinels if s.strip()]
        col = F.trim(col)
    else:
        values = list(sentinels)
    if not values:
        return col
    return F.when(col.isin(*values), F.lit(None).cast("string")).otherwise(col)
