"""Lenient numeric parsing with pandas ``to_numeric(errors="coerce")`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Decimal grammar accepted by the lenient cast: optional ASCII whitespace, sign, digits with an
# optional fraction or a bare fraction, optional exponent; or inf/infinity in any case.
# Spark's own cast also takes Java suffixes (1d, 1f), hex floats and NaN; the guard rejects them.
NUMBER_BODY = (
    r"[ \t\n\r\f\x0B]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))"
    r"[ \t\n\r\f\x0B]*"
)
NUMBER_PATTERN = r"^(?:" + NUMBER_BODY + r")\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column, dtype=None) -> Column:
    """Double or NULL. Text outside the grammar, NULL and NaN all give NULL."""
    col = _col(c)
    if dtype is not None and isinstance(dtype, NumericType):
        d = col.cast("double")
        return F.when(~F.isnan(d), d)
    s = col.cast("string")             # no text of the grammar is NaN
    return F.when(s.rlike(NUMBER_PATTERN), F.btrim(s, F.lit(" \t\n\r\f\x0b")).try_cast("double"))


def null_outside(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """NULL below ``lo`` or above ``hi`` (not clamped); either bound optional."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(float(lo)))
    if hi is not None:
        cond = cond & (c <= F.lit(float(hi)))
    if lo is None and hi is None:
        return c
    return F.when(cond, c)
