"""Row-local cleaning operators (B1-B6, B16, C2). Each is DataFrame -> DataFrame, built only
from Spark expressions, so Catalyst fuses a chain of them into one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from featurepipe.functions import null_if_sentinel, null_outside, strip_accents, to_number


def null_sentinels(df: DataFrame, cols: Sequence[str], sentinels: Iterable[str],
                   trim: bool = True) -> DataFrame:
    """B1/B2: sentinel spellings become NULL in ``cols`` (string result)."""
    sentinels = tuple(sentinels)
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: null_if_sentinel(c, sentinels, trim=trim) for c in present})


def strip_accents_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NFD + delete combining marks (Mn) on each present column."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: strip_accents(c) for c in present})


def repair_swap(df: DataFrame, a: str, b: str, lo: float, hi: float) -> DataFrame:
    """Where number(a) is NULL and number(b) lies in [lo, hi]: a <- b, b <- NULL.

    Both new values are computed from the same pre-image, so the order of the two assignments
    does not matter. Values keep their input type (text before the numeric cast).
    """
    if a not in df.columns or b not in df.columns:
        return df
    types = dict(df.dtypes)
    # the two numbers get a projection of their own: each is parsed once for all its uses
    out = df.withColumns({"_fp_na": to_number(a, df.schema[a].dataType), "_fp_nb": to_number(b, df.schema[b].dataType)})
    mask = F.col("_fp_na").isNull() & F.coalesce(F.col("_fp_nb").between(float(lo), float(hi)), F.lit(False))
    return out.withColumns({
        a: F.when(mask, F.col(b).cast(types[a])).otherwise(F.col(a)),
        b: F.when(mask, F.lit(None).cast(types[b])).otherwise(F.col(b)),
    }).drop("_fp_na", "_fp_nb")


def cast_range(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Lenient double cast; unparseable, NaN and out-of-range values become NULL."""
    return cast_ranges(df, {col: (lo, hi)})


def cast_ranges(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """B5 for several columns: all are parsed in one projection, once each, and compared in the next."""
    bounds = {c: b for c, b in bounds.items() if c in df.columns}
    out = df.withColumns({c: to_number(c, df.schema[c].dataType) for c in bounds})
    return out.withColumns({c: null_outside(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


# The label spellings the reference maps, as text (booleans arrive as text too).
LABEL_TRUE: tuple[str, ...] = ("True", "true", "1")
LABEL_FALSE: tuple[str, ...] = ("False", "false", "0")


def label_value(c: str | Column) -> Column:
    """B6 expression: True/true/1 -> 1, False/false/0 -> 0, anything else NULL."""
    col = F.col(c) if isinstance(c, str) else c
    s = col.cast("string")
    return (F.when(s.isin(*LABEL_TRUE), F.lit(1))
            .when(s.isin(*LABEL_FALSE), F.lit(0))
            .otherwise(F.lit(None)).cast("int"))


def map_label(df: DataFrame, col: str = "label") -> DataFrame:
    """Map label text/boolean to int 1/0/NULL; skipped when the column is absent."""
    if col not in df.columns:
        return df
    dtype = dict(df.dtypes)[col]
    if dtype == "boolean":
        return df.withColumn(col, F.col(col).cast("int"))
    if isinstance(df.schema[col].dataType, NumericType):      # 1 and 1.0, 0 and 0.0
        return df.withColumn(col, F.when(F.col(col) == 1, 1).when(F.col(col) == 0, 0).cast("int"))
    return df.withColumn(col, label_value(col))


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns that exist, ignore the rest."""
    return df.drop(*[c for c in cols if c in df.columns])


def changed_rows(df: DataFrame, col: str, fn: Callable[[Column], Column] = strip_accents) -> DataFrame:
    """Rows whose value changes under ``fn`` (NULL-safe comparison)."""
    return df.where(~F.col(col).eqNullSafe(fn(F.col(col))))
