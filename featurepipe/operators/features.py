"""Derived features and flags (B7-B15, B18, B19). All row-local projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.functions import has_match, py_strip, to_number, word_count
from featurepipe.functions.text import UNICODE_DIGIT


def add_log(df: DataFrame, src: str, dst: str) -> DataFrame:
    """dst = ln(src + 1) (NULL for NULL; NULL where the argument is not positive)."""
    return df.withColumn(dst, F.ln(F.col(src).cast("double") + 1))


def add_length(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Text length in code points, bigint."""
    return df.withColumn(dst, F.char_length(F.col(src)).cast("long"))


def add_bucket(df: DataFrame, src: str, dst: str, width: float = 10.0) -> DataFrame:
    """floor(x / width) * width as double."""
    x = F.col(src).cast("double")
    return df.withColumn(dst, (F.floor(x / width) * width).cast("double"))


def default_flags(df: DataFrame, cols: Sequence[str], default: int = 0) -> DataFrame:
    """coalesce(int(flag), default); a missing flag column becomes the default."""
    return df.withColumns({
        c: (F.coalesce(F.col(c).cast("int"), F.lit(default)) if c in df.columns else F.lit(default))
        for c in cols})


_OPS = {">": lambda c, t: c > t, "<": lambda c, t: c < t, ">=": lambda c, t: c >= t,
        "<=": lambda c, t: c <= t}


def flag_threshold(df: DataFrame, src: str, dst: str, op: str, t: float) -> DataFrame:
    """int(number(src) op t), NULL when the number is NULL; skipped without ``src``."""
    if src not in df.columns:
        return df
    x = to_number(src, df.schema[src].dataType)
    return df.withColumn(dst, _OPS[op](x, F.lit(float(t))).cast("int"))


def flag_differs(df: DataFrame, a: str, b: str, dst: str) -> DataFrame:
    """1 when b is present and strip(a) differs from strip(b) (a NULL counts as different)."""
    if a not in df.columns or b not in df.columns:
        return df
    same = py_strip(F.col(a)).eqNullSafe(py_strip(F.col(b)))
    return df.withColumn(dst, (F.col(b).isNotNull() & ~same).cast("int"))


def add_word_count(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Whitespace-separated token count ('' -> 0, NULL -> NULL)."""
    if src not in df.columns:
        return df
    return df.withColumn(dst, word_count(src).cast("int"))


def flag_matches(df: DataFrame, src: str, dst: str, pattern: str = UNICODE_DIGIT) -> DataFrame:
    """1 when the pattern occurs in the text, NULL text -> 0 (default pattern: a digit)."""
    if src not in df.columns:
        return df
    return df.withColumn(dst, has_match(src, pattern))


def gold_projection(df: DataFrame, keep: Sequence[str], doubles: Sequence[str],
                    label: str | None = None) -> DataFrame:
    """Keep columns as they are, cast ``doubles`` to double, label to int when present."""
    cols = [F.col(c) for c in keep if c in df.columns]
    cols += [F.col(c).cast("double").alias(c) for c in doubles if c in df.columns]
    if label and label in df.columns:
        cols.append(F.col(label).cast("int").alias(label))
    return df.select(*cols)


def select_features(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    """The listed columns that exist, in list order; label as int when asked for."""
    out = [F.col(c) for c in cols if c in df.columns]
    if label is not None:
        out.append(F.col(label).cast("int").alias(label))
    return df.select(*out)
