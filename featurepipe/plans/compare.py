"""Quality comparison of a raw and a cleaned stage: the before/after pairs of the k largest
changed titles (F8) and the percentage of non-missing values per column in each stage (E7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from featurepipe.functions import strip_accents
from featurepipe.operators.ordering import before_after
from featurepipe.operators.stats import coverage


def compare_stages(raw: DataFrame, clean: DataFrame, title: str, cols: Sequence[str], k: int = 10,
                   tiebreak: Sequence[str] = (), keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    pairs = before_after(raw, title, k, strip_accents, tiebreak=tiebreak, keep=keep)
    cov = coverage(raw, cols, "raw").unionByName(coverage(clean, cols, "clean"))
    return pairs, cov
