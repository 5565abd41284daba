"""The silver composite. Strip accents -> repair swapped years -> four lenient casts ->
label map -> dedup keep-first -> dense row id, for one frame (or each split of it when it carries
a split column). The row id runs its range partitioning while the stage is composed.

The first four steps are row-local and leave key and order alone, so duplicates go first: each
kept row is cleaned once, after the shuffle that spreads the rows over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from featurepipe.config import DEFAULT, PipelineConfig
from featurepipe.operators.cleaning import cast_ranges, map_label, null_sentinels, repair_swap, strip_accents_cols
from featurepipe.operators.ordering import dedup_first, with_row_id


def bronze_clean(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Bronze projection: trimmed text with sentinels as NULL on the ingested columns."""
    return null_sentinels(df, list(cfg.bronze_cols), cfg.sentinels, trim=True)


def clean_values(df: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The row-local silver steps: accents, swapped years, lenient casts, label map."""
    out = strip_accents_cols(df, [cfg.title])
    out = repair_swap(out, cfg.start_year, cfg.end_year, cfg.year_min, cfg.year_max)
    out = cast_ranges(out, {
        cfg.start_year: (cfg.year_min, cfg.year_max),
        cfg.end_year: (cfg.year_min, cfg.year_max),
        cfg.runtime: (cfg.runtime_min, cfg.runtime_max),
        cfg.votes: (cfg.votes_min, None),
    })
    return map_label(out, cfg.label)


def silver_clean(df: DataFrame, order: Sequence[str], cfg: PipelineConfig = DEFAULT,
                 split_col: str | None = None, keep_order: bool = False, raw: bool = False) -> DataFrame:
    """``order`` names unique row-order columns (file position or a natural key); they are
    dropped after the row id is assigned unless ``keep_order``. With ``raw`` the frame has not been
    through ``bronze_clean``: the columns that dedup looks at are cleaned first, the others on the
    kept rows only, with the same result."""
    parts = [split_col] if split_col else []
    if raw:
        needed = {*parts, cfg.key, *order}
        df = null_sentinels(df, [c for c in cfg.bronze_cols if c in needed], cfg.sentinels, trim=True)
    # the key leads: rows are sorted by it, and by the few splits only among equal keys
    out = dedup_first(df, [cfg.key, *parts], order)
    out = clean_values(bronze_clean(out, cfg) if raw else out, cfg)
    out = with_row_id(out, order, cfg.row_id, partition_by=parts)
    if not keep_order:
        out = out.drop(*order)
    return out
