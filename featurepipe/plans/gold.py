"""The gold composite. Distinct-member counts per key (E1) left-joined to the entity (D1),
typed projection (B18) and derived features (B7-B11). The sort by row id (F3) happens at the
sink, not here, so no global sort is planned unless a writer asks for one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.config import DEFAULT, PipelineConfig
from featurepipe.operators.features import add_bucket, add_length, add_log, default_flags
from featurepipe.operators.relations import count_members, join_counts


def crew_counts(relations: Mapping[str, DataFrame], cfg: PipelineConfig = DEFAULT,
                key: str = "key", member: str = "member") -> dict[str, DataFrame]:
    """E1 for each named relation of distinct pairs (``clean_relation``), keyed by ``cfg.key``."""
    return {name: count_members(rel.select(F.col(key).alias(cfg.key), F.col(member).alias("_m")),
                                cfg.key, "_m", name, distinct=True)
            for name, rel in relations.items()}


def gold_build(silver: DataFrame, counts: Mapping[str, DataFrame], cfg: PipelineConfig = DEFAULT,
               split_col: str | None = None) -> DataFrame:
    """Gold features for one frame (or every split of it). ``counts`` from ``crew_counts``."""
    joined = join_counts(silver, cfg.key, counts)
    has_label = cfg.label in silver.columns
    out = joined.select(
        *([F.col(split_col)] if split_col else []),
        F.col(cfg.row_id), F.col(cfg.key), F.col(cfg.title), F.col(cfg.original_title),
        F.col(cfg.start_year).cast("double").alias(cfg.start_year),
        F.col(cfg.runtime).cast("double").alias(cfg.runtime),
        F.col(cfg.votes).cast("double").alias(cfg.votes),
        *([F.col(cfg.label).cast("int").alias(cfg.label)] if has_label else []),
        *[F.col(n) for n in counts],
        *[F.col(f) for f in cfg.flags if f in joined.columns],
    )
    out = add_log(out, cfg.votes, "log_numVotes")
    out = add_length(out, cfg.title, "len_primaryTitle")
    out = add_bucket(out, cfg.start_year, "decade", cfg.decade_width)
    out = default_flags(out, cfg.flags)
    lead = [*([split_col] if split_col else []), cfg.row_id, cfg.key, cfg.title, cfg.original_title,
            cfg.start_year, cfg.runtime, cfg.votes, *([cfg.label] if has_label else []), *counts,
            "log_numVotes", "len_primaryTitle", "decade", *cfg.flags]
    return out.select(*lead)


def gold_types(cfg: PipelineConfig = DEFAULT, label: bool = True, counts: tuple[str, ...] = ("n_directors", "n_writers")) -> str:
    """DDL of a processed split as ``gold_build`` orders its columns."""
    doubles, longs = (cfg.start_year, cfg.runtime, cfg.votes), (cfg.row_id, *counts, "len_primaryTitle")
    names = [cfg.row_id, cfg.key, cfg.title, cfg.original_title, *doubles, *([cfg.label] if label else []), *counts,
             "log_numVotes", "len_primaryTitle", "decade", *cfg.flags]

    def kind(n: str) -> str:
        if n in (cfg.key, cfg.title, cfg.original_title):
            return "string"
        return "bigint" if n in longs else "int" if n in (cfg.label, *cfg.flags) else "double"
    return ", ".join(f"`{n}` {kind(n)}" for n in names)
