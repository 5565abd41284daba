"""User-registered table hooks (J1, J2) and the eight built-in cleaning/feature hooks.

A hook is any ``DataFrame -> DataFrame`` function. ``HookRegistry.apply`` chains them in
registration order. The audit (J2) records the columns each hook added from the schemas and,
when it is asked for, counts the rows of every boundary of the chain in one job; a chain whose
audit nobody reads costs nothing. The two median hooks share one pass over their input, which
runs (and is checkpointed) while the chain is composed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.config import DEFAULT, PipelineConfig
from featurepipe.operators.cleaning import drop_if_present
from featurepipe.operators.features import add_word_count, flag_differs, flag_matches, flag_threshold
from featurepipe.operators.stats import group_medians, impute_median
from featurepipe.session import stable

Hook = Callable[[DataFrame], DataFrame]


@dataclass
class _Audit:
    hook: str
    split: str
    cols_added: list[str]
    before: DataFrame
    after: DataFrame
    seen: tuple[str, str] | None = None        # names of the counts before and after


@dataclass
class HookRegistry:
    """Ordered hook list with an audit trail. With ``audited`` every boundary of the chain counts its
    rows as they pass, so the audit is one run of the chain; the counts keep projections from being
    merged across hooks, so it is off by default, and the audit then counts each boundary by itself."""

    hooks: list[tuple[str, Hook]] = field(default_factory=list)
    audited: bool = False
    _audit: list[_Audit] = field(default_factory=list)

    def register(self, fn: Hook, name: str | None = None) -> Hook:
        self.hooks.append((name or getattr(fn, "__name__", f"hook_{len(self.hooks)}"), fn))
        return fn

    def _watched(self, df: DataFrame) -> tuple[DataFrame, str]:
        name = f"fp_rows_{uuid.uuid4().hex}"
        return df.observe(name, F.count(F.lit(1)).alias("n")), name

    def apply(self, df: DataFrame, split: str = "all") -> DataFrame:
        """Run every hook in registration order."""
        if self.audited and self.hooks:
            df, last = self._watched(df)
        for name, fn in self.hooks:
            before, df = df, fn(df)
            added, seen = sorted(set(df.columns) - set(before.columns)), None
            if self.audited:
                df, now = self._watched(df)
                seen, last = (last, now), now
            self._audit.append(_Audit(name, split, added, before, df, seen))
        return df

    def audit(self, spark) -> DataFrame:
        """(hook, split, rows_dropped, cols_added).

        An audited chain runs once for all its counts, which are read from that very execution: jobs that
        other users of the frame start (range sampling, RDDs) have counts of their own.
        """
        schema = "hook string, split string, rows_dropped long, cols_added array<string>"
        if not self._audit:
            return spark.createDataFrame([], schema)
        if all(a.seen for a in self._audit):
            n: dict = {}
            for a, after in zip(self._audit, [*self._audit[1:], None]):
                if after is None or after.seen[0] != a.seen[1]:          # the last hook of a chain
                    run = a.after.select("*")._jdf.queryExecution()      # a plan of its own
                    run.toRdd().count()
                    metrics = run.observedMetrics()
                    for x in (y for b in self._audit for y in b.seen):
                        if metrics.contains(x):
                            n[x] = metrics.apply(x).getLong(0)
            return spark.createDataFrame([(a.hook, a.split, n[a.seen[0]] - n[a.seen[1]], a.cols_added) for a in self._audit], schema)
        frames: list[DataFrame] = []
        places: list[tuple[int, int]] = []
        for a in self._audit:                             # neighbours share their boundary
            if not frames or frames[-1] is not a.before:
                frames.append(a.before)
            frames.append(a.after)
            places.append((len(frames) - 2, len(frames) - 1))
        counts = reduce(DataFrame.unionAll, [f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
                                             for i, f in enumerate(frames)])
        n = {r["i"]: r["n"] for r in counts.collect()}
        return spark.createDataFrame([(a.hook, a.split, n[x] - n[y], a.cols_added)
                                      for a, (x, y) in zip(self._audit, places)], schema)


def _by(df: DataFrame, cfg: PipelineConfig) -> list[str]:
    return [cfg.split] if cfg.split in df.columns else []


def default_hooks(cfg: PipelineConfig = DEFAULT) -> HookRegistry:
    """The eight built-in hooks, in the order that matters: the long-film flag is taken before
    runtime imputation, and votes are imputed before the blockbuster flag. Medians are per split
    when the frame carries a split column."""
    reg = HookRegistry()
    fitted: list[DataFrame] = []

    def drop_end_year(df: DataFrame) -> DataFrame:
        return drop_if_present(df, [cfg.end_year])

    def impute_votes_median(df: DataFrame) -> DataFrame:
        # neither column changes before both are imputed: one pass gives both medians
        fitted[:] = [stable(group_medians(df, [cfg.votes, cfg.runtime], by=_by(df, cfg)))]
        return impute_median(df, cfg.votes, by=_by(df, cfg), medians=fitted[0])

    def flag_long_film(df: DataFrame) -> DataFrame:
        return flag_threshold(df, cfg.runtime, "is_long_film", ">", cfg.long_min)

    def impute_runtime_median(df: DataFrame) -> DataFrame:
        medians = fitted.pop() if fitted else None
        return impute_median(df, cfg.runtime, by=_by(df, cfg), medians=medians)

    def flag_old_film(df: DataFrame) -> DataFrame:
        return flag_threshold(df, cfg.start_year, "is_old_film", "<", cfg.old_year)

    def flag_blockbuster(df: DataFrame) -> DataFrame:
        return flag_threshold(df, cfg.votes, "is_blockbuster", ">", cfg.blockbuster_votes)

    def flag_foreign_title(df: DataFrame) -> DataFrame:
        return flag_differs(df, cfg.title, cfg.original_title, "is_foreign_title")

    def add_title_features(df: DataFrame) -> DataFrame:
        df = add_word_count(df, cfg.title, "title_word_count")
        return flag_matches(df, cfg.title, "title_has_number")

    for fn in (drop_end_year, impute_votes_median, flag_long_film, impute_runtime_median,
               flag_old_film, flag_blockbuster, flag_foreign_title, add_title_features):
        reg.register(fn)
    return reg
