"""Train and predict. Candidates -> train accuracy -> stratified 5-fold CV -> best ->
refit on all of train -> predictions for the hidden splits -> importances and report lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.operators.features import select_features
from featurepipe.operators.model import (
    ModelSettings, candidates, cross_validate, fit_predict, importances, pick_best, stratified_folds,
)


@dataclass
class TrainResult:
    scores: DataFrame            # model, ordinal, train_acc, cv_mean, cv_std
    best: str
    model: PipelineModel
    predictions: dict[str, DataFrame]
    importances: DataFrame       # feature, importance, rank
    features: list[str]

    def report_lines(self) -> list[str]:
        """A10: best name, its train accuracy, ranked importances (a handful of lines)."""
        # The wording and layout of the lines.
        row = self.scores.where(F.col("model") == self.best).first()
        lines = [f"Best model: {self.best}", f"Train accuracy: {row['train_acc']:.4f}", "",
                 "Feature importances:"]
        for r in self.importances.orderBy("rank").collect():
            lines.append(f"  {r['feature']:<25} {r['importance']:.4f}")
        return lines


def train_and_predict(train: DataFrame, hidden: Mapping[str, DataFrame], features: Sequence[str],
                      label: str = "label", order: Sequence[str] = ("_row_id",),
                      settings: ModelSettings = ModelSettings(), make=None) -> TrainResult:
    """``train`` has the label; ``hidden`` frames are predicted by the best candidate.

    ``make`` gives the candidates for a number of training rows (default: ``candidates``).
    """
    make = make or (lambda rows: candidates(rows, settings, label))
    feats = [c for c in features if c in train.columns]                 # B19
    keep = [c for c in order if c in train.columns]
    base = select_features(train, [*keep, *feats], label=label)
    folded = stratified_folds(base, label, keep, settings.folds).persist()
    n = folded.count()
    scores = cross_validate(folded, make, feats, label, "fold", settings)
    best = pick_best(scores)
    model, preds = fit_predict(folded, hidden, make(n)[best], feats)
    folded.unpersist()
    return TrainResult(scores, best, model, preds, importances(model, feats), feats)


def read_processed(spark, processed_dir: str, cfg, fmt: str = "csv") -> dict[str, DataFrame]:
    """The processed splits; CSV with the gold types, so nothing is inferred."""
    from featurepipe.plans.build import HIDDEN, SPLITS
    from featurepipe.plans.gold import gold_types
    from featurepipe.sources.published import stage_path
    from featurepipe.sources.stages import read_stage
    folder = stage_path(spark, processed_dir)
    return {s: read_stage(spark, f"{folder}/{cfg.split}={s}", fmt,
                          gold_types(cfg, label=s not in HIDDEN) if fmt == "csv" else None) for s in SPLITS}


def run_train(spark, processed_dir: str, out_dir: str, cfg=None, settings: ModelSettings = ModelSettings(),
              fmt: str = "csv") -> TrainResult:
    """J6 end to end from the processed stage: predictions for val and test (True/False lines in
    row order, as part files and as one file each) and the model report."""
    from featurepipe.config import DEFAULT
    from featurepipe.sources.sinks import model_report, write_predictions, write_report
    cfg = cfg or DEFAULT
    parts = read_processed(spark, processed_dir, cfg, fmt)
    res = train_and_predict(parts["train"], {"val": parts["val"], "test": parts["test"]}, cfg.features,
                            cfg.label, [cfg.row_id], settings)
    for split, pred in res.predictions.items():
        write_predictions(pred, cfg.row_id, f"{out_dir}/predictions_{split}", single_file=f"{out_dir}/predictions_{split}.txt")
    write_report(model_report(spark, res.report_lines()), f"{out_dir}/model_report")
    return res
