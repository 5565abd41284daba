"""Model operators (I1-I9): exact-median imputer and population-std scaler as pyspark.ml
Estimators (refitted on every fold's training rows), stratified fold assignment,
candidate registry, cross-validated accuracy, train accuracy, best pick, refit + predict and
ranked importances.

Fitted parameters (one median / mean / std per feature) are the only values brought to the
driver; every pass over rows runs as a Spark job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasInputCols, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters,
)
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurepipe.operators.boosting import HistogramBooster
from featurepipe.operators.ordering import dense_index
from featurepipe.operators.stats import exact_median, radix_select
from featurepipe.session import broadcast_if_small, materialized, release


# ---------------------------------------------------------------- I1 / I2: preprocessing -------
class _Fitted(Params):
    values = Param(Params._dummy(), "values", "fitted per-column values", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "fitted per-column scales", TypeConverters.toListFloat)


def _long_form(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value) rows, so one grouped job serves every column."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


class ExactMedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """NULL/NaN -> exact median of the training column (Spark's Imputer median is approximate)."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ExactMedianImputerModel":
        cols = self.getInputCols()
        med = {r["feature"]: r["median"]
               for r in exact_median(_long_form(dataset, cols), "value", ["feature"]).collect()}
        return ExactMedianImputerModel(inputCols=cols, values=[
            float(med[c]) if med.get(c) is not None else float("nan") for c in cols])


class ExactMedianImputerModel(Model, HasInputCols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, values: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = {}
        for c, m in zip(self.getInputCols(), self.getOrDefault(self.values)):
            x = F.col(c).cast("double")
            fill = F.lit(None).cast("double") if m != m else F.lit(m)
            out[c] = F.when(x.isNotNull() & ~F.isnan(x), x).otherwise(fill)
        return dataset.withColumns(out)


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std (std 0 -> 1); ``ml.feature.StandardScaler`` uses sample std."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        aggs = []
        for i, c in enumerate(cols):
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"),
                     F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}")]
        row = dataset.agg(*aggs).first()
        means = [float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
        stds = [float(row[f"s{i}"]) if row[f"s{i}"] not in (None, 0.0) else 1.0 for i in range(len(cols))]
        return PopulationScalerModel(inputCols=cols, values=means, scales=stds)


class PopulationScalerModel(Model, HasInputCols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, values: list[float] | None = None,
                 scales: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        mu, sd = self.getOrDefault(self.values), self.getOrDefault(self.scales)
        return dataset.withColumns({c: (F.col(c).cast("double") - m) / s for c, m, s in zip(cols, mu, sd)})


def preprocess_stages(cols: Sequence[str]) -> list:
    """I1 + I2 + vector assembly, the reference's impute -> scale front of every candidate."""
    cols = list(cols)
    return [ExactMedianImputer(inputCols=cols), PopulationScaler(inputCols=cols),
            VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")]


def fit_preprocess(train: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """I1/I2 fitted on a training frame; ``.transform`` applies it to any frame."""
    return Pipeline(stages=[ExactMedianImputer(inputCols=list(cols)),
                            PopulationScaler(inputCols=list(cols))]).fit(train)


# ---------------------------------------------------------------- I4: stratified folds ---------
def stratified_folds(df: DataFrame, label: str, order: Sequence[str], k: int = 5,
                     name: str = "fold") -> DataFrame:
    """Unshuffled stratified k-fold test-fold index, as scikit-learn assigns it.

    Classes are taken in order of first appearance; class c (n_c rows, starting at offset o_c in
    the class-sorted label vector) gives fold i floor(n_c/k) + [(i - o_c) mod k < n_c mod k] of
    its rows, in row order, as contiguous blocks. The per-class rank uses ``dense_index`` (no
    window over a whole class), the per-class table has one row per class. A NULL label fails the
    job, as rows cannot be stratified without one.
    """
    kind = df.schema[label].dataType
    df = df.withColumn(label, F.coalesce(F.col(label), F.raise_error(
        F.lit(f"stratified_folds: NULL in {label}")).cast(kind)))
    first = df.groupBy(label).agg(F.min(F.struct(*order)).alias("_first"),
                                  F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    cls = first.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sizes = [(F.floor(F.col("_n") / k) +
              F.when(F.pmod(F.lit(i) - F.col("_o"), F.lit(k)) < F.pmod(F.col("_n"), F.lit(k)), 1)
              .otherwise(0)) for i in range(k)]
    cum, bounds = None, []
    for s in sizes[:-1]:
        cum = s if cum is None else cum + s
        bounds.append(cum)
    cls = cls.select(label, *[b.alias(f"_b{i}") for i, b in enumerate(bounds)])
    ranked = dense_index(df, order, partition_by=[label], name="_r")
    out = ranked.join(broadcast_if_small(cls), label, "inner")   # one row per class; a class is a hot key
    fold = sum((F.col("_r") >= F.col(f"_b{i}")).cast("int") for i in range(len(bounds)))
    return out.withColumn(name, F.lit(0) + fold if bounds else F.lit(0)).drop(
        "_r", *[f"_b{i}" for i in range(len(bounds))]).select(*df.columns, name)


# ---------------------------------------------------------------- I3: candidates --------------
# Candidate sizes of the reference (defaults below) and candidate names.
@dataclass(frozen=True)
class ModelSettings:
    """Candidate sizes. Defaults are the reference's; ``quick()`` for tests and registered queries."""

    lr_iter: int = 1000
    lr_c: float = 1.0
    rf_trees: int = 200
    rf_depth: int = 30
    gbt_iter: int = 300
    gbt_depth: int = 5
    gbt_step: float = 0.05
    seed: int = 42
    folds: int = 5
    parallelism: int = 1

    @staticmethod
    def quick() -> "ModelSettings":
        return ModelSettings(lr_iter=15, rf_trees=8, rf_depth=4, gbt_iter=3, gbt_depth=2, gbt_step=0.3,
                             parallelism=4)


def candidates(n_train: int, s: ModelSettings = ModelSettings(), label: str = "label") -> dict:
    """Five candidates, in the reference's order. Logistic regression: sklearn's C-scaled L2 on the
    summed loss equals Spark's regParam = 1 / (C * n) on the mean loss. The two third-party boosters
    are second-order histogram boosters with those libraries' defaults: growth by level with penalty 1
    and child weight 1, and growth by leaf with 31 leaves of at least 20 rows."""
    common = dict(featuresCol="features", labelCol=label)
    boost = dict(trees=s.gbt_iter, depth=s.gbt_depth, rate=s.gbt_step, bins=256, **common)
    return {
        "Logistic Regression": LogisticRegression(maxIter=s.lr_iter, regParam=1.0 / (s.lr_c * max(n_train, 1)),
                                                  elasticNetParam=0.0, standardization=False, **common),
        "Random Forest": RandomForestClassifier(numTrees=s.rf_trees, maxDepth=s.rf_depth,
                                                featureSubsetStrategy="sqrt", seed=s.seed, **common),
        "Gradient Boosting": GBTClassifier(maxIter=s.gbt_iter, maxDepth=s.gbt_depth, stepSize=s.gbt_step,
                                           seed=s.seed, **common),
        "XGBoost": HistogramBooster(growth="level", l2=1.0, minHessian=1.0, **boost),
        "LightGBM": HistogramBooster(growth="leaf", leaves=31, l2=0.0, minHessian=1e-3, minRows=20, **boost),
    }


class NearestClassMean(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Closed-form classifier: the class whose mean vector is nearest (the smaller label of equals).

    One grouped pass gives the means; ``coefficients`` is the difference of the second and the
    first class's means, the normal of the border between two classes.
    """

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NearestClassMeanModel":
        label = self.getLabelCol()
        rows = dataset.groupBy(F.col(label).cast("double").alias("_l")).agg(Summarizer.mean(F.col(self.getFeaturesCol())).alias("_m")).collect()
        rows = sorted((r["_l"], [float(v) for v in r["_m"]]) for r in rows if r["_l"] is not None)
        return NearestClassMeanModel(featuresCol=self.getFeaturesCol(), labels=[r[0] for r in rows], means=[r[1] for r in rows])

    def of_statistics(self, fit: FoldFit) -> "NearestClassMeanModel":
        return NearestClassMeanModel(featuresCol=self.getFeaturesCol(), labels=fit.labels, means=fit.means)


class NearestClassMeanModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    labels = Param(Params._dummy(), "labels", "class labels", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean vector of each class", TypeConverters.toListListFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labels: list[float] | None = None, means: list[list[float]] | None = None):
        super().__init__()
        self._setDefault(predictionCol="prediction")
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> DenseVector:
        means = self.getOrDefault(self.means)
        if len(means) < 2:
            return DenseVector([0.0] * len(means[0] if means else []))
        return DenseVector([b - a for a, b in zip(means[0], means[1])])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        away = [F.aggregate(F.zip_with(x, F.array(*map(F.lit, m)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
                for m in self.getOrDefault(self.means)]
        best = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(label).alias("l")) for d, label in zip(away, self.getOrDefault(self.labels))]))
        return dataset.withColumn(self.getPredictionCol(), best["l"])


class MajorityClass(Estimator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Baseline: the commonest label (the smaller of equals) for every row; no coefficients."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MajorityClassModel":
        label = F.col(self.getLabelCol()).cast("double")
        row = dataset.groupBy(label.alias("_l")).count().orderBy(F.col("count").desc(), "_l").first()
        return MajorityClassModel(value=row["_l"])

    def of_statistics(self, fit: FoldFit) -> "MajorityClassModel":
        return MajorityClassModel(value=min(zip([-n for n in fit.counts], fit.labels))[1] if fit.labels else None)


class MajorityClassModel(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    value = Param(Params._dummy(), "value", "the label given", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, value: float | None = None):
        super().__init__()
        self._setDefault(predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault(self.value)))


def closed_form_candidates(label: str = "label") -> dict:
    """Candidates whose fits are sums over the rows, so that any engine can check them."""
    return {"Majority class": MajorityClass(labelCol=label), "Nearest class mean": NearestClassMean(labelCol=label)}


def pipeline_for(model, features: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[*preprocess_stages(features), model])


# ---------------------------------------------------------------- I5: leave one fold out -------
@dataclass
class FoldFit:
    """What the rows of all folds but one (the last fit: of all folds) say: preprocessing and class figures."""

    pre: PipelineModel
    rows: int
    labels: list[float]
    counts: list[int]
    means: list[list[float]]           # of the prepared features, by label


def fold_histograms(train: DataFrame, features: Sequence[str], label: str, fold_col: str, folds: int) -> tuple[DataFrame, str]:
    """``(f, y, v, w)``: rows by feature, label and value (null for a missing one), counted for each fit, and
    the folder that holds the table.

    ``w`` has a number for every fold, the rows of all *other* folds, and one for all rows. It is one
    pass over the rows and everything that a fit needs: tables of shards add up, and each "all but
    fold i" is a subtraction.
    """
    cells = [F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)]
    long = train.select(F.col(label).cast("double").alias("y"), F.col(fold_col).alias("_k"), F.explode(F.array(*cells)).alias("c"))
    value = F.when(~F.isnan("c.v"), F.col("c.v"))
    table = (long.select("y", "_k", "c.f", value.alias("v")).groupBy("f", "y", "v")
             .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_k") == i).alias(f"n{i}") for i in range(folds)]))
    weights = F.array(*[F.col("n") - F.col(f"n{i}") for i in range(folds)], F.col("n"))
    return materialized(table.select("f", "y", "v", weights.alias("w")), "fold-values")


def leave_one_out(train: DataFrame, features: Sequence[str], label: str, fold_col: str, folds: int, cap: int = 500_000) -> list[FoldFit]:
    """Fits for every "all folds but i" and, last, for all rows, from one pass over ``train``.

    Medians, means, deviations and class means come from the value histograms; only (features x
    fits) and (features x fits x labels) numbers come to the driver. Features of more than ``cap``
    different values have their medians selected by radix.
    """
    features, fits = list(features), folds + 1
    table, folder = fold_histograms(train, features, label, fold_col, folds)
    known = table.where("v IS NOT NULL")
    most = known.groupBy("f").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    med = [[float("nan")] * len(features) for _ in range(fits)]
    if most <= cap:
        row = known.groupBy("f").agg(*[F.percentile("v", F.lit(0.5), F.col("w")[i]).alias(f"m{i}") for i in range(fits)])
        for r in row.collect():
            for i in range(fits):
                med[i][r["f"]] = float("nan") if r[f"m{i}"] is None else r[f"m{i}"]
    else:
        sizes = known.groupBy("f").agg(F.array(*[F.sum(F.col("w")[i]) for i in range(fits)]).alias("n")).select("f", F.posexplode("n").alias("fit", "n"))
        ranks = sizes.where("n > 0").select("f", "fit", F.explode(F.array_distinct(F.array(
            ((F.col("n") - 1) / 2).cast("long"), (F.col("n") / 2).cast("long")))).alias("rank"))
        for r in radix_select(known, ranks, ["f"], "v", "w").groupBy("f", "fit").agg(((F.min("value") + F.max("value")) / 2).alias("m")).collect():
            med[r["fit"]][r["f"]] = r["m"]
    # sums of imputed values, then of squares around their means: both over the small table
    filled = F.expr("array(" + ",".join("array(" + ",".join(f"double('{x!r}')" for x in m) + ")" for m in med) + ")")
    cells = table.select("f", "y", "v", F.posexplode("w").alias("fit", "n")).where("n > 0")
    cells = cells.withColumn("x", F.coalesce("v", F.get(F.get(filled, F.col("fit")), F.col("f"))))
    sums = [[{} for _ in features] for _ in range(fits)]
    for r in cells.groupBy("f", "fit", "y").agg(F.sum("n").alias("n"), F.sum(F.col("x") * F.col("n")).alias("s")).collect():
        sums[r["fit"]][r["f"]][r["y"]] = (r["n"], r["s"])
    mean = [[sum(s for _, s in by.values()) / max(1, sum(n for n, _ in by.values())) for by in fit] for fit in sums]
    middle = F.expr("array(" + ",".join("array(" + ",".join(f"double('{x!r}')" for x in m) + ")" for m in mean) + ")")
    off = F.col("x") - F.get(F.get(middle, F.col("fit")), F.col("f"))
    spread = [[1.0] * len(features) for _ in range(fits)]
    for r in cells.groupBy("f", "fit").agg(F.sum("n").alias("n"), F.sum(off * off * F.col("n")).alias("s")).collect():
        sd = (r["s"] / r["n"]) ** 0.5 if r["s"] is not None else 0.0
        spread[r["fit"]][r["f"]] = sd if sd and sd == sd else 1.0
    release(train.sparkSession, folder)
    out = []
    for i in range(fits):
        pre = PipelineModel(stages=[ExactMedianImputerModel(inputCols=features, values=med[i]),
                                    PopulationScalerModel(inputCols=features, values=mean[i], scales=spread[i]),
                                    VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")])
        labels = sorted(y for y in (sums[i][0] if features else {}) if y is not None)
        out.append(FoldFit(pre, sum(n for n, _ in sums[i][0].values()) if features else 0, labels, [sums[i][0][y][0] for y in labels],
                           [[(sums[i][f][y][1] / sums[i][f][y][0] - mean[i][f]) / spread[i][f] for f in range(len(features))] for y in labels]))
    return out


# ---------------------------------------------------------------- I5-I9 ------------------------
def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """Share of rows whose prediction equals the label."""
    row = pred.agg(F.avg((F.col(prediction) == F.col(label).cast("double")).cast("double")).alias("a")).first()
    return float(row["a"]) if row["a"] is not None else float("nan")


def cross_validate(train: DataFrame, cands: Callable[[int], Mapping[str, object]] | Mapping[str, object], features: Sequence[str],
                   label: str = "label", fold_col: str = "fold", s: ModelSettings = ModelSettings(),
                   ) -> DataFrame:
    """I5 + I6: per candidate train accuracy, mean and population std of fold accuracy.

    Same protocol as ``CrossValidator(foldCol=...)`` with the preprocessing inside the pipeline:
    imputer and scaler are those of every fold's training rows, and so are closed-form candidates
    (those with ``of_statistics``); all of them come from one pass (``leave_one_out``) and are judged
    in one more. Any other candidate trains on each fold's assembled vectors, cached once
    (``parallelism`` candidates at a time).
    ``cands`` may be a function of the number of rows a fit sees (``candidates``): the L2 strength
    depends on it, and a fold trains on fewer rows than the whole.
    """
    spark = train.sparkSession
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy", labelCol=label)
    make = cands if callable(cands) else lambda _n: cands
    names = list(make(1))
    fits = leave_one_out(train, features, label, fold_col, s.folds)
    closed = [n for n, est in make(1).items() if hasattr(est, "of_statistics")]
    scored: dict[str, list[float]] = {}
    if closed:
        parts = []
        for i, fit in enumerate(fits):
            part = fit.pre.transform(train.where(F.col(fold_col) == i) if i < s.folds else train)
            for j, name in enumerate(closed):
                model = make(fit.rows)[name].of_statistics(fit)
                part = model.copy({model.predictionCol: f"_fp_p{j}"}).transform(part)
            parts.append(part.select(F.lit(i).alias("fit"), *[(F.col(f"_fp_p{j}") == F.col(label).cast("double")).cast("double").alias(f"_fp_p{j}")
                                                              for j in range(len(closed))]))
        got = {r["fit"]: r for r in reduce(DataFrame.unionAll, parts).groupBy("fit").agg(
            *[F.avg(f"_fp_p{j}").alias(f"a{j}") for j in range(len(closed))]).collect()}
        for j, name in enumerate(closed):
            scored[name] = [float(got[i][f"a{j}"]) if i in got else float("nan") for i in range(len(fits))]
    others = [n for n in names if n not in closed]

    def score_others(i: int) -> None:
        fit_rows = train.where(F.col(fold_col) != i) if i < s.folds else train
        fx = fits[i].pre.transform(fit_rows).select(label, "features").cache()
        ex = fits[i].pre.transform(train.where(F.col(fold_col) == i)).select(label, "features").cache() if i < s.folds else fx
        models = make(fits[i].rows)

        def one(name: str) -> float:
            return float(evaluator.evaluate(models[name].fit(fx).transform(ex)))

        with ThreadPoolExecutor(max_workers=max(1, s.parallelism)) as pool:
            for name, a in zip(others, pool.map(one, others)):
                scored.setdefault(name, []).append(a)
        fx.unpersist()
        if ex is not fx:
            ex.unpersist()

    if others:
        for i in range(len(fits)):
            score_others(i)
    per_fold = [[scored[n][i] for n in names] for i in range(s.folds)]
    train_acc = [scored[n][s.folds] for n in names]
    rows = []
    for j, name in enumerate(names):
        accs = [f[j] for f in per_fold]
        mean = sum(accs) / len(accs)
        std = (sum((a - mean) ** 2 for a in accs) / len(accs)) ** 0.5
        rows.append((name, j, train_acc[j], mean, std))
    return spark.createDataFrame(rows, "model string, ordinal int, train_acc double, cv_mean double, "
                                       "cv_std double")


def pick_best(scores: DataFrame) -> str:
    """Highest mean CV accuracy, the earlier candidate wins ties."""
    return scores.orderBy(F.col("cv_mean").desc(), F.col("ordinal").asc()).first()["model"]


def importances(fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Tree importances, or absolute coefficients, ranked (one row per feature)."""
    model = fitted.stages[-1]
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    elif hasattr(model, "coefficients"):
        vals = [abs(v) for v in model.coefficients.toArray().tolist()]
    else:
        vals = [0.0] * len(features)
    spark = SparkSession.getActiveSession()
    rows = sorted(zip(features, vals), key=lambda fv: -fv[1])
    return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def fit_predict(train: DataFrame, frames: Mapping[str, DataFrame], model, features: Sequence[str],
                ) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """I8: refit the pipeline on all of train and predict each frame (adds ``prediction``)."""
    fitted = pipeline_for(model, features).fit(train)
    return fitted, {name: fitted.transform(df) for name, df in frames.items()}
