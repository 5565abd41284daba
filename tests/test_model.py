import random

import pytest


from featurepipe.operators.model import (
    ExactMedianImputer, ModelSettings, PopulationScaler, fit_preprocess, stratified_folds,
)
from featurepipe.plans.train import train_and_predict


def _sk_stratified(y, k):
    """From-memory transcription of scikit-learn's unshuffled StratifiedKFold test folds."""
    first = {}
    for i, v in enumerate(y):
        first.setdefault(v, i)
    classes = sorted(first, key=first.get)
    enc = [classes.index(v) for v in y]
    y_order = sorted(enc)
    alloc = [[y_order[i::k].count(c) for c in range(len(classes))] for i in range(k)]
    folds = [None] * len(y)
    for c in range(len(classes)):
        seq = [f for f in range(k) for _ in range(alloc[f][c])]
        idx = [i for i, e in enumerate(enc) if e == c]
        for i, f in zip(idx, seq):
            folds[i] = f
    return folds


def test_stratified_folds_match_reference_algorithm(spark):
    random.seed(11)
    for n, p in ((53, 0.3), (120, 0.5), (17, 0.8)):
        y = [int(random.random() < p) for _ in range(n)]
        df = spark.createDataFrame([(i * 3 + 1, v) for i, v in enumerate(y)], "pos long, label int")
        got = {r.pos: r.fold for r in stratified_folds(df, "label", ["pos"], 5).collect()}
        assert [got[i * 3 + 1] for i in range(n)] == _sk_stratified(y, 5)


def test_null_labels_fail_the_fold_assignment(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "pos long, label int")
    with pytest.raises(Exception, match="NULL in label"):
        stratified_folds(df, "label", ["pos"], 2).collect()


def test_imputer_and_population_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,), (11.0,)], "x double")
    m = ExactMedianImputer(inputCols=["x"]).fit(df)
    xs = [r.x for r in m.transform(df).collect()]
    assert xs == [1.0, 2.0, 6.0, 10.0, 11.0]
    pre = fit_preprocess(df, ["x"])
    z = [r.x for r in pre.transform(df).collect()]
    mu = sum(xs) / 5
    sd = (sum((v - mu) ** 2 for v in xs) / 5) ** 0.5
    assert all(abs(a - (v - mu) / sd) < 1e-12 for a, v in zip(z, xs))
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.x for r in PopulationScaler(inputCols=["x"]).fit(const).transform(const).collect()] == [0.0, 0.0]


def test_train_and_predict_small(spark):
    random.seed(5)
    rows = []
    for i in range(120):
        a = random.random()
        rows.append((i, int(a > 0.5), a if i % 7 else None, random.random()))
    df = spark.createDataFrame(rows, "_row_id long, label int, a double, b double")
    hidden = spark.createDataFrame([(i, random.random(), random.random()) for i in range(30)],
                                   "_row_id long, a double, b double")
    res = train_and_predict(df, {"val": hidden}, ["a", "b", "missing"], settings=ModelSettings.quick())
    scores = res.scores.collect()
    assert [s.model for s in scores][0] == "Logistic Regression" and len(scores) == 5
    assert all(0.0 <= s.cv_mean <= 1.0 and s.cv_std >= 0.0 for s in scores)
    best = max(scores, key=lambda s: (s.cv_mean, -s.ordinal))
    assert res.best == best.model
    assert res.predictions["val"].count() == 30
    assert [r.feature for r in res.importances.collect()] and res.features == ["a", "b"]
    assert res.report_lines()[0] == f"Best model: {res.best}"
