import heapq
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from featurepipe.operators.boosting import UNIT, GrowthRules, HistogramBooster, HistogramBoosterModel

RULES = {"level": GrowthRules("level", depth=3, l2=1.0, min_hessian=0.5, min_rows=1),
         "leaf": GrowthRules("leaf", depth=6, leaves=7, l2=0.0, min_hessian=1e-3, min_rows=5)}


def data(n=400, seed=3, missing=0.15):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.randrange(12) * 1.0, rng.gauss(0, 1), float(rng.random() < 0.3)]
        p = 1 / (1 + math.exp(-(0.4 * (x[0] - 6) + (1.5 if x[1] > 0.3 else -1) + 2 * x[2] * (x[0] > 4))))
        y = int(rng.random() < p)
        rows.append((y, [math.nan if rng.random() < missing else v for v in x]))
    return rows


def brute(rows, rules, trees, rate):
    """Boosting row by row: every cut between two values, both ways for missing values."""
    y = np.array([r[0] for r in rows], float)
    x = np.array([r[1] for r in rows], float)
    score = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    cuts = [[a + (b - a) / 2 for a, b in zip(v, v[1:])] for v in (sorted(set(c[~np.isnan(c)])) for c in x.T)]

    def value(g, h):
        return -g / (h + rules.l2) if h + rules.l2 > 0 else 0.0

    def worth(g, h):
        return g * g / (h + rules.l2) if h + rules.l2 > 0 else 0.0

    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = np.round((p - y) * UNIT) / UNIT, np.round(p * (1 - p) * UNIT) / UNIT

        def best(mine):
            found = None
            for f, c in enumerate(cuts):
                v = x[mine, f]
                for cut in [*c, math.inf]:
                    for missing_left in (False, True):
                        left = np.where(np.isnan(v), missing_left, v <= cut)
                        a, b = mine[left], mine[~left]
                        if min(len(a), len(b)) < rules.min_rows or min(h[a].sum(), h[b].sum()) < rules.min_hessian:
                            continue
                        gain = 0.5 * (worth(g[a].sum(), h[a].sum()) + worth(g[b].sum(), h[b].sum()) - worth(g[mine].sum(), h[mine].sum()))
                        if gain > rules.min_gain and (found is None or gain > found[0] + 1e-9):
                            found = (gain, f, cut, missing_left, a, b)
            return found

        leaves, splits, step = [], [], 0
        queue = [(0.0, 0, 0, np.arange(len(y)), best(np.arange(len(y))))]
        n_leaves = 1
        while queue:
            _, _, depth, mine, s = heapq.heappop(queue)
            if s is None or depth == rules.depth or (rules.growth == "leaf" and n_leaves == rules.leaves):
                leaves.append(mine)
                continue
            splits.append((s[1], round(s[2], 9), s[3], round(s[0], 6), len(mine)))
            n_leaves += 1
            for part in s[4:]:
                step += 1
                b = best(part)
                queue_key = depth + 1 if rules.growth == "level" else -(b[0] if b and depth + 1 < rules.depth else 0.0)
                heapq.heappush(queue, (queue_key, step, depth + 1, part, b))
        out.append(sorted(splits))
        for mine in leaves:
            score[mine] += rate * value(g[mine].sum(), h[mine].sum())
    return out, score


@pytest.mark.parametrize("growth", ["level", "leaf"])
def test_trees_equal_brute_force(spark, growth):
    rows, rules = data(), RULES[growth]
    df = spark.createDataFrame([(i, y, x) for i, (y, x) in enumerate(rows)], "i int, label int, features array<double>").repartition(3)
    model = HistogramBooster(growth=growth, trees=3, rate=0.3, depth=rules.depth, leaves=rules.leaves, bins=512, l2=rules.l2,
                             minHessian=rules.min_hessian, minRows=rules.min_rows).fit(df)
    want, score = brute(rows, rules, 3, 0.3)
    nodes = model.getOrDefault(model.nodes)
    got = [sorted((int(n[1]), round(n[2], 9), bool(n[3]), round(n[7], 6)) for n in nodes if n[0] == t and n[4] >= 0) for t in range(3)]
    assert got == [[s[:4] for s in t] for t in want]
    margins = dict(df.select("i", model.margin(F.col("features"), False).alias("m")).collect())
    assert max(abs(margins[i] - s) for i, s in enumerate(score)) < 1e-6
    pred = dict(model.transform(df).select("i", "prediction").collect())
    assert all(pred[i] == float(s > 0) for i, s in enumerate(score) if abs(s) > 1e-6)
    assert abs(sum(model.featureImportances) - 1) < 1e-9 and len(model.featureImportances) == 3


def test_leaf_growth_takes_the_greatest_gain(spark):
    """With few leaves the two ways of growth differ: one goes where it gains most."""
    rows = data(600, 9, 0.0)
    df = spark.createDataFrame([(y, x) for y, x in rows], "label int, features array<double>")
    model = HistogramBooster(growth="leaf", trees=1, depth=9, leaves=4, bins=1024, l2=0.0, minHessian=1e-3, minRows=20).fit(df)
    want, _ = brute(rows, GrowthRules("leaf", 9, 4, 0.0, 1e-3, 20), 1, 0.05)
    got = sorted((int(n[1]), round(n[2], 9), bool(n[3]), round(n[7], 6)) for n in model.getOrDefault(model.nodes) if n[4] >= 0)
    assert got == [s[:4] for s in want[0]] and len(got) == 3


def test_vectors_round_trip_and_odd_labels(spark, tmp_dir):
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([i % 2 + 0.0, 1.0])) for i in range(50)] + [(None, Vectors.dense([0.0, 0.0]))],
                               ["label", "features"])
    model = HistogramBooster(trees=2, minHessian=0.1).fit(df)
    assert [r.prediction for r in model.transform(df.where("label IS NOT NULL")).select("label", "prediction").collect()] == [float(i % 2) for i in range(50)]
    model.write().overwrite().save(f"{tmp_dir}/model")
    again = HistogramBoosterModel.load(f"{tmp_dir}/model")
    assert again.transform(df).collect() == model.transform(df).collect()
    one = HistogramBooster(trees=2).fit(df.where("label = 1"))
    assert one.getOrDefault(one.nodes) == [] and one.transform(df).count() == 51
    with pytest.raises(ValueError, match="growth"):
        HistogramBooster(growth="sideways")


def test_many_trees_go_through_written_copies(spark):
    from featurepipe.session import intermediates
    rows = data(120, 5, 0.1)
    df = spark.createDataFrame([(y, x) for y, x in rows], "label int, features array<double>")
    mark = intermediates(spark)
    model = HistogramBooster(trees=17, depth=2, bins=16, rate=0.5).fit(df)
    assert intermediates(spark) == mark
    acc = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.85 and max(n[0] for n in model.getOrDefault(model.nodes)) == 16
