"""Second-order gradient boosting of binary classifiers on binned features.

Every tree is grown on histograms: sums of gradients and hessians of the logistic loss by (node,
feature, bin), found by one partially aggregated job per pass over the rows; only these sums, bounded
by nodes x features x bins, come to the driver. Gradients are whole numbers in units of 2**-30, so
sums do not depend on the order of rows, a recomputed task changes nothing, and a child's histogram
is exactly its parent's without its sibling's: only the smaller child of a split is counted.

Two ways of growth: ``level`` splits all nodes of a level at once; ``leaf`` takes the leaf with the
greatest gain first, up to a number of leaves (a pass counts the children of all leaves that may come
next). Missing values (NaN or null) have a bin of their own and go to the side that gains more.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.session import materialized, release

UNIT = 1 << 30                     # whole-number units of gradients and hessians
_CUT_EVERY = 16                    # trees between two written copies of the scored rows


def bin_edges(rows: DataFrame, x: str, n_features: int, bins: int) -> list[list[float]]:
    """Cuts of every feature (a value is left of a cut if it is not above it): half-way between
    neighbouring values where there are at most ``bins`` of them, else about ``bins`` quantiles."""
    cells = rows.select(F.posexplode(x).alias("f", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    kinds = {r["f"]: r["n"] for r in cells.groupBy("f").agg(F.approx_count_distinct("v", 0.02).alias("n")).collect()}
    few = [f for f, n in kinds.items() if n <= bins]
    values: dict[int, list[float]] = {}
    if few:                                                   # about ``bins`` values a feature
        for r in cells.where(F.col("f").isin(few)).distinct().collect():
            values.setdefault(r["f"], []).append(r["v"])
    edges = [[] for _ in range(n_features)]
    for f, vs in values.items():
        vs.sort()
        edges[f] = [a + (b - a) / 2 for a, b in zip(vs, vs[1:], strict=False)]
    many = [f for f in kinds if f not in few]
    if many:
        shares = [i / bins for i in range(1, bins)]
        for r in cells.where(F.col("f").isin(many)).groupBy("f").agg(F.percentile_approx("v", shares, 50 * bins).alias("q")).collect():
            edges[r["f"]] = sorted(set(r["q"]))
    return edges


def _binned(x: Column, edges: list[list[float]]) -> Column:
    """array<int> of bin numbers; -1 for a missing value."""
    @F.pandas_udf("array<int>")
    def place(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np
        import pandas as pd
        cuts = [np.array(e) for e in edges]
        for part in values:
            table = np.array([np.asarray(v, float) for v in part], float).reshape(len(part), len(cuts))
            out = np.empty(table.shape, np.int32)
            for f, c in enumerate(cuts):
                out[:, f] = np.where(np.isnan(table[:, f]), -1, np.searchsorted(c, table[:, f], side="left"))
            yield pd.Series(list(out))
    return place(x)


@dataclass
class Tree:
    """Nodes by number; ``left`` is -1 at leaves. Rows whose bin is at most ``cut`` go left; missing ones by ``missing_left``."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    sums: list[tuple[int, int, int]] = field(default_factory=list)      # gradient, hessian, rows
    depth: list[int] = field(default_factory=list)

    def add(self, sums: tuple[int, int, int], depth: int) -> int:
        for values, v in ((self.feature, -1), (self.cut, -1), (self.missing_left, False), (self.left, -1), (self.right, -1),
                          (self.gain, 0.0), (self.sums, sums), (self.depth, depth)):
            values.append(v)
        return len(self.left) - 1


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool
    left: tuple[int, int, int]
    right: tuple[int, int, int]


@dataclass(frozen=True)
class GrowthRules:
    """Limits of a tree; ``growth`` is level or leaf."""
    growth: str = "level"
    depth: int = 5
    leaves: int = 31
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    min_gain: float = 0.0

    def score(self, g, h):
        """Twice the loss that a leaf with these sums saves."""
        g, h = g / UNIT, h / UNIT
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + self.l2 > 0, g * g / (h + self.l2), 0.0)

    def value(self, sums: tuple[int, int, int]) -> float:
        g, h = sums[0] / UNIT, sums[1] / UNIT
        return -g / (h + self.l2) if h + self.l2 > 0 else 0.0

    def best(self, hist: np.ndarray) -> Split | None:
        """The split of greatest gain of a node's histogram ``[feature, bin, (gradient, hessian, rows)]``
        with missing rows in the last bin; of equals the first feature, the lowest cut, missing to the right."""
        total = hist[0].sum(0)
        upto = np.cumsum(hist[:, :-1], 1)[:, :-1]                       # a cut after each bin but the last
        found = None
        sides = np.stack((upto, upto + hist[:, -1:, :]), 2)             # missing rows right, then left
        other = total - sides
        gain = 0.5 * (self.score(sides[..., 0], sides[..., 1]) + self.score(other[..., 0], other[..., 1]) - self.score(total[0], total[1]))
        fits = ((np.minimum(sides[..., 1], other[..., 1]) >= self.min_hessian * UNIT)
                & (np.minimum(sides[..., 2], other[..., 2]) >= max(1, self.min_rows)))
        gain = np.where(fits, gain, -np.inf)
        if gain.size and (at := int(np.argmax(gain))) >= 0 and gain.flat[at] > self.min_gain:
            f, cut, way = np.unravel_index(at, gain.shape)
            found = Split(float(gain.flat[at]), int(f), int(cut), bool(way), tuple(map(int, sides[f, cut, way])), tuple(map(int, other[f, cut, way])))
        return found


def node_of(rows: DataFrame, tree: Tree, bins: str = "bins", name: str = "node") -> DataFrame:
    """``rows`` with the number of the leaf of ``tree`` that each falls into."""
    def listed(values: Sequence) -> str:
        return "array(" + ",".join(str(v).lower() for v in values) + ")"

    out = rows.withColumn(name, F.lit(0))
    for _ in range(max([d for d, left in zip(tree.depth, tree.left, strict=True) if left >= 0], default=-1) + 1):
        out = out.withColumn("_fp_bin", F.expr(f"get({bins}, get({listed(tree.feature)}, {name}))"))
        out = out.withColumn(name, F.expr(
            f"CASE WHEN get({listed(tree.left)}, {name}) < 0 THEN {name} "
            f"WHEN CASE WHEN _fp_bin < 0 THEN get({listed(tree.missing_left)}, {name}) ELSE _fp_bin <= get({listed(tree.cut)}, {name}) END "
            f"THEN get({listed(tree.left)}, {name}) ELSE get({listed(tree.right)}, {name}) END"))
    return out.drop("_fp_bin")


def histograms(rows: DataFrame, tree: Tree, nodes: Sequence[int], shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """Histograms of the leaves ``nodes`` of ``tree``: one job, partially aggregated by (node, feature, bin).

    ``rows`` holds bins, and gradient and hessian in whole units as g and h.
    """
    placed = node_of(rows, tree).where(F.col("node").isin(list(nodes)))
    sums = (placed.select("node", "g", "h", F.posexplode("bins").alias("f", "b")).groupBy("node", "f", "b")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")))
    out = {k: np.zeros((*shape, 3), np.int64) for k in nodes}
    for r in sums.collect():                                  # bounded by nodes x features x bins
        out[r["node"]][r["f"], r["b"]] = r["g"], r["h"], r["n"]   # bin -1 is the last one
    return out


def grow(rows: DataFrame, rules: GrowthRules, shape: tuple[int, int]) -> Tree:
    """One tree for rows with bins, g and h. ``shape`` is (features, bins with that of missing values)."""
    tree = Tree()
    root = histograms(rows, _leaf_only(), [0], shape)[0]
    tree.add(tuple(map(int, root[0].sum(0))), 0)
    hist, split = {0: root}, {0: rules.best(root)}

    def may_split(k: int) -> bool:
        return split.get(k) is not None and tree.depth[k] < rules.depth

    def count_children(parents: list[int]) -> None:
        """Children of the ``parents`` with their histograms and best splits; the smaller child is counted."""
        small = {}
        for k in parents:
            s = split[k]
            tree.feature[k], tree.cut[k], tree.missing_left[k], tree.gain[k] = s.feature, s.cut, s.missing_left, s.gain
            tree.left[k], tree.right[k] = tree.add(s.left, tree.depth[k] + 1), tree.add(s.right, tree.depth[k] + 1)
            small[k] = tree.left[k] if s.left[2] <= s.right[2] else tree.right[k]
        deep = [k for k in parents if tree.depth[k] + 1 < rules.depth]
        counted = histograms(rows, tree, [small[k] for k in deep], shape) if deep else {}
        for k in deep:
            rest = tree.left[k] + tree.right[k] - small[k]
            hist[small[k]], hist[rest] = counted[small[k]], hist[k] - counted[small[k]]
            for c in (tree.left[k], tree.right[k]):
                split[c] = rules.best(hist[c])
        for k in parents:
            del hist[k]

    if rules.growth == "level":
        level = [0]
        while level := [k for k in level if may_split(k)]:
            count_children(level)
            level = [c for k in level for c in (tree.left[k], tree.right[k])]
        return tree

    leaves, taken = 1, set()
    queue = [(-split[0].gain, 0)] if may_split(0) else []
    while queue and leaves < rules.leaves:
        if tree.left[queue[0][1]] < 0:                        # all that may come next are counted in one pass
            count_children([k for _, k in heapq.nsmallest(rules.leaves - leaves, queue) if tree.left[k] < 0])
        _, k = heapq.heappop(queue)
        taken.add(k)
        leaves += 1
        for c in (tree.left[k], tree.right[k]):
            if may_split(c):
                heapq.heappush(queue, (-split[c].gain, c))
    for k in range(len(tree.left)):                           # counted ahead and not taken
        if k not in taken:
            tree.left[k] = tree.right[k] = -1
    return tree


def _leaf_only() -> Tree:
    tree = Tree()
    tree.add((0, 0, 0), 0)
    return tree


def with_gradients(rows: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """``rows`` with gradient and hessian of the logistic loss in whole units."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(score)))
    return rows.withColumn("_fp_p", p).withColumns({
        "g": F.round((F.col("_fp_p") - F.col(label)) * UNIT).cast("long"),
        "h": F.round(F.col("_fp_p") * (1 - F.col("_fp_p")) * UNIT).cast("long")}).drop("_fp_p")


def _threshold(edges: list[list[float]], feature: int, cut: int) -> float:
    """Value up to which rows go left; a cut behind the last bin parts present values from missing ones."""
    own = edges[feature]
    return own[cut] if cut < len(own) else float("inf")


class _Boosting(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    growth = Param(Params._dummy(), "growth", "level or leaf", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a tree's values that is added", TypeConverters.toFloat)
    depth = Param(Params._dummy(), "depth", "splits from the root to a leaf, at most", TypeConverters.toInt)
    leaves = Param(Params._dummy(), "leaves", "leaves of a tree, at most (leaf growth)", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "bins of a feature", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "penalty on squared leaf values", TypeConverters.toFloat)
    minHessian = Param(Params._dummy(), "minHessian", "least sum of hessians of a child", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "least rows of a child", TypeConverters.toInt)
    minGain = Param(Params._dummy(), "minGain", "gain that a split must exceed", TypeConverters.toFloat)


class HistogramBooster(Estimator, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees for labels 0 and 1; see the module's text. ``features`` may be a vector or an array.

    Rows without a label are left out. The first score is the log odds of the labels; labels of one
    kind only, or no row, give a model without trees.
    """

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", growth: str = "level", trees: int = 300,
                 rate: float = 0.05, depth: int = 5, leaves: int = 31, bins: int = 256, l2: float = 1.0, minHessian: float = 1.0,
                 minRows: int = 1, minGain: float = 0.0):
        super().__init__()
        self._setDefault(predictionCol="prediction")
        self._set(**self._input_kwargs)
        for name, default in (("featuresCol", featuresCol), ("labelCol", labelCol), ("growth", growth), ("trees", trees), ("rate", rate),
                              ("depth", depth), ("leaves", leaves), ("bins", bins), ("l2", l2), ("minHessian", minHessian),
                              ("minRows", minRows), ("minGain", minGain)):
            self._setDefault(**{name: default})
        if growth not in ("level", "leaf"):
            raise ValueError(f"growth must be level or leaf, not {growth!r}")

    @property
    def rules(self) -> GrowthRules:
        get = self.getOrDefault
        return GrowthRules(get(self.growth), get(self.depth), get(self.leaves), get(self.l2), get(self.minHessian), get(self.minRows), get(self.minGain))

    def _fit(self, dataset: DataFrame) -> HistogramBoosterModel:
        spark, get = dataset.sparkSession, self.getOrDefault
        rows, edges, base = self.prepared(dataset)
        rules, shape = self.rules, (len(edges), max([len(e) for e in edges], default=0) + 2)
        grown: list[Tree] = []
        copy = None
        if base is not None and edges:
            rows = rows.withColumn("score", F.lit(base)).persist(StorageLevel.MEMORY_AND_DISK)
            for k in range(get(self.trees)):
                tree = grow(with_gradients(rows), rules, shape)
                if tree.left[0] < 0:
                    break                                     # nothing gains any more
                grown.append(tree)
                values = ",".join(repr(get(self.rate) * rules.value(s)) + "D" for s in tree.sums)
                after = node_of(rows, tree).withColumn("score", F.col("score") + F.expr(f"get(array({values}), node)")).drop("node")
                if (k + 1) % _CUT_EVERY == 0:                 # lineage ends in a written copy
                    last, (after, copy) = copy, materialized(after, "boosted-rows")
                    if last:
                        release(spark, last)
                after = after.persist(StorageLevel.MEMORY_AND_DISK)
                after.count()
                rows.unpersist()
                rows = after
        rows.unpersist()
        if copy:
            release(spark, copy)
        return HistogramBoosterModel.of(grown, edges, base or 0.0, get(self.rate), rules, self.getFeaturesCol(), self.getPredictionCol())

    def prepared(self, dataset: DataFrame) -> tuple[DataFrame, list[list[float]], float | None]:
        """Rows (y, bins), the cuts of all features, and the first score (None where no tree can grow)."""
        col = self.getFeaturesCol()
        x = vector_to_array(F.col(col)) if isinstance(dataset.schema[col].dataType, VectorUDT) else F.col(col).cast("array<double>")
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), x.alias("x")).where("y IS NOT NULL AND x IS NOT NULL")
        first = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones"), F.max(F.size("x")).alias("f")).first()
        n, ones = first["n"], first["ones"] or 0.0
        edges = bin_edges(rows, "x", first["f"] or 0, self.getOrDefault(self.bins)) if n else []
        base = float(np.log(ones / (n - ones))) if 0 < ones < n else None
        return rows.select("y", _binned(F.col("x"), edges).alias("bins")), edges, base


class HistogramBoosterModel(Model, _Boosting, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as one row of numbers per node: tree, feature, threshold, missing left, left, right, value, gain."""

    nodes = Param(Params._dummy(), "nodes", "all nodes of all trees", TypeConverters.toListListFloat)
    start = Param(Params._dummy(), "start", "first score and number of features", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", predictionCol: str = "prediction", growth: str = "level",
                 nodes: list[list[float]] | None = None, start: list[float] | None = None):
        super().__init__()
        self._setDefault(predictionCol="prediction", featuresCol="features", growth="level")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, trees: list[Tree], edges: list[list[float]], base: float, rate: float, rules: GrowthRules, features: str, prediction: str):
        nodes = []
        for t, tree in enumerate(trees):
            for k in range(len(tree.left)):
                inner = tree.left[k] >= 0
                nodes.append([float(t), float(tree.feature[k]) if inner else -1.0, _threshold(edges, tree.feature[k], tree.cut[k]) if inner else 0.0,
                              float(tree.missing_left[k]), float(tree.left[k]), float(tree.right[k]), rate * rules.value(tree.sums[k]),
                              tree.gain[k] if inner else 0.0])
        return cls(featuresCol=features, predictionCol=prediction, growth=rules.growth, nodes=nodes, start=[base, float(len(edges))])

    @property
    def featureImportances(self) -> DenseVector:
        """Shares that sum to 1: level growth the mean gain of a feature's splits, leaf growth their number."""
        out = np.zeros(int(self.getOrDefault(self.start)[1]))
        count = np.zeros_like(out)
        for node in self.getOrDefault(self.nodes):
            if node[4] >= 0:
                out[int(node[1])] += node[7]
                count[int(node[1])] += 1
        out = count if self.getOrDefault(self.growth) == "leaf" else np.where(count > 0, out / np.maximum(count, 1), 0)
        return DenseVector(out / out.sum() if out.sum() else out)

    def margin(self, features: Column, vector: bool) -> Column:
        """Log odds of label 1; missing features follow each split's default side."""
        table, (base, width) = self.getOrDefault(self.nodes), self.getOrDefault(self.start)

        @F.pandas_udf("double")
        def scored(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import numpy as np
            import pandas as pd
            flat = np.array(table, float).reshape(-1, 8)
            trees = [flat[flat[:, 0] == t] for t in range(int(flat[-1, 0]) + 1 if len(flat) else 0)]
            for part in values:
                x = np.array([np.asarray(v, float) for v in part], float).reshape(len(part), int(width))
                out = np.full(len(x), base)
                every = np.arange(len(x))
                for t in trees:
                    at = np.zeros(len(x), np.int64)
                    while (inner := t[at, 4] >= 0).any():
                        f = np.maximum(t[at, 1], 0).astype(np.int64)
                        v = x[every, f]
                        left = np.where(np.isnan(v), t[at, 3] > 0, v <= t[at, 2])
                        at = np.where(inner, np.where(left, t[at, 4], t[at, 5]).astype(np.int64), at)
                    out += t[at, 6]
                yield pd.Series(out)

        return scored(vector_to_array(features) if vector else features.cast("array<double>"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        col = self.getFeaturesCol()
        margin = self.margin(F.col(col), isinstance(dataset.schema[col].dataType, VectorUDT))
        return dataset.withColumn(self.getPredictionCol(), (margin > 0).cast("double"))


def split_report(dataset: DataFrame, features: Sequence[str], label: str, rules: GrowthRules, bins: int = 256) -> DataFrame:
    """Nodes of the first tree: ``(node, depth, feature, threshold, missing_left, gain, n_rows, value)``; a leaf has no
    feature, threshold, side and gain."""
    est = HistogramBooster(featuresCol="_fp_x", labelCol=label, bins=bins)
    rows, edges, base = est.prepared(dataset.select(label, F.array(*[F.col(c).cast("double") for c in features]).alias("_fp_x")))
    out = []
    if base is not None:
        rows = with_gradients(rows.withColumn("score", F.lit(base))).persist(StorageLevel.MEMORY_AND_DISK)
        tree = grow(rows, rules, (len(edges), max(map(len, edges)) + 2))
        rows.unpersist()
        place = {0: 0}                                        # numbers by level: 2k + 1 and 2k + 2 under k
        for k in range(len(tree.left)):
            if tree.left[k] >= 0:
                place[tree.left[k]], place[tree.right[k]] = 2 * place[k] + 1, 2 * place[k] + 2
            inner = tree.left[k] >= 0
            if k in place:
                out.append((place[k], tree.depth[k], features[tree.feature[k]] if inner else None,
                            _threshold(edges, tree.feature[k], tree.cut[k]) if inner else None, tree.missing_left[k] if inner else None,
                            tree.gain[k] if inner else None, tree.sums[k][2], rules.value(tree.sums[k])))
    return dataset.sparkSession.createDataFrame(out, "node int, depth int, feature string, threshold double, missing_left boolean, gain double, n_rows long, value double")
