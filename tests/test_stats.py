import random
import statistics

from pyspark.sql import functions as F

from featurepipe.operators.stats import group_medians
from featurepipe.operators import coverage, exact_median, impute_median, label_summary, profile


def _median_py(xs):
    xs = [x for x in xs if x is not None and x == x]
    return statistics.median(xs) if xs else None


def test_exact_median_narrowing_paths(spark):
    random.seed(3)
    rows = [(i % 4, (float(random.choice([1, 2, 2, 3, 5])) if i % 2 else random.random() * 50)
             if i % 11 else None) for i in range(1200)]
    rows += [(9, float("nan")), (9, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    for cap in (10**6, 25, 1):
        got = {r.g: r.median for r in exact_median(df, "x", ["g"], cap=cap).collect()}
        for g in range(4):
            assert got[g] == _median_py([x for gg, x in rows if gg == g]), (cap, g)
        assert 9 not in got
        assert exact_median(df, "x", cap=cap).first()["median"] == \
            _median_py([x for _, x in rows])


def test_impute_median_by_group_and_all_null_group(spark):
    rows = [("a", 1.0), ("a", None), ("a", 10.0), ("a", 2.0), ("a", 11.0), ("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "s string, x double")
    got = sorted((r.s, r.x) for r in impute_median(df, "x", ["s"]).collect())
    assert got == sorted([("a", 1.0), ("a", 6.0), ("a", 10.0), ("a", 2.0), ("a", 11.0), ("b", None), ("b", None)])


def test_null_group_is_a_group_on_both_ways(spark):
    rows = [(g, float(i)) for i, g in enumerate(["a", None] * 20)] + [(None, None), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    want = {"a": 19.0, None: 20.0}
    for cap in (10**6, 5):
        assert {r.g: r.median for r in exact_median(df, "x", ["g"], cap=cap).collect()} == want
    filled = impute_median(df, "x", ["g"])
    assert sorted(r.x for r in filled.where("g IS NULL").collect())[10] == 20.0 and filled.where("x IS NULL").count() == 0


def test_group_medians_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 3.0, None), ("b", None, 7)], "g string, x double, y int")
    med = group_medians(df, ["x", "y", "absent"], ["g"])
    assert {(r.g, r.feature): r.median for r in med.collect()} == {("a", "x"): 2.0, ("a", "y"): 5.0, ("b", "y"): 7.0}
    out = impute_median(df, "y", ["g"], medians=med)
    assert sorted(r.y for r in out.collect()) == [5.0, 5.0, 7.0]


def test_empty_frames(spark):
    df = spark.createDataFrame([], "k long, s string")
    assert [(r.column, r.n_rows, r.n_missing, r.pct_missing, r.n_unique, r.dtype) for r in profile(df, "t").orderBy("ordinal").collect()] == [
        ("k", 0, 0, 0.0, 0, "bigint"), ("s", 0, 0, 0.0, 0, "string")]
    assert [(r.column, r.pct_available) for r in coverage(df, ["k"]).collect()] == [("k", 0.0)]


def test_profile_counts(spark):
    rows = [(1, "x", 1.0), (2, None, float("nan")), (3, "x", None), (3, "y", 2.0)]
    df = spark.createDataFrame(rows, "k long, s string, d double")
    p = {r.column: r for r in profile(df, "t").collect()}
    assert [c for c, _ in sorted(((r.column, r.ordinal) for r in p.values()), key=lambda t: t[1])] == ["k", "s", "d"]
    assert (p["k"].n_rows, p["k"].n_missing, p["k"].n_unique) == (4, 0, 3)
    assert (p["s"].n_missing, p["s"].n_unique, p["s"].pct_missing) == (1, 2, 25.0)
    assert (p["d"].n_missing, p["d"].n_unique, p["d"].dtype) == (2, 2, "double")
    approx = {r.column: r.n_unique for r in profile(df, "t", approx=True).collect()}
    assert approx["k"] == 3
    by = {(r.split, r.column): (r.n_rows, r.n_unique) for r in profile(df, "t", by="s").collect()}
    assert by[("t_x", "k")] == (2, 2) and by[("t_y", "d")] == (1, 1) and ("t_x", "s") not in by


def test_coverage_and_label_summary(spark):
    df = spark.createDataFrame([(1, None, 0), (1, 2.0, 1), (0, 3.0, None)], "label int, x double, f int")
    cov = {r.column: r.pct_available for r in coverage(df, ["x", "f", "missing"]).collect()}
    assert cov == {"x": 200 / 3, "f": 200 / 3}
    assert label_summary(df, ["label", "f"]).first().asDict() == {"sum_label": 2, "sum_f": 1}


def test_ordered_bits_equal_the_ieee_bits(spark):
    import math
    import struct

    from featurepipe.operators.stats import ordered_bits
    rng = random.Random(6)
    xs = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(4000)]
    for e in range(-1074, 1024, 3):
        p = math.ldexp(1.0, e)
        xs += [p, math.nextafter(p, 0), math.nextafter(p, math.inf), -p]
    xs += [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 2.225073858507201e-308, None]
    df = spark.createDataFrame(list(enumerate(xs)), "i int, x double")
    got = dict(df.select("i", ordered_bits(F.col("x"))).collect())
    for i, x in enumerate(xs):
        if x is None or x != x:
            assert got[i] is None
            continue
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert got[i] == (-bits if x < 0 else bits), x


def test_radix_select_with_weights(spark):
    from featurepipe.operators.stats import radix_select
    rng = random.Random(7)
    rows = [(rng.choice(["a", None]), rng.choice([rng.gauss(0, 1e3), rng.gauss(0, 1e-300), 2.0, float("nan"), None]), [rng.randrange(3), rng.randrange(2)])
            for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, w array<long>").repartition(3)
    ranks, want = [], {}
    for g in ("a", None):
        for fit in (0, 1):
            flat = sorted(v for h, v, w in rows if h == g and v is not None and v == v for _ in range(w[fit]))
            for k in (0, len(flat) // 2, len(flat) - 1, len(flat)):
                ranks.append((g, fit, k))
                if k < len(flat):
                    want[g, fit, k] = flat[k]
    got = radix_select(df, spark.createDataFrame(ranks, "g string, fit int, rank long"), ["g"], "v", weight="w")
    assert {(r.g, r.fit, r["rank"]): r.value for r in got.collect()} == want
