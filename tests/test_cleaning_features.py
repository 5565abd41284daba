import math

from pyspark.sql import functions as F

from featurepipe.operators import (
    add_bucket, add_length, add_log, before_after, cast_range, changed_rows, default_flags, drop_if_present,
    flag_differs, flag_threshold, gold_projection, map_label, repair_swap, select_features,
)
from featurepipe.session import broadcast_if_small


def test_repair_swap_text_and_numeric(spark):
    df = spark.createDataFrame([("\\N", "1999"), (None, "1700"), ("abc", " 2001 "), ("1990", "2000"), (None, None)],
                               "a string, b string")
    got = [tuple(r) for r in repair_swap(df, "a", "b", 1880, 2030).collect()]
    assert got == [("1999", None), (None, "1700"), (" 2001 ", None), ("1990", "2000"), (None, None)]
    num = spark.createDataFrame([(None, 1999.0), (float("nan"), 2000.0), (1.0, 2.0)], "a double, b double")
    got = [tuple(r) for r in repair_swap(num, "a", "b", 1880, 2030).collect()]
    assert got[0] == (1999.0, None) and got[1] == (2000.0, None) and got[2] == (1.0, 2.0)


def test_cast_range_bounds_and_types(spark):
    df = spark.createDataFrame([("0",), ("1",), ("600",), ("601",), ("inf",), ("-inf",), (" 7 ",)], "x string")
    assert [r.x for r in cast_range(df, "x", 1, 600).collect()] == [None, 1.0, 600.0, None, None, None, 7.0]
    assert [r.x for r in cast_range(df, "x", 0).collect()][4] == math.inf
    nums = spark.createDataFrame([(5,), (None,), (-1,)], "x int")
    assert [r.x for r in cast_range(nums, "x", 0).collect()] == [5.0, None, None]
    assert cast_range(nums, "missing", 0).columns == ["x"]


def test_map_label_text_and_boolean(spark):
    t = spark.createDataFrame([("True",), ("true",), ("1",), ("False",), ("false",), ("0",), ("TRUE",), (None,)], "label string")
    assert [r.label for r in map_label(t).collect()] == [1, 1, 1, 0, 0, 0, None, None]
    b = spark.createDataFrame([(True,), (False,), (None,)], "label boolean")
    assert [r.label for r in map_label(b).collect()] == [1, 0, None]
    assert map_label(t.withColumnRenamed("label", "y")).columns == ["y"]


def test_features_and_flags(spark):
    df = spark.createDataFrame([(0.0, "Été", 1999.0, None), (9.0, None, 1930.0, 1), (None, "ab", None, 0)],
                               "v double, t string, y double, f int")
    out = add_bucket(add_length(add_log(df, "v", "lv"), "t", "lt"), "y", "dec")
    rows = out.collect()
    assert [r.lv for r in rows] == [0.0, math.log(10.0), None]
    assert [r.lt for r in rows] == [3, None, 2]
    assert [r.dec for r in rows] == [1990.0, 1930.0, None]
    d = default_flags(df, ["f", "absent"]).collect()
    assert [(r.f, r.absent) for r in d] == [(0, 0), (1, 0), (0, 0)]
    th = flag_threshold(df, "y", "old", "<", 1930).collect()
    assert [r.old for r in th] == [0, 0, None]
    diff = flag_differs(spark.createDataFrame([(" a ", "a"), (None, "x"), ("a", None), ("a", "b")], "a string, b string"),
                        "a", "b", "d").collect()
    assert [r.d for r in diff] == [0, 1, 0, 1]
    assert drop_if_present(df, ["f", "nope"]).columns == ["v", "t", "y"]
    g = gold_projection(df.withColumn("label", F.lit("1")), keep=["t"], doubles=["f"], label="label")
    assert g.dtypes == [("t", "string"), ("f", "double"), ("label", "int")]
    assert select_features(df, ["y", "zzz", "v"], label="f").columns == ["y", "v", "f"]


def test_changed_rows_before_after(spark):
    df = spark.createDataFrame([(1, "Ábc"), (2, "abc"), (3, "Zé"), (4, "Zé"), (5, None)], "id int, t string")
    assert sorted(r.id for r in changed_rows(df, "t").collect()) == [1, 3, 4]
    num = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "label double")
    assert [r.label for r in map_label(num).collect()] == [1, 0, None, None]
    ba = [tuple(r) for r in before_after(df, "t", 2, tiebreak=["id"], keep=["id"]).collect()]
    assert ba == [(4, "Zé", "Ze"), (1, "Ábc", "Abc")]   # the two largest by code point (tie by id), ascending


def test_broadcast_if_small(spark):
    small = spark.createDataFrame([(1,)], "k int")
    plan = spark.range(10).join(broadcast_if_small(small), F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_compare_stages(spark):
    from featurepipe.operators import null_sentinels
    from featurepipe.plans.compare import compare_stages
    raw = spark.createDataFrame([(1, "Ábc", "NA"), (2, "abc", "1999"), (3, "Öd", None)], "id int, t string, y string")
    clean = null_sentinels(raw, ["y"], ["NA"])
    pairs, cov = compare_stages(raw, clean, "t", ["y"], k=5, tiebreak=["id"])
    assert sorted((r.dirty, r.clean) for r in pairs.collect()) == [("Ábc", "Abc"), ("Öd", "Od")]
    got = {(r.stage, r.column): round(r.pct_available, 4) for r in cov.collect()}
    assert got == {("raw", "y"): round(200 / 3, 4), ("clean", "y"): round(100 / 3, 4)}
