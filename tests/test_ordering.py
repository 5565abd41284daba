import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from featurepipe.operators import dedup_first, dense_index, head, top_k


def test_dense_index_matches_row_number(spark):
    random.seed(7)
    rows = [(i, random.choice(["a", "b", None, "c"]), random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g string, x double")
    got = dense_index(df, ["x", "k"], ["g"], name="rid")
    w = Window.partitionBy("g").orderBy("x", "k")
    exp = df.withColumn("rid", F.row_number().over(w) - 1)
    assert sorted(got.collect()) == sorted(exp.collect())
    glob = dense_index(df, ["x", "k"], name="rid").select("k", "rid")
    expg = df.withColumn("rid", F.row_number().over(Window.orderBy("x", "k")) - 1).select("k", "rid")
    assert sorted(glob.collect()) == sorted(expg.collect())


def test_dedup_first_keeps_first_and_handles_hot_key(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", f"v{i}") for i in range(600)] + [(1000, None, "n1"), (999, None, "n0")]
    df = spark.createDataFrame(rows, "pos long, key string, v string")
    got = {r.key: (r.pos, r.v) for r in dedup_first(df, ["key"], ["pos"]).collect()}
    exp = {}
    for pos, key, v in sorted(rows):
        exp.setdefault(key, (pos, v))
    assert got == exp


def test_top_k_and_head(spark):
    df = spark.createDataFrame([(i, f"t{i % 17:02d}") for i in range(100)], "id long, t string")
    top = [(r.t, r.id) for r in top_k(df, "t", 5, ["id"]).collect()]
    assert top == sorted([(f"t{i % 17:02d}", i) for i in range(100)])[-5:]      # the largest, ascending
    assert [r.id for r in head(df, 3, ["t", "id"]).collect()] == [0, 17, 34]
