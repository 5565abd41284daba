"""One key / group holding a third of all rows: results stay exact and no step gathers it."""

import random
import statistics

from pyspark.sql import Window
from pyspark.sql import functions as F

from featurepipe import session
from featurepipe.operators import count_members, dedup_first, dense_index, exact_median


def _frame(spark, n=3000):
    random.seed(1)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i}", f"m{random.randrange(400)}", random.random()) for i in range(n)]
    return rows, spark.createDataFrame(rows, "pos long, key string, member string, x double")


def test_hot_key_results_exact(spark):
    rows, df = _frame(spark)
    first = {r.key: r.pos for r in dedup_first(df, ["key"], ["pos"]).collect()}
    assert first["hot"] == 0 and len(first) == 1 + sum(1 for i in range(3000) if i % 3)
    got = {r.key: r.n for r in count_members(df, "key", "member", "n").collect()}
    assert got["hot"] == len({m for _, k, m, _ in rows if k == "hot"})
    med = {r.key: r.median for r in exact_median(df.where(F.col("key").isin("hot", "k1")), "x", ["key"],
                                                  cap=50).collect()}
    assert med["hot"] == statistics.median([x for _, k, _, x in rows if k == "hot"])


def test_hot_group_row_ids_span_partitions(spark):
    rows, df = _frame(spark)
    g = df.withColumn("grp", F.when(F.col("key") == "hot", "hot").otherwise("rest"))
    got = dense_index(g, ["x", "pos"], ["grp"], name="rid", num_partitions=8)
    exp = g.withColumn("rid", F.row_number().over(Window.partitionBy("grp").orderBy("x", "pos")) - 1)
    assert sorted(got.select("pos", "rid").collect()) == sorted(exp.select("pos", "rid").collect())
    tagged = spark.read.parquet(session._MATERIALIZED[spark.sparkContext.applicationId][-1])
    parts = tagged.where(F.col("grp") == "hot").select("_fp_pid").distinct().count()
    assert parts >= 2      # the hot group is range-split, not sent to one task
