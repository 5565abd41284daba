import os

import pytest
from pyspark.sql import functions as F

from featurepipe.operators.gates import GateError, gate_metrics, judge_metrics
from featurepipe.operators.hooks import HookRegistry
from featurepipe.operators.stats import merged_profile, profile, profile_state
from featurepipe.sources.published import publish_stage, stage_path
from featurepipe.sources.sinks import write_predictions
from featurepipe.sources.stages import read_stage


def _publish(frames, path, fmt="parquet"):
    return publish_stage(frames, path, fmt, order_by="k", metrics=lambda n, d: gate_metrics(n, d, "k", "label", "yr", 1880, 2030, ("val",)),
                         judge=judge_metrics)


def _rows(spark, path):
    return sorted(map(tuple, read_stage(spark, f"{stage_path(spark, path)}/split=train").select("k", "yr").collect()))


def test_publish_all_or_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stage")
    good = spark.range(500).selectExpr("id AS k", "1990 AS yr", "CAST(id % 2 AS INT) AS label").repartition(5)
    val = good.drop("label")
    _publish({"train": good, "val": val}, path)
    first = stage_path(spark, path)
    assert len(_rows(spark, path)) == 500 and sorted(os.listdir(first)) == ["split=train", "split=val"]
    assert "_fp_again" not in read_stage(spark, f"{first}/split=train").columns
    bad = {"year_range": good.withColumn("yr", F.when(F.col("k") == 7, 1700).otherwise(F.col("yr"))),
           "key_unique": good.unionAll(good.where("k < 3")), "key_not_null": good.withColumn("k", F.when(F.col("k") != 3, F.col("k"))),
           "label_values": good.withColumn("label", F.when(F.col("k") == 9, 5).otherwise(F.col("label")))}
    count = {"year_range": 1, "key_unique": 3, "key_not_null": 1, "label_values": 1}
    for gate, df in bad.items():
        with pytest.raises(GateError, match=rf"\[train\] gate {gate} failed: {count[gate]} violation"):
            _publish({"train": df, "val": val}, path)
        assert stage_path(spark, path) == first and len(_rows(spark, path)) == 500
    # a write that is lost half-way: the second split fails
    broken = val.withColumn("yr", F.when(F.col("k") == 400, F.raise_error(F.lit("disk lost")).cast("int")).otherwise(F.col("yr")))
    with pytest.raises(Exception, match="disk lost"):
        _publish({"train": good.where("k < 10"), "val": broken}, path)
    assert stage_path(spark, path) == first and len(_rows(spark, path)) == 500
    assert not [f for f in os.listdir(path) if f.startswith("_staging")]
    _publish({"train": good.where("k < 10"), "val": val}, path)
    assert len(_rows(spark, path)) == 10 and os.path.isdir(first)             # its readers can finish
    _publish({"train": good.where("k < 20"), "val": val}, path)
    assert len(_rows(spark, path)) == 20 and not os.path.isdir(first)
    assert stage_path(spark, tmp_dir) == tmp_dir
    # evaluators send the session with their tasks
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    pred = good.selectExpr("CAST(label AS DOUBLE) AS label", "CAST(label AS DOUBLE) AS prediction")
    assert MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred) == 1.0


def test_audit_reads_the_table_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(1000).write.parquet(path)
    reg = HookRegistry(audited=True)
    reg.register(lambda d: d.where("id % 10 != 0"), "drop_tenth")
    reg.register(lambda d: d.withColumn("x", F.col("id") * 2), "add_x")
    reg.register(lambda d: d.where("id < 500"), "halve")
    out = reg.apply(spark.read.parquet(path))
    assert out.orderBy("id").count() == 450 and out.rdd.count() == 450       # other users of the frame, with jobs of their own
    sc = spark.sparkContext
    sc.setJobGroup("audit", "audit")
    audit = reg.audit(spark)
    jobs = sc.statusTracker().getJobIdsForGroup("audit")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert [(r.hook, r.rows_dropped, r.cols_added) for r in audit.collect()] == [("drop_tenth", 100, []), ("add_x", 0, ["x"]), ("halve", 450, [])]
    assert len(jobs) == 1


def test_one_file_from_many_parts(spark, tmp_dir):
    df = spark.range(5000).selectExpr("id", "CAST(id % 3 = 0 AS DOUBLE) AS prediction").repartition(6)
    folder, file = os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "p.txt")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_predictions(df, "id", folder, single_file=file)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([f for f in os.listdir(folder) if f.startswith("part-")]) > 1
    assert open(file).read().splitlines() == [str(i % 3 == 0) for i in range(5000)]
    write_predictions(df.limit(0), "id", folder, single_file=file)
    assert open(file).read() == ""


def test_profile_states_merge(spark):
    df = spark.range(6000).selectExpr("CAST(id % 4 AS STRING) AS day", "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 5000 END AS x",
                                      "concat('n', id % 11) AS s", "CAST(id % 2 AS DOUBLE) AS z")
    whole = {r.column: r for r in merged_profile(profile_state(df.drop("day")), "t").collect()}
    parts = profile_state(df.where("day < '2'"), ["day"]).unionByName(profile_state(df.where("day >= '2'").repartition(7), ["day"]))
    merged = {r.column: r for r in merged_profile(parts, "t").collect()}
    assert merged == whole
    exact = {r.column: r for r in profile(df.drop("day"), "t").collect()}
    for c, r in exact.items():
        assert (merged[c].n_rows, merged[c].n_missing, merged[c].pct_missing, merged[c].dtype) == (r.n_rows, r.n_missing, r.pct_missing, r.dtype)
        assert abs(merged[c].n_unique - r.n_unique) <= 0.05 * r.n_unique
    by_day = merged_profile(parts, "t", by="day")
    assert by_day.select("split").distinct().count() == 4 and by_day.count() == 12
