"""Stages that appear all or not at all: write, audit, publish.

Every split of a stage is written into a staging folder, with the counts that its gates need observed
by the write itself, so no gate reads the data again. Only when all splits are written and every
gate has passed does the folder become a version of the stage, and one rename of a small manifest makes
it the current one. A failing gate or a lost write leaves the manifest, and with it the old version, as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from featurepipe.sources.stages import write_stage

MANIFEST = "_current"


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(conf), at


def stage_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the current version of a published stage; ``path`` itself for a plain one."""
    fs, at = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(at):
        return path
    stream = fs.open(at)
    try:
        jvm = spark.sparkContext._jvm
        name = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return f"{path}/{name}"


def _set_current(spark: SparkSession, path: str, version: str) -> None:
    """Replace the manifest by one rename."""
    sc = spark.sparkContext
    fs, fresh = _fs(spark, f"{path}/{MANIFEST}.{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(version.encode()))
    out.close()
    jvm = sc._jvm
    over = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(fresh).toUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(_fs(spark, f"{path}/{MANIFEST}")[1]), over)


def _apart(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own, with the same settings and cache. A session that has observed a
    frame can no longer be sent along with tasks, as evaluators of ``pyspark.ml`` do with theirs."""
    spark = df.sparkSession
    other = spark._jsparkSession.cloneSession()
    plan = spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(other, df._jdf.logicalPlan())
    return type(df)(plan, SparkSession(spark.sparkContext, other))


def publish_stage(frames: Mapping[str, DataFrame], path: str, fmt: str = "parquet", split_col: str = "split",
                  order_by: str | Sequence[str] | None = None, drop: Sequence[str] = (),
                  metrics: Callable[[str, DataFrame], tuple[DataFrame, dict[str, Column]]] | None = None,
                  judge: Callable[[dict[str, dict[str, int]]], None] | None = None) -> str:
    """Write one folder ``split_col=name`` for each frame and publish them together; the new version's folder.

    ``metrics`` gives, for a split, its frame (perhaps with columns that only the counts need, which it
    names with a leading ``_fp_``) and the aggregates to observe. ``judge`` gets them by split once all
    splits are written, and raises to keep the stage from being published. The version that was current
    is kept, so that its readers can finish; older ones go.
    """
    spark = next(iter(frames.values())).sparkSession
    fs, staging = _fs(spark, f"{path}/_staging-{uuid.uuid4().hex}")
    version = f"v-{uuid.uuid4().hex}"
    try:
        seen: dict[str, dict[str, int]] = {}
        for name, df in frames.items():
            observed = None
            if metrics is not None:
                df, counts = metrics(name, _apart(df))
                watch = Observation()
                observed = (watch, [c.alias(n) for n, c in counts.items()])
            write_stage(df, f"{staging}/{split_col}={name}", fmt, order_by=order_by,
                        drop=[*drop, *(c for c in df.columns if c.startswith("_fp_"))], observed=observed)
            if observed:
                seen[name] = dict(watch.get)
        if judge is not None:
            judge(seen)
        fs.rename(staging, _fs(spark, f"{path}/{version}")[1])
    finally:
        fs.delete(staging, True)
    before = stage_path(spark, path).rsplit("/", 1)[-1]
    _set_current(spark, path, version)
    for status in fs.listStatus(_fs(spark, path)[1]):
        if status.getPath().getName().startswith("v-") and status.getPath().getName() not in (version, before):
            fs.delete(status.getPath(), True)
    return f"{path}/{version}"
