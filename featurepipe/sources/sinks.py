"""Sinks: predictions as True/False lines in row order (A9) and the model report (A10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def prediction_text(pred: Column) -> Column:
    """1 -> 'True', anything else -> 'False' (the submission format)."""
    return F.when(pred == 1, F.lit("True")).otherwise(F.lit("False"))


def join_parts(spark: SparkSession, folder: str, file: str) -> None:
    """One file of the part files of ``folder`` in name order. The bytes go from stream to stream, in
    blocks, so nothing is held; the file appears whole, by a rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(file)
    fs = source.getFileSystem(conf)
    parts = sorted(str(s.getPath().toString()) for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    fresh = jvm.org.apache.hadoop.fs.Path(f"{file}._joining")
    out = fs.create(fresh, True)
    try:
        for part in parts:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()
    fs.delete(target, False)
    fs.rename(fresh, target)


def write_predictions(df: DataFrame, order_col: str, path: str, pred_col: str = "prediction",
                      single_file: str | bool = False) -> None:
    """One line per row, in ``order_col`` order. Spark writes range-sorted part files; their
    concatenation (part-00000, part-00001, ...) is the submission. ``single_file`` asks for it as one
    file of that name (``path`` with ``.txt`` if just true): any number of tasks writes the parts, and
    the file system joins them."""
    out = df.orderBy(order_col).select(prediction_text(F.col(pred_col)).alias("value"))
    out.write.mode("overwrite").text(path)
    if single_file:
        join_parts(df.sparkSession, path, f"{path}.txt" if single_file is True else single_file)


def model_report(spark: SparkSession, lines: Sequence[str]) -> DataFrame:
    """A10: report lines as a one-column frame (``value``), numbered to keep their order."""
    return spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "line int, value string")


def write_report(report: DataFrame, path: str) -> None:
    report.orderBy("line").select("value").coalesce(1).write.mode("overwrite").text(path)
