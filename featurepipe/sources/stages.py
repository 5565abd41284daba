"""Stage checkpoints (merged / cleaned / processed) and profiles, written and read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", order_by: str | Sequence[str] | None = None,
                partition_by: str | None = None, drop: Sequence[str] = (),
                observed: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """Overwrite ``path`` with ``df``. ``order_by`` range-sorts the output (row order at the sink, F3:
    files in name order hold the rows in order); ``drop`` leaves columns out after that. CSV is
    written with a header, quotes doubled. ``partition_by`` lays out one folder per value (e.g. the
    split) so a reader of one split prunes the others. ``observed`` names aggregates that the write
    itself gathers: behind the sort, in the writing tasks, so that sampling and lost tasks add nothing."""
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    if partition_by and order:
        order = [partition_by, *order]
    out = df.orderBy(*order) if order else df
    if observed:
        out = out.observe(observed[0], *observed[1])
    out = out.drop(*drop)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported stage format {fmt!r}")


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a stage back: Parquet keeps its types; CSV takes ``schema`` (DDL or StructType)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        r = spark.read.option("header", True).option("escape", '"')
        return (r.schema(schema) if schema is not None else r).csv(path)
    raise ValueError(f"unsupported stage format {fmt!r}")


def write_profile(profile: DataFrame, path: str) -> None:
    """Profile rows as CSV with a header, in column order (a few rows per stage)."""
    cols = ["split", "column", "n_rows", "n_missing", "pct_missing", "n_unique", "dtype"]
    profile.orderBy("split", "ordinal").select(*cols).coalesce(1).write.mode("overwrite") \
        .option("header", True).option("escape", '"').csv(path)
