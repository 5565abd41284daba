"""Order-dependent operators (F1-F5, F8): dedup keep-first, dense row ids, top-k, head.

None of them pulls all rows, or all rows of one key, into a single task:

* ``dedup_first`` is a grouped minimum of rows: partial aggregation keeps one candidate per key per
  map task before the shuffle, so a key holding a third of the rows costs one row per task.
* ``dense_index`` range-partitions on (groups, order), materializes the sorted frame with its
  (partition, position) tags under the checkpoint folder, counts rows per (partition, group)
  -- a table bounded by partitions x groups -- and adds running offsets. Exact ids; the rows
  are shuffled once (the range partitioning), the rest are small aggregates.
* ``top_k`` / ``head`` are ``orderBy(...).limit(k)``: Spark plans TakeOrderedAndProject, which
  keeps k rows per partition before merging.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions import strip_accents
from featurepipe.session import broadcast_if_small, materialize


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _unordered(df: DataFrame) -> bool:
    """Whether a column has a type that Spark does not compare."""
    return any(t in kind for _, kind in df.dtypes for t in ("map<", "variant", "interval", "geometry", "geography"))


def dedup_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """keep the first row per key in ``order``; NULL keys count as equal.

    ``order`` must identify rows uniquely for a deterministic result (a row-order key).
    """
    key = list(key)
    payload = [c for c in df.columns if c not in key]
    if not payload:
        return df.dropDuplicates(key)
    if all(isinstance(c, str) and c in df.columns for c in order) and not _unordered(df.select(*payload)):
        # order columns lead the least row itself: a candidate is held once, not beside its order
        lead = [c for c in dict.fromkeys(order) if c in payload]
        best = F.min(F.struct(*lead, *[c for c in payload if c not in lead])).alias("_fp_first")
    else:
        best = F.min_by(F.struct(*payload), F.struct(*_cols(order))).alias("_fp_first")
    return (df.groupBy(*key).agg(best)
            .select(*key, *[F.col("_fp_first")[c].alias(c) for c in payload])
            .select(*df.columns))


def dense_index(df: DataFrame, order: Sequence[str | Column], partition_by: Sequence[str] = (),
                name: str = "_row_id", num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` within its ``partition_by`` group.

    Equivalent to ``row_number() OVER (PARTITION BY g ORDER BY o) - 1`` without collecting a
    group (or the whole frame) into one task. ``order`` must be unique within a group.
    """
    groups = list(partition_by)
    keys = [*_cols(groups), *_cols(order)]
    # Range partitioning samples its input in a separate job before the shuffle; keeping the
    # input persisted across both saves a second evaluation of everything upstream. (Bounds are
    # fixed on the driver once sampled, so a recomputed block lands in the same partition.)
    level = df.storageLevel
    owned = not (level.useMemory or level.useDisk)      # leave a caller's own cache alone
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if owned else df
    # Without an explicit count AQE may coalesce adjacent ranges for small inputs; a coalesced
    # partition is a contiguous run of ranges, so (partition id, position) stays the global order.
    ranged = src.repartitionByRange(num_partitions, *keys) if num_partitions else src.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_fp_pid", F.spark_partition_id())
              .withColumn("_fp_pos", F.monotonically_increasing_id()))
    # The range bounds come from a sample; a recomputed shuffle could move rows between
    # partitions. Materializing fixes the tags once, and lets the count pass read two columns.
    tagged = materialize(tagged, "dense-index")
    if owned:
        src.unpersist()
    spans = (tagged.groupBy("_fp_pid", *groups)
             .agg(F.count(F.lit(1)).alias("_fp_cnt"), F.min("_fp_pos").alias("_fp_first")))
    before = Window.partitionBy(*groups).orderBy("_fp_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_fp_off", F.coalesce(F.sum("_fp_cnt").over(before), F.lit(0)))
    spans = spans.select(F.col("_fp_pid").alias("_fp_spid"),
                         *[F.col(g).alias(f"_fp_g{i}") for i, g in enumerate(groups)],
                         "_fp_off", "_fp_first")
    # One row per (range partition, group) that meets: about partitions + groups rows. Counted, then
    # broadcast: a shuffle on these keys would send each range to one task again.
    spans = broadcast_if_small(spans, 500_000)
    cond = [F.col("_fp_pid") == F.col("_fp_spid")]
    cond += [F.col(g).eqNullSafe(F.col(f"_fp_g{i}")) for i, g in enumerate(groups)]
    out = tagged.join(spans, cond, "inner")
    rid = (F.col("_fp_off") + F.col("_fp_pos") - F.col("_fp_first")).cast("long")
    return out.select(*[F.col(c) for c in df.columns if c != name], rid.alias(name))


def with_row_id(df: DataFrame, order: Sequence[str | Column], name: str = "_row_id",
                partition_by: Sequence[str] = ()) -> DataFrame:
    """dense row id 0..n-1 in ``order`` (per ``partition_by`` group when given)."""
    return dense_index(df, order, partition_by=partition_by, name=name)


def top_k(df: DataFrame, col: str, k: int = 10, tiebreak: Sequence[str] = ()) -> DataFrame:
    """the k largest values of ``col`` (code-point order for text, ties by ``tiebreak``), ascending."""
    order = [col, *tiebreak]
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(k).orderBy(*[F.col(c).asc() for c in order])


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """the first n rows in ``order``."""
    return df.orderBy(*_cols(order)).limit(n)


def before_after(df: DataFrame, col: str, k: int = 10, fn: Callable[[Column], Column] = strip_accents,
                 tiebreak: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """F8: (dirty, clean) pairs for the k largest values changed by ``fn`` (C2 + F4), ascending."""
    dirty = df.select(*keep, *[t for t in tiebreak if t not in keep], F.col(col).alias("dirty"))
    top = top_k(dirty.where(~F.col("dirty").eqNullSafe(fn(F.col("dirty")))), "dirty", k, tiebreak)
    return top.select(*keep, "dirty", fn(F.col("dirty")).alias("clean"))
