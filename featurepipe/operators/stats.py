"""Aggregations: exact median (E4), median imputation (E6), profile (E5, E2), coverage (E7),
positive counts (E8).

``exact_median`` never holds a large group in one task. Spark's exact ``percentile`` keeps every
distinct value of a group in one aggregation buffer, which is right as long as a count proves the
groups small. Larger ones go through ``radix_select``: doubles become 64-bit whole numbers of the
same order, and four rounds find the number of a rank 16 bits at a time. A round is one partially
aggregated count by (group, next digit) of the rows that share the digits known so far, then a running
sum over at most 65,536 digits. Counts are exact and every round is deterministic: a recomputed
task changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions import once
from featurepipe.session import broadcast_if_small, materialized, release

_CAP = 500_000        # values per group an exact in-task median may hold
_BROADCAST_GROUPS = 100_000   # per-group tables up to this many rows are broadcast


def _valid(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def _join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner",
                 broadcast: bool = False) -> DataFrame:
    """Join on the group columns with NULL as a group of its own, like ``groupBy``."""
    names = {c: f"_fp_k{i}" for i, c in enumerate(by)}
    right = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    out = left.join(F.broadcast(right) if broadcast else right, cond, how)
    return out if how == "left_semi" else out.drop(*names.values())


_DIGIT = 16


def ordered_bits(x: Column) -> Column:
    """Whole number of a double with the same order: its IEEE bits, negated for negative values.

    Exponent and mantissa come from arithmetic that is exact: scaling by powers of two, in two steps so
    that none leaves the range. -0.0 counts as 0.0; NaN and null give null.
    """
    size = F.abs(x)
    power = once(_near_power(size), lambda e: _power(size, e))
    return _bits(x, once(power, lambda e: _normal_bits(size, e)))


def with_ordered_bits(df: DataFrame, src: str, dst: str) -> DataFrame:
    """``ordered_bits`` of a double column, its steps in projections of their own (compiled, which a
    lambda is not)."""
    x, size = F.col(src), F.abs(F.col(src))
    out = df.withColumn("_fp_near", _near_power(size)).withColumn("_fp_power", _power(size, F.col("_fp_near")))
    return out.withColumn(dst, _bits(x, _normal_bits(size, F.col("_fp_power")))).drop("_fp_near", "_fp_power")


def _near_power(size: Column) -> Column:
    return F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023)).cast("int")     # may be one off


def _scaled(size: Column, e: Column) -> Column:                  # size / 2**e, exactly
    half = F.floor(e / 2).cast("int")
    return size * F.pow(F.lit(2.0), (-half).cast("double")) * F.pow(F.lit(2.0), (half - e).cast("double"))


def _power(size: Column, e: Column) -> Column:
    return F.when(_scaled(size, e) < 1.0, F.greatest(e - 1, F.lit(-1022))).when(_scaled(size, e) >= 2.0, e + 1).otherwise(e)


def _normal_bits(size: Column, e: Column) -> Column:
    two52 = float(1 << 52)
    return (e + 1023).cast("long") * (1 << 52) + (_scaled(size, e) * two52 - two52).cast("long")


def _bits(x: Column, normal: Column) -> Column:
    size = F.abs(x)
    low = (size * float(2 ** 537) * float(2 ** 537)).cast("long")
    bits = (F.when(x.isNull() | F.isnan(x), None).when(size == 0.0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(0x7FF << 52))
            .when(size < 2.2250738585072014e-308, low).otherwise(normal))
    return F.when(x < 0, -bits).otherwise(bits)


def radix_select(values: DataFrame, ranks: DataFrame, by: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """``(*by, fit, rank, value)``: the value of each 0-based ``rank`` among the group's values in order.

    ``ranks`` holds (*by, fit, rank). A row counts as often as ``weight`` says, an array with one number
    for each fit (0, 1, ...); without it every row counts once and fit is 0. Values that are null
    or NaN count for nothing; ranks beyond a group's values have no row. NULL is a group like others.
    """
    by = list(by)
    spark = values.sparkSession
    rows = values.select(*by, F.col(value).cast("double").alias("_v"), *([F.col(weight).alias("_w")] if weight else []))
    # valid values first: a filter on the key would compute it a second time. The rounds share one copy
    # of the keys, and a lost block is computed again to the same keys.
    rows = rows.where(_valid(F.col("_v")))
    rows = with_ordered_bits(rows, "_v", "_key").persist(StorageLevel.MEMORY_AND_DISK)
    found, folder = materialized(ranks.select(*by, "fit", "rank", F.col("rank").alias("_left"), F.lit(0).cast("long").alias("_known")), "radix")
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        known = F.lit(0).cast("long") if shift + _DIGIT == 64 else F.shiftright("_key", shift + _DIGIT)
        open_ = found.select(*by, "_known").distinct()
        # one or two rows a group and fit; a group may hold most of the rows, so it is not shuffled by
        near = _join_groups(rows.withColumn("_known", known), broadcast_if_small(open_, _BROADCAST_GROUPS), [*by, "_known"], "left_semi")
        near = near.withColumn("_next", F.shiftright("_key", shift))
        if weight:
            fits = len(near.select("_w").head()["_w"]) if near.head(1) else 0
            sums = near.groupBy(*by, "_known", "_next").agg(*[F.sum(F.col("_w")[i]).alias(f"_w{i}") for i in range(fits)], F.max("_v").alias("_v"))
            each = F.array(*[F.col(f"_w{i}") for i in range(fits)]) if fits else F.array().cast("array<long>")
            counts = sums.select(*by, "_known", "_next", "_v", F.posexplode(each).alias("fit", "_n")).where("_n > 0")
        else:
            counts = near.groupBy(*by, "_known", "_next").agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_v")).withColumn("fit", F.lit(0))
        upto = Window.partitionBy(*by, "_known", "fit").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        found = _join_groups(found.drop("_v"), counts, [*by, "_known", "fit"]).where("_left < _upto AND _left >= _upto - _n").select(
            *by, "fit", "rank", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), F.col("_next").alias("_known"), "_v")
        last, (found, folder) = folder, materialized(found, "radix")
        release(spark, last)
    rows.unpersist()
    return found.select(*by, "fit", "rank", F.col("_v").alias("value"))


def exact_median(df: DataFrame, col: str, by: Sequence[str] = (), cap: int = _CAP) -> DataFrame:
    """Exact median of ``col`` per ``by`` group (NULL and NaN ignored): one row per group that has
    at least one value, columns ``(*by, median)``. Mean of the two middle values for even n.
    Groups of more than ``cap`` values are selected by radix.
    """
    return _median_table(df, col, by, cap)[0]


def _median_table(df: DataFrame, col: str, by: Sequence[str] = (), cap: int = _CAP) -> tuple[DataFrame, int]:
    """``exact_median`` plus the number of groups (known from its first, one-row job)."""
    out_by = list(by)
    by = out_by or ["_fp_g"]          # one constant group when no grouping is asked for
    src = df if out_by else df.withColumn("_fp_g", F.lit(0))
    x = src.select(*by, F.col(col).cast("double").alias("_x")).where(_valid(F.col("_x")))
    sizes = x.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    shape = sizes.agg(F.count(F.lit(1)).alias("g"), F.max("_n").alias("m")).first()
    n_groups, largest = int(shape["g"]), (shape["m"] or 0)
    if largest <= cap:
        # Every group is proven to hold at most ``cap`` values: Spark's exact percentile keeps
        # them in one buffer per group, which that bound makes safe. Its interpolation
        # 0.5*a + 0.5*b equals (a + b) / 2 bit for bit (halving is exact).
        return (x.groupBy(*by).agg(F.percentile("_x", F.lit(0.5)).alias("median"))
                .select(*out_by, "median")), n_groups
    middle = F.array_distinct(F.array(((F.col("_n") - 1) / 2).cast("long"), (F.col("_n") / 2).cast("long")))
    ranks = sizes.select(*by, F.lit(0).alias("fit"), F.explode(middle).alias("rank"))
    found = radix_select(x, ranks, by, "_x")
    return found.groupBy(*by).agg(((F.min("value") + F.max("value")) / 2).alias("median")).select(*out_by, "median"), n_groups


def group_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact medians of several columns in one pass: ``(*by, feature, median)`` rows."""
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_fp_v")) for c in cols if c in df.columns]
    if not cells:
        return df.select(*by, F.lit("").alias("feature"), F.lit(0.0).alias("median")).limit(0)
    long = df.select(*by, F.explode(F.array(*cells)).alias("_fp_c")).select(*by, "_fp_c.*")
    return exact_median(long, "_fp_v", [*by, "feature"])


def impute_median(df: DataFrame, col: str, by: Sequence[str] = (), medians: DataFrame | None = None,
                  ) -> DataFrame:
    """NULL/NaN in ``col`` become the exact median of its ``by`` group (or of the frame).

    The column becomes double. A group with no value keeps its NULLs; NULL is a group too.
    ``medians`` may be given (e.g. fitted on a training split, or by ``group_medians``) as
    ``(*by, [feature,] median)``.
    """
    if col not in df.columns:
        return df
    by = list(by)
    if medians is not None:
        med, n_groups = medians, None
    else:
        med, n_groups = _median_table(df, col, by)
    x = F.col(col).cast("double")
    if "feature" in med.columns and "feature" not in by:
        med = med.where(F.col("feature") == col).drop("feature")
    if not by:
        row = med.first()
        value = None if row is None else row["median"]
        return df.withColumn(col, F.when(_valid(x), x).otherwise(F.lit(value).cast("double")))
    # one row per group, and a group (a split) may hold a third of the rows: broadcast when small
    med = med.select(*by, F.col("median").alias("_fp_med"))
    med = (F.broadcast(med) if n_groups <= _BROADCAST_GROUPS else med) if n_groups is not None \
        else broadcast_if_small(med, _BROADCAST_GROUPS)
    out = _join_groups(df, med, by, "left")
    out = out.withColumn(col, F.when(_valid(x), x).otherwise(F.col("_fp_med")))
    return out.select(*df.columns)


def _missing(c: Column, dtype: str) -> Column:
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def profile(df: DataFrame, name: str, approx: bool = False, by: str | None = None) -> DataFrame:
    """E5: per column n_rows, n_missing, pct_missing (2 dp, half-even), n_unique (NULL excluded),
    dtype. One unpivot to (column, value-as-text) and a two-level distinct count, so no single
    task holds all values of a column; ``approx=True`` uses HyperLogLog++ instead.
    Wide text crosses the network once a distinct value and task: use ``approx`` there. An empty
    frame gives zeros, one row per column. Columns keep their input order (``ordinal``). With ``by`` (e.g. the split column) every group
    is profiled in the same job and ``split`` becomes ``name + "_" + group``.
    """
    dtypes = [(c, t) for c, t in df.dtypes if c != by]
    if not dtypes:
        return df.sparkSession.createDataFrame(
            [], "split string, column string, n_rows long, n_missing long, pct_missing double, "
                "n_unique long, dtype string, ordinal int")
    cells = [F.struct(F.lit(i).alias("o"), F.lit(c).alias("c"), F.lit(t).alias("t"),
                      F.when(~_missing(F.col(c), t), F.col(c).cast("string")).alias("v"))
             for i, (c, t) in enumerate(dtypes)]
    g = [F.col(by).cast("string").alias("_fp_by")] if by else []
    gk = ["_fp_by"] if by else []
    long = df.select(*g, F.explode(F.array(*cells)).alias("_fp_cell")).select(*gk, "_fp_cell.*")
    if approx:
        per_col = long.groupBy(*gk, "o", "c", "t").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("v").isNull()).alias("n_missing"),
            F.approx_count_distinct("v").alias("n_unique"))
    else:
        per_val = long.groupBy(*gk, "o", "c", "t", "v").agg(F.count(F.lit(1)).alias("_k"))
        per_col = per_val.groupBy(*gk, "o", "c", "t").agg(
            F.sum("_k").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("_k"))), F.lit(0)).alias("n_missing"),
            F.count("v").alias("n_unique"))
    if not by:
        # one row a column even for an empty frame: add a row of zeros and sum it in
        none = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(
            F.lit(i).alias("o"), F.lit(c).alias("c"), F.lit(t).alias("t"), F.lit(0).cast("long").alias("n_rows"),
            F.lit(0).cast("long").alias("n_missing"), F.lit(0).cast("long").alias("n_unique")) for i, (c, t) in enumerate(dtypes)])).alias("z")).select("z.*")
        per_col = per_col.unionByName(none).groupBy("o", "c", "t").agg(*[F.sum(n).alias(n) for n in ("n_rows", "n_missing", "n_unique")])
    n_rows = F.col("n_rows").cast("long")
    pct = F.bround(F.col("n_missing") / F.greatest(n_rows, F.lit(1)) * 100, 2)
    split = F.concat(F.lit(name + "_"), F.col("_fp_by")) if by else F.lit(name)
    return (per_col.select(split.alias("split"), F.col("c").alias("column"), n_rows.alias("n_rows"),
                    F.col("n_missing").cast("long").alias("n_missing"), pct.alias("pct_missing"),
                    F.col("n_unique").cast("long").alias("n_unique"), F.col("t").alias("dtype"),
                    F.col("o").alias("ordinal")))


_REGISTERS = 12                  # bits of a hash that name a register


def profile_state(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """E5 in a form that can be stored and merged: ``(*group, ordinal, column, dtype, register, most, n)``.

    Values are hashed; the first 12 bits of a hash name a register, which keeps the greatest place of
    the first set bit of the rest (``most``, a HyperLogLog) and the rows that fell into it; missing
    values have register -1. There are at most 4,097 rows a column and group. States merge by
    maximum and sum, so the order in which files or shards come plays no part.
    ``group`` names e.g. the split and the file or day that the rows came with.
    """
    names = list(group)
    cells = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                      F.when(~_missing(F.col(c), t), F.xxhash64(F.col(c).cast("string"))).alias("h"))
             for i, (c, t) in enumerate(x for x in df.dtypes if x[0] not in names)]
    long = df.select(*names, F.explode(F.array(*cells)).alias("_fp_c")).select(*names, "_fp_c.*")
    rest = 64 - _REGISTERS
    place = F.lit(rest + 1) - F.length(F.bin(F.col("h").bitwiseAND(F.lit((1 << rest) - 1))))      # bin(0) has one digit
    register = F.coalesce(F.shiftrightunsigned("h", rest).cast("int"), F.lit(-1))
    return long.groupBy(*names, "ordinal", "column", "dtype", register.alias("register")).agg(F.max(place).alias("most"), F.count(F.lit(1)).alias("n"))


def merged_profile(states: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The profile of all rows that went into ``states`` (of each ``by`` group), without reading them again.

    It equals that of a single state of all rows. ``n_unique`` is estimated: its relative standard
    error is 1.04 / sqrt(4096), 1.63 percent; ``profile`` counts exactly.
    """
    keys = ([by] if by else []) + ["ordinal", "column", "dtype"]
    one = states.groupBy(*keys, "register").agg(F.max("most").alias("most"), F.sum("n").alias("n"))
    live, m = F.col("register") >= 0, 1 << _REGISTERS
    out = one.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~live, F.col("n"))), F.lit(0)).alias("n_missing"), F.count_if(live).alias("k"),
        F.coalesce(F.sum(F.when(live, F.pow(F.lit(2.0), -F.col("most").cast("double")))), F.lit(0.0)).alias("z"))
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("z") + (m - F.col("k")))
    few = F.lit(float(m)) * F.ln(m / (m - F.col("k")).cast("double"))          # while registers are empty
    estimate = F.when((raw <= 2.5 * m) & (F.col("k") < m), few).otherwise(raw)
    split = F.concat(F.lit(name + "_"), F.col(by).cast("string")) if by else F.lit(name)
    return out.select(split.alias("split"), "column", "n_rows", "n_missing",
                      F.bround(F.col("n_missing") / F.greatest(F.col("n_rows"), F.lit(1)) * 100, 2).alias("pct_missing"),
                      F.round(estimate).cast("long").alias("n_unique"), "dtype", "ordinal")


def coverage(df: DataFrame, cols: Sequence[str], stage: str | None = None) -> DataFrame:
    """Percent of non-missing values per column, one row per column (single pass); 0 for no rows."""
    present = [c for c in cols if c in df.columns]
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(~_missing(F.col(c), dtypes[c])).alias(f"_c{i}") for i, c in enumerate(present)]
    row = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column"),
                      F.coalesce(F.try_divide(F.col(f"_c{i}") * 100.0, F.col("_n")), F.lit(0.0)).alias("pct_available"))
             for i, c in enumerate(present)]
    out = row.select(F.explode(F.array(*cells)).alias("_fp")).select("_fp.*")
    if stage is not None:
        out = out.select(F.lit(stage).alias("stage"), "*")
    return out


def label_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sum of each 0/1 column (label and flags), one row."""
    present = [c for c in cols if c in df.columns]
    return df.agg(*[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"sum_{c}")
                    for c in present])
