"""Quality gates.

``gate_report`` evaluates every gate in ONE job: a grouped aggregation on the key (partially
aggregated, so even a key holding a third of the rows is combined map-side) gives duplicates,
NULL keys, bad labels and out-of-range years at once; G1 is a schema check with no job.
``enforce`` then raises for the first failing gate in the reference order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions import to_number

GATE_ORDER = ("required_columns", "key_not_null", "key_unique", "label_values", "year_range")


def _bad_label(label: str):
    """G4 predicate: the label is not 0/1 (NULL is invalid too)."""
    return ~F.coalesce(F.col(label).try_cast("double").isin(0.0, 1.0), F.lit(False))


class GateError(RuntimeError):
    """A quality gate failed."""


def gate_report(df: DataFrame, split: str, required: Sequence[str], key: str, label: str | None,
                year: str | None, lo: float, hi: float, split_col: str | None = None,
                unlabelled: Sequence[str] = ()) -> DataFrame:
    """One row per gate: (split, gate, ordinal, violations); violations NULL = not applicable
    (no label column, or a split named in ``unlabelled``; no year column).

    With ``split_col`` the frame holds several splits; each is checked on its own (duplicates
    are counted within a split) and ``split`` is ignored.
    """
    spark = df.sparkSession
    missing = sorted(set(required) - set(df.columns))
    schema = "split string, gate string, ordinal int, violations long"
    if key not in df.columns:
        rows = [(split, g, i, (len(missing) if i == 0 else None)) for i, g in enumerate(GATE_ORDER)]
        return spark.createDataFrame(rows, schema)
    has_label = bool(label) and label in df.columns
    has_year = bool(year) and year in df.columns
    bad_label = _bad_label(label) if has_label else F.lit(False)
    if has_year:
        y = to_number(year, df.schema[year].dataType)
        bad_year = y.isNotNull() & ((y < float(lo)) | (y > float(hi)))
    else:
        bad_year = F.lit(False)
    parts = [split_col] if split_col else []
    per_key = df.groupBy(*parts, key).agg(F.count(F.lit(1)).alias("_n"),
                                          F.count_if(bad_label).alias("_bl"),
                                          F.count_if(bad_year).alias("_by"))
    tot = per_key.groupBy(*parts).agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("key_not_null"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("key_unique"),
        F.coalesce(F.sum("_bl"), F.lit(0)).alias("label_values"),
        F.coalesce(F.sum("_by"), F.lit(0)).alias("year_range"))
    name = F.col(split_col).cast("string") if split_col else F.lit(split)
    label_v = F.when(~F.coalesce(name.isin(*unlabelled), F.lit(False)), F.col("label_values"))
    cells = [
        F.struct(F.lit(0).alias("ordinal"), F.lit(GATE_ORDER[0]).alias("gate"),
                 F.lit(len(missing)).cast("long").alias("violations")),
        F.struct(F.lit(1).alias("ordinal"), F.lit(GATE_ORDER[1]).alias("gate"),
                 F.col("key_not_null").cast("long").alias("violations")),
        F.struct(F.lit(2).alias("ordinal"), F.lit(GATE_ORDER[2]).alias("gate"),
                 F.col("key_unique").cast("long").alias("violations")),
        F.struct(F.lit(3).alias("ordinal"), F.lit(GATE_ORDER[3]).alias("gate"),
                 (label_v if has_label else F.lit(None)).cast("long").alias("violations")),
        F.struct(F.lit(4).alias("ordinal"), F.lit(GATE_ORDER[4]).alias("gate"),
                 (F.col("year_range") if has_year else F.lit(None)).cast("long").alias("violations")),
    ]
    return (tot.select(name.alias("split"), F.explode(F.array(*cells)).alias("_g"))
            .select("split", "_g.gate", "_g.ordinal", "_g.violations"))


def first_failure(report: DataFrame) -> DataFrame:
    """The first failing gate of a report (by gate order, then split), or no row."""
    return report.where("violations > 0").orderBy("ordinal", "split").limit(1)


def enforce(report: DataFrame, df: DataFrame | None = None, label: str | None = None,
            available: Sequence[str] | None = None, shown: int = 100) -> None:
    """Raise ``GateError`` for the first failing gate (report has a handful of rows).

    The message of the label gate lists the bad values with their counts, the commonest ``shown``
    of them, and says how many kinds it leaves out.
    """
    rows = sorted(report.collect(), key=lambda r: (r["ordinal"], str(r["split"])))
    for r in rows:
        if r["violations"] is None or r["violations"] == 0:
            continue
        msg = f"[{r['split']}] gate {r['gate']} failed: {r['violations']} violation(s)"
        if r["gate"] == "required_columns" and available is not None:
            msg += f"; available columns: {sorted(available)}"
        if r["gate"] == "label_values" and df is not None and label:
            bad = df.where(_bad_label(label)).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
            top = bad.orderBy(F.col("_n").desc(), F.col(label).cast("string")).limit(shown).collect()
            msg += f"; values: { {b[0]: b[1] for b in top} }"
            if len(top) == shown and (more := bad.count() - shown):
                msg += f" and {more} more"
        raise GateError(msg)


def gate_metrics(split: str, df: DataFrame, key: str, label: str | None, year: str | None, lo: float, hi: float,
                 unlabelled: Sequence[str] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """G2-G5 of one split as aggregates that a write can observe: the frame, with a flag on all rows of a
    key but one, and the violations by gate. Keys meet in one task; more rows of a key than one
    are themselves the violation."""
    one = Window.partitionBy(key).orderBy(key)
    out = {"key_not_null": F.count_if(F.col(key).isNull()), "key_unique": F.count_if(F.col("_fp_again"))}
    if label and label in df.columns and split not in unlabelled:
        out["label_values"] = F.count_if(_bad_label(label))
    if year and year in df.columns:
        y = to_number(year, df.schema[year].dataType)
        out["year_range"] = F.count_if(y.isNotNull() & ((y < float(lo)) | (y > float(hi))))
    return df.withColumn("_fp_again", F.row_number().over(one) > 1), out


def judge_metrics(seen: Mapping[str, Mapping[str, int]]) -> None:
    """G6 on observed violations: raise ``GateError`` for the first failing gate (by gate order, then split)."""
    for gate in GATE_ORDER:
        for split in sorted(seen):
            if seen[split].get(gate):
                raise GateError(f"[{split}] gate {gate} failed: {seen[split][gate]} violation(s)")


def run_all_gates(df: DataFrame, split: str, required: Sequence[str], key: str, label: str | None,
                  year: str | None, lo: float, hi: float, split_col: str | None = None,
                  unlabelled: Sequence[str] = ()) -> DataFrame:
    """Build the report, raise on the first failure, return the report."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise GateError(f"[{split}] gate required_columns failed: missing {missing}; "
                        f"available columns: {sorted(df.columns)}")
    report = gate_report(df, split, required, key, label, year, lo, hi, split_col, unlabelled)
    rows = F.lit(True) if not split_col else ~F.coalesce(F.col(split_col).cast("string").isin(*unlabelled), F.lit(False))
    enforce(report, df.where(rows), label, df.columns)
    return report
