"""Operator 6: line deduplication against levelled sorted runs of line hashes.

A run is a table of (128-bit line hash, first document) sorted by hash. Documents come in
batches of ascending id; each batch merge-anti-joins its keys with all runs, and what is new
becomes a run of level 0. Before the next batch, every level holding ``fanout`` runs is merged
into one run of the next level, so a batch meets O(log batches) runs. As batches ascend, the
document stored with a hash is the smallest that holds the line. A line is dropped where a
smaller document is stored with its hash.

Only DataFrame functions are used. Line texts never leave the scan: the shuffles by key carry
hashes, and the documents are joined once with the positions of their dropped lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm.common import ASCII_LOWER, ASCII_SPACE, ASCII_UPPER
from featurepipe.session import materialize

_KEY = ["h1", "h2"]
_LAST = (1 << 63) - 1                       # a null id comes after all others


class LineRuns:
    """Levelled sorted runs of line hashes: ``(h1, h2, first)`` with the first document of each."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.runs: list[tuple[int, DataFrame]] = []

    def table(self) -> DataFrame | None:
        """All runs as one frame; a hash is in one run only."""
        return reduce(DataFrame.unionByName, [run for _, run in self.runs]) if self.runs else None

    def fresh(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose hash no run holds (merge anti join)."""
        held = self.table()
        return keys if held is None else keys.join(held.select(*_KEY).hint("merge"), _KEY, "left_anti")

    def add(self, keys: DataFrame) -> DataFrame:
        """Store new ``(h1, h2, first)`` rows as a sorted run of level 0 and return it."""
        run = materialize(keys.sortWithinPartitions(*_KEY), "line-run")
        self.runs.append((0, run))
        return run

    def compact(self) -> None:
        """Merge every level that has ``fanout`` runs into one sorted run of the next level."""
        level = 0
        while level <= max([0, *(n for n, _ in self.runs)]):
            own = [run for n, run in self.runs if n == level]
            if len(own) >= self.fanout:
                merged = reduce(DataFrame.unionByName, own).repartition(*map(F.col, _KEY)).sortWithinPartitions(*_KEY)
                self.runs = [x for x in self.runs if x[0] != level]
                self.runs.append((level + 1, materialize(merged, "line-run")))
            level += 1


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(ASCII_SPACE))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, ASCII_UPPER, ASCII_LOWER))


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Number of the batch of a row: ranges of ``ord`` of about equal row counts."""
    shares = [i / batches for i in range(1, batches)] or [0.5]
    found = docs.where(f"ord < {_LAST}").agg(F.percentile_approx("ord", shares, 1000)).first()[0] or []
    cuts = sorted(set(found[: batches - 1]))
    return reduce(lambda n, cut: n + (F.col("ord") > F.lit(int(cut))).cast("int"), cuts, F.lit(0))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 2, report: bool = True) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text_col``, and (``report``) ``n_lines`` and ``n_dropped``.

    Texts are split at ``\\n`` (null or empty: one empty line). Keys of at least ``min_chars``
    code points keep their lines in the smallest document that holds them and lose them in all
    others; other lines stay. Kept lines are joined by ``\\n``; a null text without a dropped
    line becomes empty. Rows with a null id count as one document after all others; rows that
    repeat an id are the same document. All other columns pass through; columns that are
    already named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("ord"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    part = _batch_of(base, batches)
    key = line_key(F.col("line"))
    lines = (base.withColumn("mark", F.xxhash64("body"))
             .select("ord", "mark", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
             .select("ord", "mark", "pos", key.alias("key")).where(F.length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "ord", "mark", "pos",
                     part.alias("batch")))
    lines = materialize(lines, "line-hashes")

    runs, dropped = LineRuns(spark, fanout), []
    for n in range(batches):
        own = lines.where(F.col("batch") == n)
        runs.compact()
        runs.add(runs.fresh(own.groupBy(*_KEY).agg(F.min("ord").alias("first"))))
        dropped.append(own.join(runs.table().hint("merge"), _KEY).where("ord > first").select("ord", "mark", "pos"))
    gone = (reduce(DataFrame.unionByName, dropped).groupBy("ord", "mark")
            .agg(F.array_sort(F.collect_set("pos")).alias("gone")))

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("ord"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    whole = whole.withColumn("mark", F.xxhash64("body")).join(gone, ["ord", "mark"], "left")
    split = F.split("body", "\n", -1)
    # the lines between one dropped position and the next, each slice copied once
    stay = F.flatten(F.zip_with(F.concat(F.array(F.lit(-1)), "gone"), F.concat(F.col("gone"), F.array(F.size(split))),
                                lambda p, q: F.slice(split, p + 2, q - p - 1)))
    counts = [F.size(split).cast("long").alias("n_lines"),
              F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")] if report else []
    names = [c for c in docs.columns if not (report and c in ("n_lines", "n_dropped"))]
    return whole.select(
        *[(F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(stay, "\n")) if c == text_col
           else F.col("row")[c]).alias(c) for c in names], *counts)
