"""A1/A2: multi-file CSV scan aligned by column NAME.

Spark's multi-file CSV read maps columns by position (the first file's header wins), so files
are grouped by their header line and each group is one all-string read; the groups are combined
with ``unionByName(allowMissingColumns=True)``. Headers come from a scan in the executors that also
finds the files with line breaks inside quotes: those are cut into records by ``csv_records`` and
parsed by ``from_csv``, all others are one ``spark.read.csv`` a group. Both ways split files over
tasks. Every row carries its scan position (file path, block start, position) so callers can
restore file order without a global sort at read time.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from featurepipe.session import materialized
from featurepipe.sources.csv_records import cut_records, first_records, line_ends, text_lines

ORDER_COLS = ("_src_file", "_src_block", "_src_pos")
_BAD = "_fp_bad"
_INK = r"[^\x00-\x20]"                     # a line without any such character is no row


class _Group(NamedTuple):
    """Files with one header; those of ``records`` have line breaks inside quotes."""
    header: tuple[str, ...]
    lines: list[str]
    records: list[str]


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob on any Hadoop-compatible file system, sorted by path."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    statuses = fs.globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in statuses if s.isFile())


def _names(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header record (RFC 4180 quotes; surrounding spaces removed)."""
    return tuple(h.strip() for h in next(csv.reader([line.lstrip("﻿")], delimiter=sep), [""]))


def read_header(spark: SparkSession, file: str, sep: str = ",") -> tuple[str, ...]:
    """First line of a file as a CSV row (RFC 4180 quotes; surrounding spaces removed)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return _names(line, sep)


def _reader(spark: SparkSession, schema: StructType, sep: str, mode: str):
    """RFC 4180: quotes inside a quoted field are doubled, so the escape is the quote itself."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", mode)
            .option("quote", '"').option("escape", '"').option("columnPruning", False).option("enforceSchema", True))


def _strings(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def _scanned_headers(spark: SparkSession, files: list[str], sep: str) -> list[tuple[str, tuple[str, ...], bool]]:
    """``(file, header, has line breaks in quotes)`` by one scan of the text: a row per file reaches
    the driver, as many as its own listing holds."""
    lines = text_lines(spark, files)
    value = F.col("value")
    opens, _ = line_ends(value, sep)
    breaks = opens | (value.contains('"') & value.rlike(r"\r(?!\z)"))
    rows = lines.where(value.rlike(_INK)).groupBy("file").agg(
        F.min(F.struct("block", "pos", F.regexp_replace("value", r"\r\z", "").alias("value"), opens.alias("opens"))).alias("first"),
        F.max(breaks).alias("breaks")).collect()
    long = [unquote(r.file) for r in rows if r["first"]["opens"]]        # headers that hold line breaks themselves
    heads = {r.file: r.record for r in first_records(text_lines(spark, long), sep).collect()} if long else {}
    longer = [f for f in long if f not in set(map(unquote, heads))]        # longer than a block
    if longer:
        heads |= {r.file: r.record for r in cut_records(text_lines(spark, longer), sep).where("head").collect()}
    out = []
    for r in rows:
        head = heads.get(r.file)
        # a carriage return alone ends a line too, so the first line may hold more than the header
        names = _names(head, sep) if head is not None else _names(r["first"]["value"].split("\r")[0], sep)
        out.append((unquote(r.file), names, r.breaks))
    return sorted(out)


def _by_header(spark: SparkSession, pattern: str | Sequence[str], sep: str, multiline: bool) -> list[_Group]:
    """Files grouped by their header, in listing order. Files without any row belong to no group."""
    files = list_files(spark, pattern) if isinstance(pattern, str) else list(pattern)
    if not files:
        raise FileNotFoundError(f"no file matches {pattern}")
    if multiline:
        found = _scanned_headers(spark, files, sep)
    else:                # a few bytes each, concurrently: object stores have per-request latency
        with ThreadPoolExecutor(max_workers=min(32, len(files))) as pool:
            found = [(f, h, False) for f, h in zip(files, pool.map(lambda f: read_header(spark, f, sep), files))]
    groups: dict[tuple[str, ...], _Group] = {}
    for file, header, breaks in found:
        group = groups.setdefault(header, _Group(header, [], []))
        (group.records if breaks else group.lines).append(file)
    return list(groups.values())


def _of_records(spark: SparkSession, group: _Group, sep: str) -> DataFrame:
    """Rows of a group's files with line breaks in quotes, with the text of malformed ones in ``_BAD``."""
    rows = cut_records(text_lines(spark, group.records), sep).where(~F.col("head") & F.col("record").rlike(_INK))
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*group.header, _BAD])
    parsed = F.from_csv(F.col("record"), ddl, {
        "sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": _BAD})
    rows = rows.select(parsed.alias("r"), *(F.col(c).alias(n) for c, n in zip(("file", "block", "pos"), ORDER_COLS)))
    return rows.select(*[F.col(f"r.`{h}`") for h in group.header], F.col(f"r.{_BAD}"), *ORDER_COLS)


def _of_lines(spark: SparkSession, group: _Group, sep: str, mode: str) -> DataFrame:
    """Rows of a group's other files; with ``PERMISSIVE`` malformed ones have their text in ``_BAD``."""
    schema = _strings([*group.header, _BAD] if mode == "PERMISSIVE" else group.header)
    df = _reader(spark, schema, sep, mode).option("columnNameOfCorruptRecord", _BAD).csv(group.lines)
    return df.select(*[F.col(f"`{h}`") for h in schema.names], F.col("_metadata.file_path").alias("_src_file"),
                     F.col("_metadata.file_block_start").alias("_src_block"), F.monotonically_increasing_id().alias("_src_pos"))


def _pick(out: DataFrame, columns: Sequence[str] | None, keep_extra: Sequence[str], *more: str) -> DataFrame:
    if columns is None:
        return out
    have = set(out.columns)
    picked = [F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns]
    extra = [F.col(f"`{c}`") for c in keep_extra if c in have and c not in columns]
    return out.select(*picked, *extra, *more, *ORDER_COLS)


def _union(spark: SparkSession, frames: list[DataFrame], *more: str) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], ", ".join([*(f"{m} string" for m in more), "_src_file string, _src_block long, _src_pos long"]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_union(spark: SparkSession, pattern: str | Sequence[str], columns: Sequence[str] | None = None,
                   on_error: str = "fail", sep: str = ",", keep_extra: Sequence[str] = (),
                   multiline: bool = True) -> DataFrame:
    """All-string frame of every file matching ``pattern`` (or the listed files).

    ``on_error="fail"``: a malformed row fails the job. ``"drop"``: malformed rows are dropped
    (``read_csv_tolerant`` gives them too). Column pruning inside the CSV parser is switched off so
    the check also happens for ``count()`` and narrow selections. Quoted fields may hold
    separators, doubled quotes and line breaks; files are split over tasks all the same, for one
    more scan of the text, which also reads the headers. With ``multiline=False`` every line is a
    row, a broken one where a quote stays open, and only headers are read beforehand, by the
    driver. ``columns`` selects (and orders) the output; a column absent from every file is NULL.
    Files without any row give none. Adds ORDER_COLS.
    """
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED"}[on_error]
    frames = []
    for group in _by_header(spark, pattern, sep, multiline):
        if group.lines:
            frames.append(_of_lines(spark, group, sep, mode))
        if group.records:
            rows = _of_records(spark, group, sep)
            bad = F.col(_BAD)
            if on_error == "fail":        # in a filter, so that no pruning of columns removes it
                says = F.raise_error(F.concat(F.col("_src_file"), F.lit(": malformed CSV record: "), bad))
                rows = rows.where(F.when(bad.isNotNull(), says.cast("boolean")).otherwise(True))
            else:
                rows = rows.where(bad.isNull())
            frames.append(rows.drop(_BAD))
    return _pick(_union(spark, frames), columns, keep_extra)


def _permissive(spark: SparkSession, pattern: str | Sequence[str], sep: str, multiline: bool) -> DataFrame:
    frames = []
    for group in _by_header(spark, pattern, sep, multiline):
        frames += [_of_lines(spark, group, sep, "PERMISSIVE")] if group.lines else []
        frames += [_of_records(spark, group, sep)] if group.records else []
    return _union(spark, frames, _BAD)


def read_csv_tolerant(spark: SparkSession, pattern: str | Sequence[str], columns: Sequence[str] | None = None, sep: str = ",",
                      keep_extra: Sequence[str] = (), multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_csv_union(on_error="drop")`` and the ``(file, record)`` that it drops, from
    one parse: all rows are written to the shared folder once, and both frames read them there."""
    parsed, _ = materialized(_pick(_permissive(spark, pattern, sep, multiline), columns, keep_extra, _BAD), "csv-rows")
    return (parsed.where(F.col(_BAD).isNull()).drop(_BAD),
            parsed.where(F.col(_BAD).isNotNull()).select(F.col("_src_file").alias("file"), F.col(_BAD).alias("record")))


def csv_rejects(spark: SparkSession, pattern: str | Sequence[str], sep: str = ",", multiline: bool = True) -> DataFrame:
    """``(file, record)`` of the rows that the tolerant read drops, without the rows themselves."""
    rows = _permissive(spark, pattern, sep, multiline)
    names = [c for c in rows.columns if c not in (*ORDER_COLS, _BAD)]
    # the reader refuses queries of the corrupt column alone, so the record also names the fields
    none = F.substring(F.concat_ws("", *[F.col(f"`{n}`") for n in names]), 1, 0)
    return rows.select(F.col("_src_file").alias("file"), F.concat(none, F.col(_BAD)).alias("record")).where("record IS NOT NULL")
