"""Binding of the pipeline's roles to the driver's tables, and the deterministic dirt the
registered queries inject (the tables hold no NULL and no sentinel text).

Each dirty column is ONE SQL expression string used twice: through ``F.expr`` on the Spark side
and verbatim in the DuckDB oracle, so both engines see identical input. The expressions only
use functions both dialects define identically (CASE, %, ||, CAST(bigint AS STRING), year,
floor, lower, translate, chr). Backslashes are written as chr(92) because Spark's SQL parser
unescapes string literals and DuckDB's does not. The modulo terms choose WHICH rows get dirt;
no row is ever filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.config import NULL_SENTINELS
from featurepipe.functions.numeric import NUMBER_BODY

BS_N = "(chr(92) || 'N')"          # the two-character text backslash-N
BS_BS_N = "(chr(92) || chr(92) || 'N')"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_text(value: str) -> str:
    """SQL literal of a sentinel; backslashes as chr(92), which both dialects read alike."""
    if "\\" not in value:
        return f"'{value}'"
    return "(" + " || ".join("chr(92)" if c == "\\" else f"'{c}'" for c in value) + ")"


def sql_number(x: str) -> str:
    """DuckDB twin of ``functions.to_number`` for text input."""
    return (f"(CASE WHEN regexp_full_match({x}, '{NUMBER_BODY}') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END)")


def sql_sentinel_trim(x: str) -> str:
    """DuckDB twin of ``null_if_sentinel(trim=True)`` with the default list."""
    lst = ", ".join(_sql_text(v) for v in NULL_SENTINELS if v.strip())
    return f"(CASE WHEN trim({x}) IN ({lst}) THEN NULL ELSE trim({x}) END)"


def sql_sentinel_exact(x: str) -> str:
    """DuckDB twin of ``null_if_sentinel(trim=False)`` with the default list."""
    lst = ", ".join(map(_sql_text, NULL_SENTINELS))
    return f"(CASE WHEN {x} IN ({lst}) THEN NULL ELSE {x} END)"


# ---------------------------------------------------------------------------------------------
# Entity binding (flagship): one bronze row per lineitem, keyed by its order, so every order key
# appears once per line and dedup keeps the first line. Splits follow the order priority.
# Columns available: lineitem l_*, orders o_*, customer c_*.
# ---------------------------------------------------------------------------------------------
ENTITY_SPLIT = ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'train' "
                "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'val' ELSE 'test' END")
ENTITY_COLS: dict[str, str] = {
    "tconst": "'tt' || CAST(l_orderkey AS STRING)",
    "primaryTitle": (
        "CASE WHEN l_orderkey % 4 = 0 THEN translate(lower(c_mktsegment), 'aeiou', 'áéíóú') || ' ' "
        "|| CAST(c_nationkey AS STRING) "
        "WHEN l_orderkey % 4 = 1 THEN '  ' || lower(c_mktsegment) || ' ' || CAST(l_linenumber AS STRING) "
        "|| ' market ' "
        "WHEN l_orderkey % 4 = 2 THEN 'Ünïcödé Çàsé ' || o_orderstatus ELSE c_name END"),
    "originalTitle": (
        "CASE WHEN l_orderkey % 2 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN c_name "
        "WHEN l_orderkey % 5 = 0 THEN 'NA' ELSE lower(c_mktsegment) || ' market' END"),
    "startYear": (
        f"CASE WHEN l_orderkey % 10 = 3 THEN {BS_N} WHEN l_orderkey % 10 = 7 THEN NULL "
        "WHEN l_orderkey % 10 = 9 THEN 'unknown' WHEN l_orderkey % 97 = 0 THEN '1925' "
        "WHEN l_orderkey % 89 = 0 THEN '2101' ELSE CAST(year(o_orderdate) AS STRING) END"),
    "endYear": (
        "CASE WHEN l_orderkey % 10 IN (3, 9) THEN ' ' || CAST(year(o_orderdate) AS STRING) "
        "WHEN l_orderkey % 10 = 7 THEN '1700' WHEN l_orderkey % 20 = 1 THEN '2031' "
        f"ELSE {BS_N} END"),
    "runtimeMinutes": (
        "CASE WHEN l_orderkey % 50 = 0 THEN 'NA' WHEN l_orderkey % 53 = 0 THEN '700' "
        "WHEN l_orderkey % 59 = 0 THEN '90 min' "
        "ELSE CAST(CAST(floor(l_quantity) AS BIGINT) * 4 AS STRING) END"),
    "numVotes": (
        "CASE WHEN l_orderkey % 10 = 5 THEN 'null' WHEN l_orderkey % 61 = 0 THEN '-3' "
        "ELSE CAST(CAST(floor(l_extendedprice * 20) AS BIGINT) AS STRING) END"),
    "label": (
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN "
        "(CASE WHEN o_orderstatus = 'F' THEN 'True' WHEN o_orderstatus = 'O' THEN 'false' ELSE '1' END) "
        "END"),
}


# Row order of the entity rows. Line numbers repeat within an order in this data, so the order
# key takes every line column needed to make it unique.
ENTITY_ORDER: dict[str, str] = {
    "_ok": "l_orderkey", "_ln": "l_linenumber", "_pk": "l_partkey", "_sk": "l_suppkey",
    "_qt": "l_quantity", "_px": "l_extendedprice", "_sd": "l_shipdate",
}


def entity_bronze_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entity rows (before sentinel cleaning) with the row-order columns of ENTITY_ORDER."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    # the two smaller tables first: joined last, customers would be met by every line, not every order
    oc = o.join(c, o.o_custkey == c.c_custkey, "inner")
    j = li.join(oc, li.l_orderkey == oc.o_orderkey, "inner")
    return j.select(*[F.col(c).alias(a) for a, c in ENTITY_ORDER.items()],
                    F.expr(ENTITY_SPLIT).alias("split"),
                    *[F.expr(e).alias(n) for n, e in ENTITY_COLS.items()])


def entity_bronze_sql() -> str:
    cols = ",\n      ".join(f"{e} AS {n}" for n, e in ENTITY_COLS.items())
    order = ", ".join(f"{c} AS {a}" for a, c in ENTITY_ORDER.items())
    return (f"SELECT {order}, {ENTITY_SPLIT} AS split,\n      {cols}\n"
            "    FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
            "JOIN customer ON o_custkey = c_custkey")


def entity_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(key, member) relations: directors = suppliers of the order's lines, writers = parts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    key = F.concat(F.lit("tt"), F.col("l_orderkey").cast("string")).alias("key")
    return {"n_directors": li.select(key, F.col("l_suppkey").cast("string").alias("member")),
            "n_writers": li.select(key, F.col("l_partkey").cast("string").alias("member"))}


# ---------------------------------------------------------------------------------------------
# Model binding: documents with their labels. Labelled documents are the train split, the rest
# is the hidden split to predict; n_chars gets NULLs so the imputer has work.
# ---------------------------------------------------------------------------------------------
DOC_FEATURES = ("n_chars", "log_chars", "len_text", "word_count", "has_number", "is_en")


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, split, label (quality, NULL when hidden) and the DOC_FEATURES columns."""
    from featurepipe.operators.features import add_length, add_log, add_word_count, flag_matches
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    j = d.join(lab, "doc_id", "left").select(
        "doc_id", "text", "lang", "label",
        F.when(F.col("label").isNull(), "hidden").otherwise("train").alias("split"),
        F.when(F.col("doc_id") % 9 == 0, None).otherwise(F.col("n_chars")).cast("double").alias("n_chars"))
    j = add_log(j, "n_chars", "log_chars")
    j = add_length(j, "text", "len_text")
    j = add_word_count(j, "text", "word_count")
    j = flag_matches(j, "text", "has_number")
    j = j.withColumn("is_en", (F.col("lang") == "en").cast("int"))
    return j.select("doc_id", "split", "label", *DOC_FEATURES)
