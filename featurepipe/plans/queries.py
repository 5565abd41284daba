"""Registered queries: one per operator group of the inventory, each with a DuckDB oracle.

Every query reads the driver's tables at ``sf_dir`` in full and injects dirt with the shared
SQL fragments of ``bindings``; the oracle is the same computation in plain SQL. Aggregates and
computed columns carry the same alias on both sides; doubles that go through transcendental
functions are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurepipe.config import DEFAULT
from featurepipe.functions import strip_accents
from featurepipe.operators import (
    add_bucket, add_length, add_log, add_word_count, before_after, cast_range, clean_relation,
    count_members, coverage, dedup_first, default_flags, exact_median, flag_differs, flag_matches,
    flag_threshold, gate_report, gold_projection, head, impute_median, join_counts, label_summary,
    map_label, null_sentinels, profile, relation_from_column_docs, relation_from_record_docs,
    relation_summary, repair_swap, strip_accents_cols, with_row_id,
)
from featurepipe.plans.bindings import (
    BS_BS_N, BS_N, ENTITY_ORDER, entity_bronze_sql, sql_number, sql_sentinel_exact, sql_sentinel_trim, table,
)

from featurepipe.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- B1 C4: sentinel text -> NULL (trimmed) --------------------------------------------------
NS_STATUS = (f"CASE WHEN o_orderkey % 7 = 0 THEN ' ' || {BS_N} || ' ' WHEN o_orderkey % 11 = 0 THEN 'NULL' "
             "WHEN o_orderkey % 13 = 0 THEN '   ' WHEN o_orderkey % 17 = 0 THEN 'n/a' "
             f"WHEN o_orderkey % 19 = 0 THEN {BS_BS_N} WHEN o_orderkey % 23 = 0 THEN 'None  ' "
             "ELSE ' ' || o_orderstatus END")
NS_PRIORITY = ("CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' WHEN o_orderkey % 29 = 0 THEN 'none' "
               "WHEN o_orderkey % 31 = 0 THEN ' null' WHEN o_orderkey % 37 = 0 THEN 'NA' "
               "WHEN o_orderkey % 41 = 0 THEN '' ELSE o_orderpriority END")


@register("null_sentinels", f"""
SELECT o_orderkey, {sql_sentinel_trim('s')} AS o_orderstatus, {sql_sentinel_trim('p')} AS o_orderpriority
FROM (SELECT o_orderkey, {NS_STATUS} AS s, {NS_PRIORITY} AS p FROM orders)
""")
def q_null_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.expr(NS_STATUS).alias("o_orderstatus"), F.expr(NS_PRIORITY).alias("o_orderpriority"))
    return null_sentinels(o, ["o_orderstatus", "o_orderpriority"], DEFAULT.sentinels, trim=True)


# --- B3: strip accents -------------------------------------------------------------------------
@register("strip_accents", """
SELECT doc_id, strip_accents(text) AS text_clean FROM documents
""")
def q_strip_accents(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("text_clean"))
    return strip_accents_cols(d, ["text_clean"])


@register("strip_accents_turns", """
SELECT conv_id, turn, strip_accents(text) AS text_clean FROM conversations
""")
def q_strip_accents_turns(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("text_clean"))
    return strip_accents_cols(c, ["text_clean"])


# --- C2 F4 F8: changed rows, top 10, before/after ------------------------------------------------
@register("changed_rows_topk", """
SELECT CAST(row_number() OVER (ORDER BY dirty, doc_id) AS INTEGER) AS rank, doc_id, dirty, clean
FROM (SELECT doc_id, text AS dirty, strip_accents(text) AS clean
      FROM documents WHERE text <> strip_accents(text) ORDER BY text DESC, doc_id DESC LIMIT 10)
""")
def q_changed_rows_topk(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text")
    top = before_after(d, "text", 10, strip_accents, tiebreak=["doc_id"], keep=["doc_id"])
    # ten rows: their order becomes a column, so that it is compared too
    return top.withColumn("rank", F.row_number().over(Window.orderBy("dirty", "doc_id"))).select("rank", "doc_id", "dirty", "clean")


# --- B4 C3: swapped-pair repair ------------------------------------------------------------------
SW_A = ("CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'abc' "
        "ELSE CAST(year(o_orderdate) AS STRING) END")
SW_B = ("CASE WHEN o_orderkey % 4 = 0 THEN '1700' "
        "WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN ' ' || CAST(year(o_orderdate) AS STRING) "
        "WHEN o_orderkey % 9 = 0 THEN '2031' WHEN o_orderkey % 11 = 0 THEN 'x' ELSE NULL END")


@register("repair_swap", f"""
SELECT o_orderkey,
  CASE WHEN na IS NULL AND nb BETWEEN 1880 AND 2030 THEN b ELSE a END AS start_year,
  CASE WHEN na IS NULL AND nb BETWEEN 1880 AND 2030 THEN NULL ELSE b END AS end_year
FROM (SELECT o_orderkey, a, b, {sql_number('a')} AS na, {sql_number('b')} AS nb
      FROM (SELECT o_orderkey, {SW_A} AS a, {SW_B} AS b FROM orders))
""")
def q_repair_swap(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(SW_A).alias("start_year"),
                                          F.expr(SW_B).alias("end_year"))
    return repair_swap(o, "start_year", "end_year", DEFAULT.year_min, DEFAULT.year_max)


# --- B5: lenient cast with range -----------------------------------------------------------------
CR_VALUE = ("CASE WHEN event_id % 17 = 0 THEN 'abc' WHEN event_id % 19 = 0 THEN '1d' "
            "WHEN event_id % 23 = 0 THEN 'nan' WHEN event_id % 29 = 0 THEN ' 1e3 ' "
            "WHEN event_id % 31 = 0 THEN 'inf' WHEN event_id % 37 = 0 THEN '0x1A' "
            "WHEN event_id % 41 = 0 THEN '1_000' WHEN event_id % 43 = 0 THEN '-5' "
            "WHEN event_id % 47 = 0 THEN '' WHEN event_id % 53 = 0 THEN '1f' "
            "WHEN event_id % 59 = 0 THEN '.5' ELSE CAST(value AS STRING) END")


@register("cast_range", f"""
SELECT event_id,
  CASE WHEN v >= 1 AND v <= 400 THEN v END AS value_in_range,
  CASE WHEN v >= 0 THEN v END AS value_nonneg
FROM (SELECT event_id, {sql_number('r')} AS v FROM (SELECT event_id, {CR_VALUE} AS r FROM events))
""")
def q_cast_range(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.expr(CR_VALUE).alias("r"))
    e = e.select("event_id", F.col("r").alias("value_in_range"), F.col("r").alias("value_nonneg"))
    e = cast_range(e, "value_in_range", 1, 400)
    return cast_range(e, "value_nonneg", 0, None)


CR_QTY = ("CASE WHEN l_linenumber = 3 THEN 'N/A' WHEN l_linenumber = 5 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) "
          "* 10 AS STRING) ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END")


@register("cast_range_lines", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN q >= 1 AND q <= 50 THEN q END AS quantity
FROM (SELECT l_orderkey, l_linenumber, {sql_number('r')} AS q
      FROM (SELECT l_orderkey, l_linenumber, {CR_QTY} AS r FROM lineitem))
""")
def q_cast_range_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(CR_QTY).alias("quantity"))
    return cast_range(li, "quantity", 1, 50)


# --- B6: label map -------------------------------------------------------------------------------
ML_RAW = ("CASE WHEN doc_id % 7 = 0 THEN 'yes' WHEN doc_id % 11 = 0 THEN NULL "
          "WHEN doc_id % 5 = 0 THEN (CASE WHEN quality = 1 THEN 'true' ELSE 'false' END) "
          "WHEN doc_id % 3 = 0 THEN CAST(quality AS STRING) "
          "ELSE (CASE WHEN quality = 1 THEN 'True' ELSE 'False' END) END")


@register("map_label", f"""
SELECT doc_id, CAST(CASE WHEN r IN ('True', 'true', '1') THEN 1 WHEN r IN ('False', 'false', '0') THEN 0 END
                    AS INTEGER) AS label
FROM (SELECT doc_id, {ML_RAW} AS r FROM labels)
""")
def q_map_label(spark: SparkSession, sf: str) -> DataFrame:
    lab = table(spark, sf, "labels").select("doc_id", F.expr(ML_RAW).alias("label"))
    return map_label(lab, "label")


# --- F1: dedup keep first ------------------------------------------------------------------------
@register("dedup_first", """
SELECT doc_id, text, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
""")
def q_dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return dedup_first(d, ["text"], ["doc_id"])


# --- F2 F3: dense row id -------------------------------------------------------------------------
@register("row_id", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS _row_id
FROM orders
""")
def q_row_id(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return with_row_id(o, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@register("row_id_by_group", """
SELECT l_orderkey, l_linenumber, l_returnflag,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1
         AS _row_id
FROM lineitem
""")
def q_row_id_by_group(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return with_row_id(li, ["l_shipdate", "l_orderkey", "l_linenumber"],
                       partition_by=["l_returnflag"]).drop("l_shipdate")


# --- F5: head ------------------------------------------------------------------------------------
@register("head", """
SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5
""")
def q_head(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return head(o, 5, ["o_orderdate", "o_orderkey"]).select("o_orderkey")


# --- A1 F7 B18: union by name of drifting frames, typed projection -------------------------------
@register("union_by_name", """
SELECT CAST(k AS STRING) AS k, CAST(price AS DOUBLE) AS price, CAST(yr AS DOUBLE) AS yr, prio
FROM (
  SELECT CAST(o_orderkey AS STRING) AS k, CAST(o_totalprice AS STRING) AS price, o_orderpriority AS prio
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL BY NAME
  SELECT CAST(year(o_orderdate) AS STRING) AS yr, CAST(o_orderkey AS STRING) AS k,
         CAST(o_totalprice AS STRING) AS price
  FROM orders WHERE o_orderstatus <> 'F')
""")
def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("k"), F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderpriority").alias("prio"))
    b = o.where(F.col("o_orderstatus") != "F").select(
        F.year("o_orderdate").cast("string").alias("yr"), F.col("o_orderkey").cast("string").alias("k"),
        F.col("o_totalprice").cast("string").alias("price"))
    u = a.unionByName(b, allowMissingColumns=True)
    return gold_projection(u, keep=["k", "prio"], doubles=["price", "yr"]).select("k", "price", "yr", "prio")


# --- B2 C1 F6: relation cleaning -----------------------------------------------------------------
CL_MEMBER = (f"CASE WHEN l_linenumber = 2 THEN {BS_N} WHEN l_linenumber = 4 THEN '' "
             "WHEN l_linenumber = 6 THEN ' ' WHEN l_linenumber = 7 THEN ' NA' "
             "ELSE CAST(l_suppkey AS STRING) END")


@register("clean_relation", f"""
SELECT DISTINCT key, member FROM (
  SELECT CAST(l_orderkey AS STRING) AS key, {sql_sentinel_exact('m')} AS member
  FROM (SELECT l_orderkey, {CL_MEMBER} AS m FROM lineitem))
WHERE key IS NOT NULL AND member IS NOT NULL
""")
def q_clean_relation(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"),
                                             F.expr(CL_MEMBER).alias("member"))
    return clean_relation(li, "key", "member", DEFAULT.sentinels)


# --- A4 D2 B17: dict-of-columns JSON documents ---------------------------------------------------
@register("relation_from_columns", """
SELECT DISTINCT CAST(l_orderkey AS STRING) AS key, CAST(l_suppkey AS STRING) AS member
FROM lineitem WHERE l_linenumber NOT IN (3, 5)
""")
def q_relation_from_columns(spark: SparkSession, sf: str) -> DataFrame:
    # Line numbers repeat within an order in this data, so the JSON index is a row-unique id; ids
    # are consecutive within a partition, so (order, id div 4) caps a document at 4 entries.
    li = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
          .sortWithinPartitions("l_orderkey")          # local sort: an order's lines get adjacent ids
          .withColumn("rid", F.monotonically_increasing_id()))
    idx = F.col("rid").cast("string")
    member = (F.when(F.col("l_linenumber") == 5, F.lit("NA"))
              .otherwise(F.col("l_suppkey").cast("string")))
    docs = (li.groupBy("l_orderkey", F.floor(F.col("rid") / 4).alias("blk"))
            .agg(F.map_from_entries(F.collect_list(F.struct(idx, F.col("l_orderkey").cast("string"))))
                 .alias("Movie "),
                 F.map_from_entries(F.collect_list(
                     F.when(F.col("l_linenumber") != 3, F.struct(idx, member)))).alias("DIRECTOR_ID"))
            .select(F.to_json(F.struct("Movie ", "DIRECTOR_ID")).alias("json")))
    return relation_from_column_docs(docs, "json", DEFAULT.key_aliases, DEFAULT.director_aliases,
                                     sentinels=DEFAULT.sentinels)


# --- A3 A5 B17: list-of-records JSON documents ---------------------------------------------------
@register("relation_from_records", """
SELECT DISTINCT CAST(l_orderkey AS STRING) AS key, CAST(l_partkey AS STRING) AS member
FROM lineitem WHERE l_linenumber NOT IN (2, 6)
""")
def q_relation_from_records(spark: SparkSession, sf: str) -> DataFrame:
    li = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
          .sortWithinPartitions("l_orderkey")
          .withColumn("rid", F.monotonically_increasing_id()))
    k = F.col("l_orderkey").cast("string")
    m = F.when(F.col("l_linenumber") == 2, F.lit("null")).otherwise(F.col("l_partkey").cast("string"))
    rec = (F.when(F.col("l_linenumber") == 6, F.create_map(F.lit("movie"), k))
           .otherwise(F.create_map(F.lit("movie"), k, F.lit(" Writer_ID"), m)))
    # at most 4 records per document whatever the key skew (ids are consecutive in a partition)
    docs = (li.groupBy("l_orderkey", F.floor(F.col("rid") / 4).alias("blk"))
            .agg(F.to_json(F.collect_list(rec)).alias("json")))
    return relation_from_record_docs(docs, "json", DEFAULT.key_aliases, DEFAULT.writer_aliases,
                                     sentinels=DEFAULT.sentinels)


# --- E1 E3: distinct-member counts, relation summary ---------------------------------------------
@register("count_members", """
SELECT l_orderkey, COUNT(DISTINCT l_suppkey) AS n_members FROM lineitem GROUP BY l_orderkey
""")
def q_count_members(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    return count_members(li, "l_orderkey", "l_suppkey", "n_members")


@register("relation_summary", """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_keys FROM lineitem
""")
def q_relation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return relation_summary(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")


# --- D1 B11: left join of per-key counts ---------------------------------------------------------
@register("join_counts", """
SELECT o_orderkey, COALESCE(d.n_directors, 0) AS n_directors, COALESCE(w.n_writers, 0) AS n_writers
FROM orders
LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(DISTINCT l_suppkey) AS n_directors
           FROM lineitem GROUP BY 1) d USING (o_orderkey)
LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(DISTINCT l_partkey) AS n_writers
           FROM lineitem GROUP BY 1) w USING (o_orderkey)
""")
def q_join_counts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_partkey")
    counts = {"n_directors": count_members(li, "o_orderkey", "l_suppkey", "n_directors"),
              "n_writers": count_members(li, "o_orderkey", "l_partkey", "n_writers")}
    return join_counts(o, "o_orderkey", counts)


# --- B7 B8 B9: log, length, bucket ---------------------------------------------------------------
@register("derived_features", """
SELECT o_orderkey, ROUND(LN(o_totalprice + 1), 6) AS log_price, CAST(LENGTH(c_name) AS BIGINT) AS len_name,
       CAST(FLOOR(CAST(year(o_orderdate) AS DOUBLE) / 10) * 10 AS DOUBLE) AS decade
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_derived_features(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                          F.year("o_orderdate").alias("yr"))
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    j = add_log(j, "o_totalprice", "log_price")
    j = add_length(j, "c_name", "len_name")
    j = add_bucket(j, "yr", "decade", 10)
    return j.select("o_orderkey", F.round("log_price", 6).alias("log_price"), "len_name", "decade")


# --- B12 B10: threshold flags and defaults -------------------------------------------------------
TF_SIZE = "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size AS STRING) END"
TF_PRICE = "CASE WHEN p_partkey % 13 = 0 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END"


@register("threshold_flags", f"""
SELECT p_partkey, big, cheap, COALESCE(big, 0) AS big_or_0, COALESCE(cheap, 0) AS cheap_or_0,
       0 AS absent_or_0
FROM (SELECT p_partkey, CAST({sql_number('s')} > 40 AS INTEGER) AS big,
             CAST({sql_number('pr')} < 950 AS INTEGER) AS cheap
      FROM (SELECT p_partkey, {TF_SIZE} AS s, {TF_PRICE} AS pr FROM part))
""")
def q_threshold_flags(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", F.expr(TF_SIZE).alias("s"), F.expr(TF_PRICE).alias("pr"))
    p = flag_threshold(p, "s", "big", ">", 40)
    p = flag_threshold(p, "pr", "cheap", "<", 950)
    p = p.withColumns({"big_or_0": F.col("big"), "cheap_or_0": F.col("cheap")})
    p = default_flags(p, ["big_or_0", "cheap_or_0", "absent_or_0"])
    return p.select("p_partkey", "big", "cheap", "big_or_0", "cheap_or_0", "absent_or_0")


# --- B13 B14 B15: text flags (ASCII columns: DuckDB's \\s and \\d are ASCII-only) -----------------
TX_ORIG = ("CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN '  ' || p_name || ' ' "
           "ELSE p_type END")
TX_NAME = ("CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '' "
           "WHEN p_partkey % 5 = 0 THEN '  ' || p_name || '   x ' ELSE p_name END")
TX_BRAND = "CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END"


@register("text_flags", f"""
SELECT p_partkey,
  CAST(orig IS NOT NULL AND (name IS NULL OR trim(name) <> trim(orig)) AS INTEGER) AS is_different,
  CAST(CASE WHEN name IS NULL THEN NULL ELSE len(regexp_extract_all(name, '[^ ]+')) END AS INTEGER)
    AS word_count,
  CAST(COALESCE(regexp_matches(brand, '[0-9]'), false) AS INTEGER) AS has_number
FROM (SELECT p_partkey, {TX_NAME} AS name, {TX_ORIG} AS orig, {TX_BRAND} AS brand FROM part)
""")
def q_text_flags(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", F.expr(TX_NAME).alias("name"),
                                        F.expr(TX_ORIG).alias("orig"), F.expr(TX_BRAND).alias("brand"))
    p = flag_differs(p, "name", "orig", "is_different")
    p = add_word_count(p, "name", "word_count")
    p = flag_matches(p, "brand", "has_number")
    return p.select("p_partkey", "is_different", "word_count", "has_number")


# --- E4 E6: exact median and per-split imputation ------------------------------------------------
DOCS_SPLIT = "CASE WHEN quality IS NULL THEN 'hidden' ELSE 'train' END"
DOCS_CHARS = "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE n_chars END"
DOCS_FROM = "documents LEFT JOIN labels USING (doc_id)"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


@register("impute_median", f"""
SELECT doc_id, split, COALESCE(x, MEDIAN(x) OVER (PARTITION BY split)) AS n_chars_imputed
FROM (SELECT doc_id, {DOCS_SPLIT} AS split, CAST({DOCS_CHARS} AS DOUBLE) AS x FROM {DOCS_FROM})
""")
def q_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", F.expr(DOCS_SPLIT).alias("split"),
                                F.expr(DOCS_CHARS).alias("n_chars_imputed"))
    return impute_median(d, "n_chars_imputed", by=["split"])


@register("median_by_group", """
SELECT l_returnflag, MEDIAN(l_extendedprice) AS median FROM lineitem GROUP BY l_returnflag
""")
def q_median_by_group(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    return exact_median(li, "l_extendedprice", ["l_returnflag"])


# --- E5 E2: profile ------------------------------------------------------------------------------
PR_COLS = {
    "c_custkey": "c_custkey",
    "c_name": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END",
    "c_nationkey": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END",
    "c_acctbal": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END",
    "c_mktsegment": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END",
}
_PR_DIRTY = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in PR_COLS.items()) + " FROM customer"
_PR_PARTS = "\nUNION ALL\n".join(
    f"SELECT 'customer' AS split, '{n}' AS \"column\", COUNT(*) AS n_rows, "
    f"COUNT(*) - COUNT({n}) AS n_missing, "
    f"round_even((COUNT(*) - COUNT({n})) / greatest(COUNT(*), 1) * 100, 2) AS pct_missing, "
    f"COUNT(DISTINCT {n}) AS n_unique FROM dirty"
    for n in PR_COLS)


@register("profile", f"""
WITH dirty AS ({_PR_DIRTY})
{_PR_PARTS}
""")
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(*[F.expr(e).alias(n) for n, e in PR_COLS.items()])
    return profile(c, "customer").drop("dtype", "ordinal")


# --- E7 E8 J7: coverage raw vs cleaned, positive counts ------------------------------------------
CV_LANG = ("CASE WHEN doc_id % 7 = 0 THEN 'NA' WHEN doc_id % 13 = 0 THEN ' null ' "
           "WHEN doc_id % 17 = 0 THEN NULL ELSE lang END")


@register("coverage", f"""
WITH raw AS (SELECT doc_id, {CV_LANG} AS lang, {DOCS_CHARS} AS n_chars, source FROM documents),
clean AS (SELECT doc_id, {sql_sentinel_trim('lang')} AS lang,
                 COALESCE(n_chars, MEDIAN(n_chars) OVER ()) AS n_chars, source FROM raw)
SELECT 'raw' AS stage, 'lang' AS "column", ROUND(COUNT(lang) * 100.0 / COUNT(*), 6) AS pct_available FROM raw
UNION ALL SELECT 'raw', 'n_chars', ROUND(COUNT(n_chars) * 100.0 / COUNT(*), 6) FROM raw
UNION ALL SELECT 'raw', 'source', ROUND(COUNT(source) * 100.0 / COUNT(*), 6) FROM raw
UNION ALL SELECT 'clean', 'lang', ROUND(COUNT(lang) * 100.0 / COUNT(*), 6) FROM clean
UNION ALL SELECT 'clean', 'n_chars', ROUND(COUNT(n_chars) * 100.0 / COUNT(*), 6) FROM clean
UNION ALL SELECT 'clean', 'source', ROUND(COUNT(source) * 100.0 / COUNT(*), 6) FROM clean
""")
def q_coverage(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "documents").select(
        "doc_id", F.expr(CV_LANG).alias("lang"), F.expr(DOCS_CHARS).alias("n_chars"), "source")
    clean = null_sentinels(raw, ["lang"], DEFAULT.sentinels)
    clean = impute_median(clean, "n_chars")
    cols = ["lang", "n_chars", "source"]
    out = coverage(raw, cols, "raw").unionByName(coverage(clean, cols, "clean"))
    return out.select("stage", "column", F.round("pct_available", 6).alias("pct_available"))


@register("label_summary", f"""
SELECT CAST(COALESCE(SUM(quality), 0) AS BIGINT) AS sum_quality,
       CAST(COALESCE(SUM(toxic), 0) AS BIGINT) AS sum_toxic
FROM {DOCS_FROM}
""")
def q_label_summary(spark: SparkSession, sf: str) -> DataFrame:
    return label_summary(_docs(spark, sf), ["quality", "toxic"])


# --- G1-G6: gate report --------------------------------------------------------------------------
GT_KEY = ("CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN CAST(o_orderkey - 1 AS STRING) "
          "ELSE CAST(o_orderkey AS STRING) END")
GT_LABEL = ("CASE WHEN o_orderkey % 107 = 0 THEN 2 WHEN o_orderkey % 109 = 0 THEN NULL "
            "WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END")
GT_YEAR = "CASE WHEN o_orderkey % 113 = 0 THEN 1700 ELSE year(o_orderdate) END"


@register("gate_report", f"""
WITH g AS (SELECT {GT_KEY} AS k, {GT_LABEL} AS label, {GT_YEAR} AS yr FROM orders)
SELECT 'orders' AS split, 'required_columns' AS gate, 0 AS ordinal, CAST(1 AS BIGINT) AS violations
UNION ALL SELECT 'orders', 'key_not_null', 1, COUNT(*) - COUNT(k) FROM g
UNION ALL SELECT 'orders', 'key_unique', 2,
  COUNT(*) - COUNT(DISTINCT k) - (CASE WHEN COUNT(*) > COUNT(k) THEN 1 ELSE 0 END) FROM g
UNION ALL SELECT 'orders', 'label_values', 3, COUNT(*) FILTER (WHERE label IS NULL OR label NOT IN (0, 1)) FROM g
UNION ALL SELECT 'orders', 'year_range', 4, COUNT(*) FILTER (WHERE yr < 1880 OR yr > 2030) FROM g
""")
def q_gate_report(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "orders").select(F.expr(GT_KEY).alias("k"), F.expr(GT_LABEL).alias("label"),
                                          F.expr(GT_YEAR).alias("yr"))
    return gate_report(g, "orders", required=["k", "label", "yr", "runtime"], key="k", label="label",
                       year="yr", lo=DEFAULT.year_min, hi=DEFAULT.year_max)


# --- J1 J2 B16 J3 J5 and the flagship J4 --------------------------------------------------------
def _num(x: str) -> str:
    return sql_number(x)


def _rng(x: str, lo: float | None, hi: float | None) -> str:
    conds = [c for c in ((f"{x} >= {lo}" if lo is not None else None),
                         (f"{x} <= {hi}" if hi is not None else None)) if c]
    return f"(CASE WHEN {' AND '.join(conds)} THEN {x} END)"


_ORD = ", ".join(ENTITY_ORDER)
_BRONZE_COLS = ("tconst", "primaryTitle", "originalTitle", "startYear", "endYear", "runtimeMinutes",
                "numVotes")
HOOKED_SQL = f"""
raw AS ({entity_bronze_sql()}),
bronze AS (SELECT {_ORD}, split, {", ".join(f"{sql_sentinel_trim(c)} AS {c}" for c in _BRONZE_COLS)}, label
           FROM raw),
s1 AS (SELECT *, strip_accents(primaryTitle) AS pt, {_num('startYear')} AS ns, {_num('endYear')} AS ne
       FROM bronze),
s2 AS (SELECT {_ORD}, split, tconst, pt AS primaryTitle, originalTitle,
         CASE WHEN ns IS NULL AND ne BETWEEN 1880 AND 2030 THEN endYear ELSE startYear END AS sy,
         CASE WHEN ns IS NULL AND ne BETWEEN 1880 AND 2030 THEN NULL ELSE endYear END AS ey,
         runtimeMinutes, numVotes, label FROM s1),
s3 AS (SELECT {_ORD}, split, tconst, primaryTitle, originalTitle,
         {_rng(_num('sy'), 1880, 2030)} AS startYear,
         {_rng(_num('ey'), 1880, 2030)} AS endYear,
         {_rng(_num('runtimeMinutes'), 1, 600)} AS runtimeMinutes,
         {_rng(_num('numVotes'), 0, None)} AS numVotes,
         CAST(CASE WHEN label IN ('True', 'true', '1') THEN 1 WHEN label IN ('False', 'false', '0') THEN 0 END
              AS INTEGER) AS label
       FROM s2),
s4 AS (SELECT * FROM s3 QUALIFY row_number() OVER (PARTITION BY split, tconst ORDER BY {_ORD}) = 1),
s5 AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {_ORD}) - 1 AS _row_id FROM s4),
h1 AS (SELECT *, COALESCE(numVotes, MEDIAN(numVotes) OVER (PARTITION BY split)) AS nv,
         CAST(runtimeMinutes > 600 AS INTEGER) AS is_long_film FROM s5),
hooked AS (SELECT split, _row_id, tconst, primaryTitle, originalTitle, startYear,
         COALESCE(runtimeMinutes, MEDIAN(runtimeMinutes) OVER (PARTITION BY split)) AS runtimeMinutes,
         nv AS numVotes, label, is_long_film,
         CAST(startYear < 1930 AS INTEGER) AS is_old_film,
         CAST(nv > 1000000 AS INTEGER) AS is_blockbuster,
         CAST(originalTitle IS NOT NULL AND (primaryTitle IS NULL OR trim(primaryTitle) <> trim(originalTitle))
              AS INTEGER) AS is_foreign_title,
         CAST(CASE WHEN primaryTitle IS NULL THEN NULL ELSE len(regexp_extract_all(primaryTitle, '[^ ]+')) END
              AS INTEGER) AS title_word_count,
         CAST(COALESCE(regexp_matches(primaryTitle, '[0-9]'), false) AS INTEGER) AS title_has_number
       FROM h1)"""


def _entity_stages(spark: SparkSession, sf: str, gates: bool = True):
    from featurepipe.plans.bindings import entity_bronze_raw, entity_relations
    from featurepipe.plans.build import build_frames
    return build_frames(entity_bronze_raw(spark, sf), entity_relations(spark, sf), list(ENTITY_ORDER),
                        DEFAULT, split_col="split", gates=gates)


@register("hooks_chain", f"""
WITH {HOOKED_SQL}
SELECT * FROM hooked
""")
def q_hooks_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_stages(spark, sf, gates=False).hooked


_FLAGS_SQL = ",\n  ".join(f"COALESCE({f}, 0) AS {f}" for f in DEFAULT.flags)


@register("gold_features", f"""
WITH {HOOKED_SQL},
d AS (SELECT key, COUNT(DISTINCT member) AS n_directors FROM
        (SELECT 'tt' || CAST(l_orderkey AS STRING) AS key, CAST(l_suppkey AS STRING) AS member FROM lineitem)
      GROUP BY key),
w AS (SELECT key, COUNT(DISTINCT member) AS n_writers FROM
        (SELECT 'tt' || CAST(l_orderkey AS STRING) AS key, CAST(l_partkey AS STRING) AS member FROM lineitem)
      GROUP BY key)
SELECT split, _row_id, tconst, primaryTitle, originalTitle, startYear, runtimeMinutes, numVotes, label,
  CAST(COALESCE(d.n_directors, 0) AS BIGINT) AS n_directors, CAST(COALESCE(w.n_writers, 0) AS BIGINT) AS n_writers,
  ROUND(LN(numVotes + 1), 6) AS log_numVotes, CAST(LENGTH(primaryTitle) AS BIGINT) AS len_primaryTitle,
  FLOOR(startYear / 10) * 10 AS decade,
  {_FLAGS_SQL}
FROM hooked LEFT JOIN d ON hooked.tconst = d.key LEFT JOIN w ON hooked.tconst = w.key
""")
def q_gold_features(spark: SparkSession, sf: str) -> DataFrame:
    gold = _entity_stages(spark, sf).gold
    return gold.withColumn("log_numVotes", F.round("log_numVotes", 6))


# --- I1 I2: exact-median imputer + population scaler fitted on train ----------------------------
@register("standardize", f"""
WITH d AS (SELECT doc_id, {DOCS_SPLIT} AS split, CAST({DOCS_CHARS} AS DOUBLE) AS x FROM {DOCS_FROM}),
m AS (SELECT MEDIAN(x) AS med FROM d WHERE split = 'train'),
i AS (SELECT doc_id, split, COALESCE(x, med) AS xi FROM d, m),
st AS (SELECT AVG(xi) AS mu, STDDEV_POP(xi) AS sd FROM i WHERE split = 'train')
SELECT doc_id, ROUND((xi - mu) / (CASE WHEN sd = 0 OR sd IS NULL THEN 1 ELSE sd END), 6) AS z FROM i, st
""")
def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.operators.model import fit_preprocess
    d = _docs(spark, sf).select("doc_id", F.expr(DOCS_SPLIT).alias("split"),
                                F.expr(DOCS_CHARS).cast("double").alias("z"))
    pre = fit_preprocess(d.where(F.col("split") == "train"), ["z"])
    return pre.transform(d).select("doc_id", F.round("z", 6).alias("z"))


# --- I4: stratified folds ------------------------------------------------------------------------
@register("stratified_folds", """
WITH cls AS (SELECT quality, MIN(doc_id) AS first, COUNT(*) AS n FROM labels GROUP BY quality),
c2 AS (SELECT quality, n, COALESCE(SUM(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS o FROM cls),
sz AS (SELECT quality,
         n // 5 + CASE WHEN ((0 - o) % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS s0,
         n // 5 + CASE WHEN ((1 - o) % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS s1,
         n // 5 + CASE WHEN ((2 - o) % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS s2,
         n // 5 + CASE WHEN ((3 - o) % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS s3 FROM c2),
r AS (SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS r FROM labels)
SELECT doc_id, quality, toxic,
  CAST(r >= s0 AS INTEGER) + CAST(r >= s0 + s1 AS INTEGER) + CAST(r >= s0 + s1 + s2 AS INTEGER)
  + CAST(r >= s0 + s1 + s2 + s3 AS INTEGER) AS fold
FROM r JOIN sz USING (quality)
""")
def q_stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.operators.model import stratified_folds
    return stratified_folds(table(spark, sf, "labels"), "quality", ["doc_id"], 5)


# --- I3 I5 I6 I7 I8 I9 A9 B19: closed-form candidates, CV, best, refit, predict, importances -----
def _trained(spark: SparkSession, sf: str):
    """The whole protocol: folds, scores, best candidate, refit, predictions, importances."""
    from featurepipe.operators.model import closed_form_candidates
    from featurepipe.plans.bindings import DOC_FEATURES, doc_features
    from featurepipe.plans.train import train_and_predict
    docs = doc_features(spark, sf).persist()
    train = docs.where(F.col("split") == "train").drop("split")
    hidden = {"hidden": doc_features(spark, sf).where(F.col("split") == "hidden").drop("split", "label")}
    out = train_and_predict(train, hidden, DOC_FEATURES, "label", ["doc_id"], make=lambda _n: closed_form_candidates("label"))
    docs.unpersist()
    return out


def _model_sql() -> str:
    """CTEs of the whole protocol: fits 0-4 leave one fold out, fit 5 sees all labelled rows."""
    from featurepipe.plans.bindings import DOC_FEATURES
    feats = list(DOC_FEATURES)
    fold = ORACLES["stratified_folds"]
    med = ", ".join(f"median({f}) AS med_{f}" for f in feats)
    imp = ", ".join(f"coalesce({f}, med_{f}) AS {f}" for f in feats)
    mom = ", ".join(f"avg({f}) AS mu_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS sd_{f}" for f in feats)
    z = ", ".join(f"({f} - mu_{f}) / sd_{f} AS {f}" for f in feats)
    cls = ", ".join(f"avg({f}) AS m_{f}" for f in feats)
    away = " + ".join(f"(z.{f} - c.m_{f}) * (z.{f} - c.m_{f})" for f in feats)
    return f"""
x AS (SELECT doc_id, quality AS label, CAST(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE n_chars END AS DOUBLE) AS n_chars,
        ln(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE n_chars END + 1) AS log_chars, length(text)::DOUBLE AS len_text,
        len(regexp_extract_all(text, '\\S+'))::DOUBLE AS word_count, regexp_matches(text, '[0-9]')::INT::DOUBLE AS has_number,
        (lang = 'en')::INT::DOUBLE AS is_en FROM documents LEFT JOIN labels USING (doc_id)),
t AS (SELECT x.*, f.fold FROM x JOIN ({fold}) f ON f.doc_id = x.doc_id),
runs AS (SELECT unnest(range(6)) AS run),
fit AS (SELECT run, t.* FROM t, runs WHERE fold <> run),
med AS (SELECT run, {med} FROM fit GROUP BY run),
a AS (SELECT run, doc_id, label, fold, {imp} FROM med, (SELECT doc_id, label, fold, {", ".join(feats)} FROM t
      UNION ALL SELECT doc_id, label, NULL, {", ".join(feats)} FROM x WHERE label IS NULL)),
mom AS (SELECT run, {mom} FROM a WHERE fold <> run GROUP BY run),
z AS (SELECT a.run, doc_id, label, fold, {z} FROM a JOIN mom ON mom.run = a.run),
c AS (SELECT run, label, count(*) AS n, {cls} FROM z WHERE fold <> run GROUP BY run, label),
near AS (SELECT z.run, z.doc_id, z.label, z.fold, arg_min(c.label, {{'d': {away}, 'l': c.label}}) AS pred
         FROM z JOIN c ON c.run = z.run GROUP BY ALL),
most AS (SELECT run, arg_max(label, {{'n': n, 'l': -label}}) AS pred FROM c GROUP BY run),
p AS (SELECT 'Nearest class mean' AS model, 1 AS ordinal, run, doc_id, label, fold, pred FROM near
      UNION ALL SELECT 'Majority class', 0, z.run, doc_id, label, fold, most.pred FROM z JOIN most ON most.run = z.run),
acc AS (SELECT model, ordinal, run, avg((pred = label)::INT) AS a FROM p WHERE (run = 5 AND fold IS NOT NULL) OR fold = run GROUP BY ALL),
scores AS (SELECT model, ordinal::INTEGER AS ordinal, max(a) FILTER (run = 5) AS train_acc, avg(a) FILTER (run < 5) AS cv_mean,
                  stddev_pop(a) FILTER (run < 5) AS cv_std FROM acc GROUP BY ALL),
best AS (SELECT model FROM scores ORDER BY cv_mean DESC, ordinal LIMIT 1)"""


@register("cv_scores", f"""
WITH {_model_sql()}
SELECT model, ordinal, round(train_acc, 6) AS train_acc, round(cv_mean, 6) AS cv_mean, round(cv_std, 6) AS cv_std,
       model = (SELECT model FROM best) AS best FROM scores
""")
def q_cv_scores(spark: SparkSession, sf: str) -> DataFrame:
    res = _trained(spark, sf)
    return res.scores.select("model", "ordinal", *[F.round(c, 6).alias(c) for c in ("train_acc", "cv_mean", "cv_std")],
                             (F.col("model") == res.best).alias("best"))


def _importance_sql() -> str:
    from featurepipe.plans.bindings import DOC_FEATURES
    rows = " UNION ALL ".join(
        f"SELECT {i} AS o, '{f}' AS feature, abs(max(m_{f}) FILTER (label = 1) - max(m_{f}) FILTER (label = 0)) AS v FROM c WHERE run = 5"
        for i, f in enumerate(DOC_FEATURES))
    return f"""SELECT feature, round(v, 6) AS importance, row_number() OVER (ORDER BY v DESC, o)::INTEGER AS rank
FROM (SELECT o, feature, CASE WHEN (SELECT model FROM best) = 'Majority class' THEN 0.0 ELSE v END AS v FROM ({rows}))"""


@register("importances", f"""
WITH {_model_sql()}
{_importance_sql()}
""")
def q_importances(spark: SparkSession, sf: str) -> DataFrame:
    return _trained(spark, sf).importances.select("feature", F.round("importance", 6).alias("importance"), "rank")


@register("fit_predict", f"""
WITH {_model_sql()}
SELECT doc_id, CASE WHEN pred = 1 THEN 'True' ELSE 'False' END AS prediction
FROM p WHERE run = 5 AND fold IS NULL AND model = (SELECT model FROM best)
""")
def q_fit_predict(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources.sinks import prediction_text
    pred = _trained(spark, sf).predictions["hidden"]
    return pred.select("doc_id", prediction_text(F.col("prediction")).alias("prediction"))


# --- file-based queries: shards written under the checkpoint folder, read by the real readers ----
def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "featurepipe", f"{name}-{uuid.uuid4().hex}")


def _write_lines(lines: DataFrame, header: str | None, path: str) -> None:
    """Text files of the column ``value``, each beginning with ``header``."""
    if header is not None:
        def headed(batches):
            import pyarrow as pa
            yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])
        lines = lines.select("value").mapInArrow(headed, "value string")
    lines.write.text(path)


CSV_TITLE = """'Say "' || o_orderpriority || ', now" (' || o_orderstatus || ')'"""
CSV_PRICE = f"CASE WHEN o_orderkey % 6 = 0 THEN {BS_N} ELSE CAST(o_totalprice AS STRING) END"


# Strict union by name of shards with three header orders and a missing column
@register("csv_union_files", f"""
SELECT CAST(o_orderkey AS STRING) AS k, {CSV_TITLE} AS "the title",
       CASE WHEN o_orderstatus <> 'P' THEN {CSV_PRICE} END AS price,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS prio
FROM orders
""")
def q_csv_union_files(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import read_csv_union
    base = _scratch(spark, "csv-union")
    o = table(spark, sf, "orders")
    quoted = F.concat(F.lit('"'), F.replace(F.expr(CSV_TITLE), F.lit('"'), F.lit('""')), F.lit('"'))
    k, price = F.col("o_orderkey").cast("string"), F.expr(CSV_PRICE)
    shards = {"F": ('k,"the title",price,prio', [k, quoted, price, F.col("o_orderpriority")]),
              "O": ('price,k,"the title"', [price, k, quoted]), "P": ('"the title",k', [quoted, k])}
    for status, (header, cols) in shards.items():
        _write_lines(o.where(F.col("o_orderstatus") == status).select(F.concat_ws(",", *cols).alias("value")), header, f"{base}/{status}")
    return read_csv_union(spark, f"{base}/*/part-*", ["k", "the title", "price", "prio"]).select("k", "the title", "price", "prio")


# A2: tolerant scan, rows with a surplus or a missing field go and are listed
@register("csv_tolerant_files", f"""
SELECT 'kept' AS what, CAST(o_orderkey AS STRING) AS k, {CSV_TITLE} AS title FROM orders WHERE o_orderkey % 10 NOT IN (3, 7)
UNION ALL SELECT 'rejected', CAST(o_orderkey AS STRING), NULL FROM orders WHERE o_orderkey % 10 IN (3, 7)
""")
def q_csv_tolerant_files(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import read_csv_tolerant
    base = _scratch(spark, "csv-tolerant")
    o = table(spark, sf, "orders")
    quoted = F.concat(F.lit('"'), F.replace(F.expr(CSV_TITLE), F.lit('"'), F.lit('""')), F.lit('"'))
    k, last = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 10
    line = F.when(last == 3, F.concat(k, F.lit(",a,b,c,d"))).when(last == 7, k).otherwise(F.concat_ws(",", k, quoted, F.lit("x")))
    _write_lines(o.select(line.alias("value")), "k,title,z", base)
    rows, rejects = read_csv_tolerant(spark, f"{base}/part-*", ["k", "title"])
    gone = rejects.select(F.lit("rejected").alias("what"), F.split("record", ",")[0].alias("k"), F.lit(None).cast("string").alias("title"))
    return rows.select(F.lit("kept").alias("what"), "k", "title").unionByName(gone)


# A1 A2: line breaks inside quotes, in rows that stay and in rows that go; two header orders
CSV_BROKEN = "NULLIF(REPLACE(text, ' a', chr(10) || 'a'), '')"


@register("csv_quoted_breaks", f"""
SELECT 'kept' AS what, CAST(doc_id AS STRING) AS k, NULLIF(lang, '') AS lang, md5({CSV_BROKEN}) AS text_md5,
       CAST(length({CSV_BROKEN}) AS BIGINT) AS n_chars
FROM documents WHERE doc_id % 10 <> 3
UNION ALL SELECT 'rejected', CAST(doc_id AS STRING), NULL, NULL, CAST(length({CSV_BROKEN}) AS BIGINT) FROM documents WHERE doc_id % 10 = 3
""")
def q_csv_quoted_breaks(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import read_csv_tolerant
    base = _scratch(spark, "csv-breaks")
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.coalesce(F.expr(CSV_BROKEN), F.lit("")).alias("text"))
    k, lang = F.col("doc_id").cast("string"), F.coalesce("lang", F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    for odd, header, cols in ((0, 'k,"the\ntext",lang', [k, quoted, lang]), (1, 'lang,k,"the\ntext"', [lang, k, quoted])):
        line = F.when(F.col("doc_id") % 10 == 3, F.concat_ws(",", k, quoted, F.length("text"), F.lit("x"), F.lit("y"))).otherwise(F.concat_ws(",", *cols))
        _write_lines(docs.where(F.pmod("doc_id", F.lit(2)) == odd).select(line.alias("value")), header, f"{base}/{odd}")
    rows, rejects = read_csv_tolerant(spark, f"{base}/*/part-*", ["k", "lang", "the\ntext"])
    text, none = F.col("the\ntext"), F.lit(None).cast("string")
    gone = rejects.select(F.lit("rejected").alias("what"), F.split("record", ",")[0].alias("k"), none.alias("lang"), none.alias("text_md5"),
                          F.nullif(F.regexp_extract("record", r",(\d+),x,y\z", 1).cast("long"), F.lit(0)).alias("n_chars"))
    return rows.select(F.lit("kept").alias("what"), "k", "lang", F.md5(text).alias("text_md5"),
                       F.length(text).cast("long").alias("n_chars")).unionByName(gone)


# Files of all three shapes through the reader
@register("relation_files", """
SELECT DISTINCT CASE WHEN l_returnflag = 'A' THEN 'columns' WHEN l_returnflag = 'N' THEN 'records' ELSE 'lines' END AS shape,
       CAST(l_orderkey AS STRING) AS key, CAST(l_suppkey AS STRING) AS member
FROM lineitem WHERE l_linenumber NOT IN (3, 5)
""")
def q_relation_files(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import read_relation
    base = _scratch(spark, "relations")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                                             F.monotonically_increasing_id().alias("rid"))
    files = F.pmod(F.xxhash64("l_orderkey", "rid"), F.lit(li.count() // 20_000 + 1)).alias("file")   # bounds a document
    k = F.col("l_orderkey").cast("string")
    m = F.when(F.col("l_linenumber") == 5, "NA").otherwise(F.col("l_suppkey").cast("string"))
    idx = F.col("rid").cast("string")
    columns = (li.where("l_returnflag = 'A'").groupBy(files).agg(
        F.map_from_entries(F.collect_list(F.struct(idx, k))).alias(" Movie"),
        F.map_from_entries(F.collect_list(F.when(F.col("l_linenumber") != 3, F.struct(idx, m)))).alias("DIRECTOR_ID"))
        .select("file", F.to_json(F.struct(" Movie", "DIRECTOR_ID")).alias("value")))
    rec = F.when(F.col("l_linenumber") == 3, F.create_map(F.lit("tconst"), k)).otherwise(F.create_map(F.lit("tconst"), k, F.lit("Director "), m))
    records = li.where("l_returnflag = 'N'").groupBy(files).agg(F.to_json(F.collect_list(rec)).alias("value"))
    columns.write.partitionBy("file").text(f"{base}/columns")
    records.write.partitionBy("file").text(f"{base}/records")
    _write_lines(li.where("l_returnflag = 'R'").select(F.to_json(rec).alias("value")), None, f"{base}/lines")
    parts = []
    for shape, asked in (("columns", "auto"), ("records", "records"), ("lines", "lines")):
        got = read_relation(spark, f"{base}/{shape}", DEFAULT.key_aliases, DEFAULT.director_aliases, shape=asked)
        parts.append(got.select(F.lit(shape).alias("shape"), "key", "member"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- E4: both ways of the exact median, with a NULL group ----------------------------------------
MN_GROUP = "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END"


@register("median_null_group", f"""
SELECT way, g, MEDIAN(n_chars) AS median
FROM (SELECT {MN_GROUP} AS g, n_chars FROM documents), (SELECT unnest(['buffer', 'narrowed']) AS way) GROUP BY way, g
""")
def q_median_null_group(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.expr(MN_GROUP).alias("g"), "n_chars")
    return (exact_median(d, "n_chars", ["g"]).withColumn("way", F.lit("buffer"))
            .unionByName(exact_median(d, "n_chars", ["g"], cap=40).withColumn("way", F.lit("narrowed"))))


# --- E5 on all rows and on an empty split beside them --------------------------------------------
@register("profile_empty", """
WITH c AS (SELECT 'all' AS split, c_custkey, c_name, c_acctbal FROM customer),
s AS (SELECT unnest(['all', 'none']) AS split)
SELECT s.split, v."column", v.dtype, COUNT(c.split) AS n_rows, 0::BIGINT AS n_missing, 0.0::DOUBLE AS pct_missing,
  CASE v."column" WHEN 'c_custkey' THEN COUNT(DISTINCT c_custkey) WHEN 'c_name' THEN COUNT(DISTINCT c_name) ELSE COUNT(DISTINCT c_acctbal) END AS n_unique
FROM s CROSS JOIN (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_acctbal', 'double')) v("column", dtype) LEFT JOIN c ON c.split = s.split
GROUP BY 1, 2, 3
""")
def q_profile_empty(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    both = profile(c, "all").unionByName(profile(c.where(F.lit(False)), "none"))
    return both.drop("ordinal")


# --- J7: stage comparison ------------------------------------------------------------------------
@register("compare_stages", f"""
WITH raw AS (SELECT doc_id, text, {CV_LANG} AS lang FROM documents),
clean AS (SELECT doc_id, text, {sql_sentinel_trim('lang')} AS lang FROM raw),
top AS (SELECT text AS dirty, strip_accents(text) AS clean, doc_id FROM raw WHERE text <> strip_accents(text)
        ORDER BY text DESC, doc_id DESC LIMIT 5)
SELECT 'title' AS section, CAST(row_number() OVER (ORDER BY dirty, doc_id) AS INTEGER) AS place, dirty AS a, clean AS b,
       CAST(NULL AS DOUBLE) AS pct FROM top
UNION ALL SELECT 'coverage', 1, 'raw', 'lang', ROUND(COUNT(lang) * 100.0 / COUNT(*), 6) FROM raw
UNION ALL SELECT 'coverage', 1, 'clean', 'lang', ROUND(COUNT(lang) * 100.0 / COUNT(*), 6) FROM clean
""")
def q_compare_stages(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.plans.compare import compare_stages
    raw = table(spark, sf, "documents").select("doc_id", "text", F.expr(CV_LANG).alias("lang"))
    clean = null_sentinels(raw, ["lang"], DEFAULT.sentinels)
    pairs, cov = compare_stages(raw, clean, "text", ["lang"], k=5, tiebreak=["doc_id"], keep=["doc_id"])
    titles = pairs.select(F.lit("title").alias("section"), F.row_number().over(Window.orderBy("dirty", "doc_id")).alias("place"),
                          F.col("dirty").alias("a"), F.col("clean").alias("b"), F.lit(None).cast("double").alias("pct"))
    return titles.unionByName(cov.select(F.lit("coverage").alias("section"), F.lit(1).alias("place"), F.col("stage").alias("a"),
                                         F.col("column").alias("b"), F.round("pct_available", 6).alias("pct")))


# --- G6: the first failing gate ------------------------------------------------------------------
@register("gate_failure", f"""
WITH g AS (SELECT {GT_KEY} AS k FROM orders)
SELECT 'orders' AS split, 'key_not_null' AS gate, 1 AS ordinal, COUNT(*) - COUNT(k) AS violations FROM g
""")
def q_gate_failure(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.operators.gates import first_failure
    g = table(spark, sf, "orders").select(F.expr(GT_KEY).alias("k"), F.expr(GT_LABEL).alias("label"), F.expr(GT_YEAR).alias("yr"))
    return first_failure(gate_report(g, "orders", required=["k", "label"], key="k", label="label", year="yr",
                                     lo=DEFAULT.year_min, hi=DEFAULT.year_max))


# --- J2: hook audit ------------------------------------------------------------------------------
@register("hook_audit", """
SELECT 'drop_pending' AS hook, 'all' AS split, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS rows_dropped, '' AS cols_added FROM orders
UNION ALL SELECT 'add_year', 'all', 0, 'half,yr'
UNION ALL SELECT 'keep_cheap', 'all', COUNT(*) FILTER (WHERE o_totalprice >= 100000), '' FROM orders WHERE o_orderstatus <> 'P'
""")
def q_hook_audit(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.operators import HookRegistry
    reg = HookRegistry(audited=True)
    reg.register(lambda d: d.where("o_orderstatus <> 'P'"), "drop_pending")
    reg.register(lambda d: d.withColumns({"yr": F.year("o_orderdate"), "half": F.quarter("o_orderdate")}), "add_year")
    reg.register(lambda d: d.where("o_totalprice < 100000"), "keep_cheap")
    reg.apply(table(spark, sf, "orders"))
    return reg.audit(spark).withColumn("cols_added", F.array_join("cols_added", ","))


# --- A6 A8: stages written and read back in both formats -----------------------------------------
@register("stage_round_trip", f"""
SELECT fmt, o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, {CSV_TITLE} AS title
FROM orders, (SELECT unnest(['csv', 'parquet']) AS fmt)
""")
def q_stage_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import read_stage, write_stage
    base = _scratch(spark, "stage")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"), F.expr(CSV_TITLE).alias("title"))
    parts = []
    for fmt in ("csv", "parquet"):
        write_stage(o, f"{base}/{fmt}", fmt, order_by="o_orderkey")
        parts.append(read_stage(spark, f"{base}/{fmt}", fmt, schema="o_orderkey bigint, price double, title string").withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


# --- I3: the first tree of both boosters, with all its gains --------------------------------------
BOOST_FEATURES = {
    "len": "CAST(floor(least(length(text), 4000) / 100) AS DOUBLE)",
    "chars": "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE CAST(floor(least(n_chars, 8000) / 250) AS DOUBLE) END",
    "lang": "CAST(CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS DOUBLE)",
    "source": "CAST(length(source) AS DOUBLE)",
}


def _tree_sql(depth: int, l2: float, min_hessian: float, min_rows: int) -> str:
    """Levels of one tree: every cut of every feature of every node, both ways for missing values."""
    names = list(BOOST_FEATURES)
    unit = 1 << 30

    def worth(g: str, h: str) -> str:
        return f"({g} / {unit}.0) * ({g} / {unit}.0) / ({h} / {unit}.0 + {l2})"

    out = [f"""WITH r AS (SELECT doc_id, quality AS y, {", ".join(f"{e} AS {n}" for n, e in BOOST_FEATURES.items())}
  FROM documents JOIN labels USING (doc_id)),
b AS (SELECT ln(SUM(y) / (COUNT(*) - SUM(y))) AS s FROM r),
r0 AS (SELECT r.*, 0 AS node, CAST(round((1 / (1 + exp(-s)) - y) * {unit}) AS BIGINT) AS g,
  CAST(round((1 / (1 + exp(-s))) * (1 - 1 / (1 + exp(-s))) * {unit}) AS BIGINT) AS h FROM r, b),
vals AS ({" UNION ALL ".join(f"SELECT DISTINCT {i} AS f, {n} AS v FROM r WHERE {n} IS NOT NULL" for i, n in enumerate(names))}),
cuts AS (SELECT f, v, v + (lead(v) OVER (PARTITION BY f ORDER BY v) - v) / 2 AS threshold FROM vals)"""]
    for d in range(depth + 1):
        out.append(f"t{d} AS (SELECT node, SUM(g)::BIGINT AS g, SUM(h)::BIGINT AS h, COUNT(*) AS n FROM r{d} GROUP BY node)")
        if d == depth:
            break
        out.append(f"c{d} AS ({' UNION ALL '.join(f'SELECT node, g, h, {i} AS f, {n} AS v FROM r{d}' for i, n in enumerate(names))})")
        out.append(f"m{d} AS (SELECT node, f, SUM(g)::BIGINT AS mg, SUM(h)::BIGINT AS mh, COUNT(*) AS mn FROM c{d} WHERE v IS NULL GROUP BY node, f)")
        out.append(f"l{d} AS (SELECT t.node, k.f, k.v, k.threshold, COALESCE(SUM(c.g), 0)::BIGINT AS lg, COALESCE(SUM(c.h), 0)::BIGINT AS lh, COUNT(c.g) AS ln "
                   f"FROM t{d} t CROSS JOIN cuts k LEFT JOIN c{d} c ON c.node = t.node AND c.f = k.f AND c.v <= k.v GROUP BY ALL)")
        out.append(f"w{d} AS (SELECT l.node, l.f, l.v, l.threshold, w.way, t.g, t.h, t.n, lg + w.way * COALESCE(mg, 0) AS lg, lh + w.way * COALESCE(mh, 0) AS lh, "
                   f"ln + w.way * COALESCE(mn, 0) AS ln FROM l{d} l JOIN t{d} t ON t.node = l.node LEFT JOIN m{d} m ON m.node = l.node AND m.f = l.f, "
                   f"(SELECT unnest([0, 1]) AS way) w)")
        out.append(f"""s{d} AS (SELECT node, f, v, threshold, way, gain FROM (
  SELECT *, 0.5 * ({worth('lg', 'lh')} + {worth('(g - lg)', '(h - lh)')} - {worth('g', 'h')}) AS gain FROM w{d}
  WHERE least(lh, h - lh) >= {min_hessian} * {unit} AND least(ln, n - ln) >= {min_rows}) WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v, way) = 1)""")
        value = "CASE s.f " + " ".join(f"WHEN {i} THEN r.{n}" for i, n in enumerate(names)) + " END"
        out.append(f"r{d + 1} AS (SELECT r.* REPLACE (2 * r.node + CASE WHEN CASE WHEN {value} IS NULL THEN s.way = 1 ELSE {value} <= s.v END THEN 1 ELSE 2 END AS node) "
                   f"FROM r{d} r JOIN s{d} s ON s.node = r.node)")
    feature = "CASE s.f " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
    rows = []
    for d in range(depth + 1):
        value = f"round(-(t.g / {unit}.0) / (t.h / {unit}.0 + {l2}), 6) AS value"
        if d < depth:
            rows.append(f"SELECT t.node::INTEGER AS node, {d} AS depth, {feature} AS feature, round(s.threshold, 6) AS threshold, s.way = 1 AS missing_left, "
                        f"round(s.gain, 6) AS gain, t.n AS n_rows, {value} FROM t{d} t LEFT JOIN s{d} s ON s.node = t.node")
        else:
            rows.append(f"SELECT t.node::INTEGER, {d}, NULL, NULL, NULL, NULL, t.n, {value} FROM t{d} t")
    return ",\n".join(out) + "\n" + "\nUNION ALL ".join(rows)


@register("booster_splits", _tree_sql(3, 1.0, 1.0, 1))
def q_booster_splits(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.operators.boosting import GrowthRules, split_report
    d = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    d = d.select("quality", *[F.expr(e).alias(n) for n, e in BOOST_FEATURES.items()])
    rep = split_report(d, list(BOOST_FEATURES), "quality", GrowthRules("level", depth=3))
    return rep.withColumns({"threshold": F.when(F.col("threshold") != float("inf"), F.round("threshold", 6)),
                            "gain": F.round("gain", 6), "value": F.round("value", 6)})


# --- A7: profile files read back ------------------------------------------------------------------
@register("profile_sink", f"""
WITH dirty AS ({_PR_DIRTY}), p AS ({_PR_PARTS})
SELECT p.*, CASE WHEN "column" = 'c_custkey' THEN 'bigint' WHEN "column" = 'c_nationkey' THEN 'int' WHEN "column" = 'c_acctbal' THEN 'double' ELSE 'string' END AS dtype,
       list_position([{", ".join(f"'{n}'" for n in PR_COLS)}], "column")::BIGINT - 1 AS line FROM p
""")
def q_profile_sink(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import write_profile
    path = _scratch(spark, "profile")
    c = table(spark, sf, "customer").select(*[F.expr(e).alias(n) for n, e in PR_COLS.items()])
    write_profile(profile(c, "customer"), path)
    back = spark.read.option("header", True).option("escape", '"').schema(
        "split string, column string, n_rows long, n_missing long, pct_missing double, n_unique long, dtype string").csv(path)
    return with_row_id(back.withColumn("_at", F.monotonically_increasing_id()), ["_at"], "line").drop("_at")   # one file: its order


# --- F3 A6: rows of a written stage lie in order ----------------------------------------------------
@register("stage_order", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS line FROM orders
""")
def q_stage_order(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import write_stage
    path = _scratch(spark, "stage-order")
    write_stage(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), path, "csv", order_by=["o_orderdate", "o_orderkey"], drop=["o_orderdate"])
    back = spark.read.option("header", True).schema("o_orderkey bigint").csv(path)
    back = back.select("o_orderkey", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"))
    return with_row_id(back, ["_file", "_block", "_at"], "line").select("o_orderkey", "line")


# --- J6 A9 A10: training run's files: the joined submission and the report ----------------------------
@register("train_files", f"""
WITH {_model_sql()},
imp AS ({_importance_sql()}),
acc1 AS (SELECT train_acc, model FROM scores WHERE model = (SELECT model FROM best))
SELECT 'predictions' AS file, row_number() OVER (ORDER BY doc_id) - 1 AS line, CASE WHEN pred = 1 THEN 'True' ELSE 'False' END AS value
FROM p WHERE run = 5 AND fold IS NULL AND model = (SELECT model FROM best)
UNION ALL SELECT 'report', 0, 'Best model: ' || model FROM acc1
UNION ALL SELECT 'report', 1, 'Train accuracy: ' || printf('%.4f', train_acc) FROM acc1
UNION ALL SELECT 'report', 2, ''
UNION ALL SELECT 'report', 3, 'Feature importances:'
UNION ALL SELECT 'report', 3 + rank, '  ' || rpad(feature, 25, ' ') || ' ' || printf('%.4f', importance) FROM imp
""")
def q_train_files(spark: SparkSession, sf: str) -> DataFrame:
    from featurepipe.sources import model_report, write_predictions, write_report
    base = _scratch(spark, "train")
    res = _trained(spark, sf)
    write_predictions(res.predictions["hidden"], "doc_id", f"{base}/parts", single_file=f"{base}/predictions/hidden.txt")
    write_report(model_report(spark, res.report_lines()), f"{base}/report")
    out = []
    for name in ("predictions", "report"):
        lines = spark.read.text(f"{base}/{name}").select("value", F.col("_metadata.file_block_start").alias("_block"),
                                                         F.monotonically_increasing_id().alias("_at"))
        out.append(with_row_id(lines, ["_block", "_at"], "line").select(F.lit(name).alias("file"), "line", "value"))
    return out[0].unionByName(out[1])
