"""The registered queries ``opN_<name>`` of the text operators and their DuckDB twins.

Every query applies its operator with production parameters to its whole table and returns the
full result; what operators left in the shared folder on the way is deleted when that is written. ``ORACLES`` holds SQL where SQL can express the operator on whole tables.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm.chat import format_chats
from featurepipe.llm.common import ASCII_LOWER, ASCII_UPPER
from featurepipe.llm.decontam import contamination
from featurepipe.llm.edits import recount_contacts
from featurepipe.llm.langid import held_out, predict_language, train_language_id
from featurepipe.llm.linededup import dedup_lines
from featurepipe.llm.maintext import extract_text, train_extractor
from featurepipe.llm.neardup import near_duplicates
from featurepipe.llm.periodic import collapse_runs
from featurepipe.llm.pieces import encode_pieces
from featurepipe.llm.repetition import RepetitionRules, repetition_report
from featurepipe.llm.tokenfiles import read_token_files, write_token_files
from featurepipe.llm.urlfilter import filter_urls
from featurepipe.llm.variants import group_variants, word_counts
from featurepipe.session import checkpoint_dir, keep_until_release, only_result

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPACED = r"'[^\x20\x09-\x0D]+'"


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _sql_lower(text: str) -> str:
    return f"translate({text}, '{ASCII_UPPER}', '{ASCII_LOWER}')"


@_query("op1_near_dedup", f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({_sql_lower("coalesce(text, '')")}, {_SPACED}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
          ELSE list_transform(range(1, len(ws) - 2),
               lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
      FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * common >= 80 * (na.n + nb.n - common)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION
                     SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
LEFT JOIN n ON n.doc_id = d.doc_id
""")
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over all documents: 4-word shingles, 80 percent."""
    return only_result(spark, lambda: near_duplicates(_documents(spark, sf_dir), width=4), "op1")


@_query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written in Huffman-coded files and read back from them."""
    def files() -> DataFrame:
        path = os.path.join(checkpoint_dir(spark), "featurepipe", f"token-files-{uuid.uuid4().hex}")
        write_token_files(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
        keep_until_release(spark, path)
        return read_token_files(spark, path, as_bytes=True).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return only_result(spark, files, "op2")


@_query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents from a network trained on those that are not held out."""
    docs = _documents(spark, sf_dir)
    net = train_language_id(docs.where("doc_id IS NOT NULL").where(~held_out()))
    return predict_language(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query("op4_chat", r"""
WITH d AS (
    SELECT conv_id, turn, role, text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '\r?\n'), lambda x: NOT regexp_matches(x, '^[ \t]*>')) AS own,
           len(regexp_split_to_array(coalesce(text, ''), '\r?\n')) AS n FROM conversations)
SELECT conv_id, turn, role, regexp_replace(array_to_string(own, chr(10)), '^([ \t]*\n)+|(\n[ \t]*)+$', '', 'g') AS text,
       n - len(own) AS n_quoted, CAST(NULL AS BIGINT) AS parent_turn, turn AS root_turn,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS place
FROM d
""")
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes (the twin covers tables whose quotes link nothing)."""
    return only_result(spark, lambda: format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "op4")


@_query("op5_edit_counts")
def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after contact data is replaced."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    edited = recount_contacts(_documents(spark, sf_dir), ranks, pattern)
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded", F.length("text").cast("long").alias("n_chars"))


_SQL_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@_query("op6_line_dedup", f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, {_sql_lower(f"trim(line, {_SQL_SPACE})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, coalesce(f.first < k.doc_id, false) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that another document holds already are dropped, over all documents."""
    return only_result(spark, lambda: dedup_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")), "op6")


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def _sql_rule(host: str, path: str) -> str:
    ordered = sorted(URL_RULES, key=lambda r: -len(r[1]))
    return "CASE " + " ".join(
        f"WHEN ({host} = '{r.partition('/')[0]}' OR ends_with({host}, '.{r.partition('/')[0]}')) "
        f"AND starts_with({path}, '/{r.partition('/')[2]}') THEN '{r}'" for _, r in ordered) + " END"


_SQL_VERDICT = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in URL_RULES) + " END"


@_query("op7_url_filter", f"""
WITH RECURSIVE p AS (
    SELECT page_id, url, regexp_replace(url, '#.*$', '', 's') AS key,
           {_sql_lower("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")} AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
           regexp_extract(html, '<link\\b[^>]*\\brel\\s*=\\s*["'']?\\s*canonical\\b[^>]*>', 0, 'is') AS tag,
           regexp_extract(html, '<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b[^>]*>', 0, 'is') AS move FROM pages),
l AS (SELECT key AS a, unnest([regexp_extract(tag, '\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is'),
                               regexp_extract(move, '\\burl\\s*=\\s*''?([^''">\\s]+)', 1, 'is')]) AS b FROM p WHERE key IS NOT NULL),
e AS (SELECT a, regexp_replace(b, '#.*$', '', 's') AS b FROM l WHERE b LIKE '%://%'),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(u, v) AS (SELECT a, a FROM s UNION SELECT reach.u, s.b FROM reach JOIN s ON s.a = reach.v),
n AS (SELECT u, v, {_sql_lower("regexp_extract(v, '^.*?://([^/?#]*)', 1, 's')")} AS host, regexp_extract(v, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM reach),
j AS (SELECT u, {_SQL_VERDICT} AS own FROM (SELECT u, {_sql_rule("host", "path")} AS rule FROM n)),
bad AS (SELECT u FROM j GROUP BY u HAVING bool_or(own = 'block') AND NOT coalesce(bool_or(own = 'allow'), false)),
r AS (SELECT page_id, host, path, key, {_sql_rule("host", "path")} AS rule FROM p)
SELECT page_id, host, path, rule, coalesce({_SQL_VERDICT}, CASE WHEN key IN (SELECT u FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM r
""")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return only_result(spark, lambda: filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict"), "op7")


@_query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with the end id, and the text decoded from them, of every whole document."""
    coded = encode_pieces(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


_RULES = RepetitionRules()


@_query("op9_repetition", f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n FROM (
            SELECT doc_id, line, count(*) AS n FROM lines WHERE trim(line, {_SQL_SPACE}) <> '' GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
hit AS (SELECT DISTINCT doc_id, i + o AS i FROM rep, (SELECT unnest(range(8)) AS o)),
cov AS (SELECT h.doc_id, count(*) AS n, sum(length(w.ws[h.i]))::BIGINT AS chars FROM hit h JOIN w ON w.doc_id = h.doc_id GROUP BY 1),
long AS (SELECT DISTINCT doc_id FROM (
            SELECT doc_id, md5(array_to_string(ws[i:i + {_RULES.longest_words}], ' ')) AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {_RULES.longest_words - 1})) AS i FROM w WHERE doc_id IN (SELECT doc_id FROM rep)))
         GROUP BY doc_id, g HAVING count(*) > 1),
r AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words, coalesce(cov.chars, 0) AS chars, long.doc_id IS NOT NULL AS too_long
      FROM w LEFT JOIN dup ON dup.doc_id = w.doc_id LEFT JOIN cov ON cov.doc_id = w.doc_id LEFT JOIN long ON long.doc_id = w.doc_id),
b AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.repeat_percent} * n_words AS base_failed FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * chars <= {_RULES.covered_percent} * word_chars AND NOT too_long AS kept FROM b
""")
def op9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition figures and verdict of every document."""
    return repetition_report(_documents(spark, sf_dir), rules=_RULES).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WORD10 = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@_query("op10_decontam", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_sql_lower("coalesce(text, '')")}, {_WORD10}) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_sql_lower("coalesce(text, '')")}, {_WORD10}) AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS g
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
g AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (
        SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
occ AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM g JOIN win ON win.n = g.n AND win.g = g.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
""")
def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the items that they come from."""
    found = contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@_query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, one of ten made periodic, and their texts without the repeats."""
    found = collapse_runs(_documents(spark, sf_dir), plant=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period",
                        F.expr("(1000 * length) DIV period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


@_query("op12_main_text")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a labeller trained on a bounded sample of the pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages, train_extractor(pages)).withColumn("n_chars", F.length("text").cast("long"))


@_query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent spelling and the root of its chain."""
    return only_result(spark, lambda: group_variants(word_counts(_documents(spark, sf_dir), plant=97)), "op13")
