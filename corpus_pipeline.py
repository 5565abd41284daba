"""The corpus pipeline: documents in, token ids of the cleaned documents out.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet and read again as the docs of the next one. All but the last return
the columns of documents, with ``n_chars`` following the text where that column exists.

SentencePiece ids cannot be expressed in SQL, so ``ORACLE_SQL`` is None and tests hold the result
against a brute-force version. Null texts fail the quality rules; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm.decontam import remove_contamination
from featurepipe.llm.linededup import dedup_lines
from featurepipe.llm.neardup import near_duplicates
from featurepipe.llm.pieces import encode_pieces
from featurepipe.llm.repetition import keep_unrepetitive
from featurepipe.operators.ordering import dense_index
from featurepipe.session import materialize, newest, only_result, release

ORACLE_SQL = None


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return keep_unrepetitive(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds too are dropped; no document goes."""
    return _recount(dedup_lines(docs, report=False))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    The smallest id of a group stays. Rows that repeat an id and its text are one document and give
    one row; other texts under the id are documents of their own. Documents with a null id come
    after all others; those of them without words all stay.
    """
    rows = docs.select(F.col("doc_id").alias("_id"), F.coalesce(F.sha2("text", 256), F.lit("")).alias("_mark"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    held = rows.groupBy("_id").agg(F.min("_mark").alias("low"), F.max("_mark").alias("high"))
    loose = held.where("_id IS NULL OR low != high").limit(1).count() > 0      # ids that do not name a text
    keyed, left = rows.select(F.col("_id").alias("_key"), "_row"), docs.limit(0)
    if loose:
        blank = F.col("_row.doc_id").isNull() & ~F.coalesce("_row.text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        left, rows = rows.where(blank).select("_row.*"), rows.where(~blank)
        keys = dense_index(rows.select("_id", "_mark").distinct(), [F.col("_id").isNull(), "_id", "_mark"], name="_key")
        keys = keys.select(F.col("_id").alias("_of"), F.col("_mark").alias("_as"), "_key")
        keyed = rows.join(keys, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_as"))).select("_key", "_row")
        keyed = materialize(keyed.groupBy("_key").agg(F.min("_row").alias("_row")), "near-documents")
    kept = (near_duplicates(keyed.select("_key", "_row.text"), id_col="_key", width=5)
            .where("kept").select(F.col("doc_id").alias("_kept")).distinct())
    one = (keyed.join(kept, F.col("_key") == F.col("_kept"), "left_semi").groupBy("_key")
           .agg(F.min("_row").alias("_row")).select("_row.*"))
    return one.unionByName(left)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark's ten-word windows are cut out of the texts."""
    return _recount(remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)``: ids with the end id, and a digest of the decoded text."""
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("tokenize", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again. A stage's own
    intermediates go when it is written, its documents when the next stage is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = only_result(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            release(spark, before)
        before = newest(spark)
    return docs
