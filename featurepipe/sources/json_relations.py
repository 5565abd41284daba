"""A3-A5: relation files (key, member) in three shapes.

* list of records ``[{"movie": k, "director": m}, ...]``
* dict of columns ``{"movie": {idx: k}, "director": {idx: m}}``
* JSON Lines, one record per line (the shape that splits across tasks)

``read_relation`` tells the shapes apart per file and fails the reading job, naming the file, for
malformed JSON, any other top-level type and unknown headers. ``shape="lines"`` reads JSON Lines
row by row, so files split across tasks; every other shape is one document per file, parsed by
the task that reads it: a limit of the format, not of the reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.config import NULL_SENTINELS
from featurepipe.operators.relations import relation_from_docs


def read_relation(spark: SparkSession, path: str | Sequence[str], key_aliases: Sequence[str],
                  member_aliases: Sequence[str], key: str = "key", member: str = "member",
                  sentinels: Sequence[str] = NULL_SENTINELS, shape: str = "auto") -> DataFrame:
    """Clean, distinct (key, member) pairs from relation file(s), each read once.

    With ``shape="lines"`` a line with neither a key nor a member header fails the job; no schema
    inference pass is made.
    """
    docs = spark.read.text(path, wholetext=shape != "lines").select(
        F.col("value").alias("json"), F.col("_metadata.file_path").alias("file"))
    return relation_from_docs(docs, "json", key_aliases, member_aliases, key, member, sentinels, shape, "file",
                              whole=shape != "lines")
