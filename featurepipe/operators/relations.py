"""Many-to-many relations (key, member): parsing (A3-A5, B17, D2), cleaning (B2, C1, F6),
distinct-member counts (E1, E3) and the count join (D1, B11).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.functions import once

_DOC_TYPE_COLUMNS = "map<string,map<string,string>>"
_DOC_TYPE_RECORDS = "array<map<string,string>>"
_DOC_TYPE_LINE = "map<string,string>"
SHAPES = ("columns", "records", "lines")


def _pick_alias(keys: Column, aliases: Sequence[str]) -> Column:
    """The last header whose lower-cased, trimmed form is an alias (a later match wins)."""
    hits = F.filter(keys, lambda k: F.lower(F.trim(k)).isin(*aliases))
    return F.try_element_at(hits, F.lit(-1))


def _parsed(text: Column, schema: str) -> Column:
    """``from_json`` that fails the job on malformed text instead of giving NULL."""
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def clean_relation(df: DataFrame, key: str = "key", member: str = "member",
                   sentinels: Sequence[str] = (), distinct: bool = True) -> DataFrame:
    """B2 + C1 + F6: exact-match sentinels -> NULL, drop NULL keys/members, distinct pairs."""
    # a sentinel would become NULL and go with the NULLs: one test of a value drops both
    out = df.select(F.col(key).cast("string").alias(key), F.col(member).cast("string").alias(member))
    for c in (key, member):
        out = out.where(F.col(c).isNotNull() & ~F.col(c).isin(*sentinels) if sentinels else F.col(c).isNotNull())
    return out.dropDuplicates() if distinct else out


def document_shape(text: Column) -> Column:
    """``records``, ``columns`` or ``lines`` by how a JSON text begins and goes on; blank text gives
    NULL, anything else the empty string. One object per line with no comma between is lines, and
    so is a single object whose first value is not an object."""
    lead = F.regexp_extract(text, r"^\s*(\S)", 1)
    lines = text.rlike(r"\}[ \t]*[\r\n]+\s*\{") | ~text.rlike(r'^\s*\{\s*(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*:\s*\{|\}\s*$)')
    return (F.when(lead == "", F.lit(None)).when(lead == "[", "records")
            .when((lead == "{") & lines, "lines").when(lead == "{", "columns").otherwise(""))


def relation_from_docs(docs: DataFrame, text_col: str, key_aliases: Sequence[str], member_aliases: Sequence[str],
                       key: str = "key", member: str = "member", sentinels: Sequence[str] = (),
                       shape: str = "auto", name_col: str | None = None, whole: bool = True) -> DataFrame:
    """JSON documents of any shape to clean, distinct (key, member) pairs, in one pass.

    * columns ``{"movie": {idx: k}, "director": {idx: m}}``: the two maps are aligned on ``idx`` with
      ``map_zip_with`` (an index on one side only gives a NULL, which C1 drops: the net effect of the
      reference's outer join and dropna);
    * records ``[{"movie": k, "director": m}, ...]``; lines: one such record per line.

    The reading job fails for malformed JSON, another top-level type, another shape than the one
    asked for, and for a document in which no record has a key and a member header, naming the
    headers that it has. With ``whole=False`` documents are parts of a relation (a line, a few
    records) and may lack one of the two, but not both. Blank documents hold no rows.
    """
    text, found = F.col(text_col), F.col("_fp_shape")
    name = F.col(name_col) if name_col else F.lit("document")
    pair = "struct<key:string,member:string>"

    def of_records(recs: Column) -> Column:
        def heads(r):
            return F.map_keys(r)
        pairs = F.transform(recs, lambda r: F.struct(
            F.try_element_at(r, _pick_alias(heads(r), key_aliases)).alias("key"),
            F.try_element_at(r, _pick_alias(heads(r), member_aliases)).alias("member")))
        def has(r):
            k, m = _pick_alias(heads(r), key_aliases).isNotNull(), _pick_alias(heads(r), member_aliases).isNotNull()
            return k & m if whole else k | m
        known = F.exists(recs, has)
        seen = F.array_join(F.array_distinct(F.flatten(F.transform(recs, heads))), ", ")
        return F.when((F.size(recs) > 0) & ~known, F.raise_error(F.concat(
            name, F.lit(": relation records unrecognised. Keys found: "), seen)).cast(f"array<{pair}>")).otherwise(pairs)

    def of_columns(m: Column) -> Column:
        heads = F.map_keys(m)
        kh, mh = _pick_alias(heads, key_aliases), _pick_alias(heads, member_aliases)
        zipped = F.map_values(F.map_zip_with(F.try_element_at(m, kh), F.try_element_at(m, mh), lambda _i, a, b: F.struct(
            a.alias("key"), b.alias("member"))))
        return F.when(kh.isNull() | mh.isNull(), F.raise_error(F.concat(
            name, F.lit(": dict shape unrecognised. Keys found: "), F.array_join(heads, ", "))).cast(f"array<{pair}>")).otherwise(zipped)

    lines = F.transform(F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != ""), lambda x: _parsed(x, _DOC_TYPE_LINE))
    allowed = SHAPES if shape == "auto" else (shape,)
    wrong = F.raise_error(F.concat(name, F.when(found == "", F.lit(": unexpected top-level JSON type, expected shape ")).otherwise(
        F.concat(F.lit(": found shape "), found, F.lit(", expected "))), F.lit(" or ".join(allowed)))).cast(f"array<{pair}>")
    # each shape's parse is evaluated once for all its uses
    pairs = (F.when(found.isNull(), F.lit(None)).when(~found.isin(*allowed), wrong)
             .when(found == "columns", once(_parsed(text, _DOC_TYPE_COLUMNS), of_columns))
             .when(found == "records", once(_parsed(text, _DOC_TYPE_RECORDS), of_records))
             .otherwise(once(lines, of_records)))
    rows = (docs.withColumn("_fp_shape", document_shape(text)).select(F.explode(pairs).alias("_fp_p"))
            .select(F.col("_fp_p.key").alias(key), F.col("_fp_p.member").alias(member)))
    return clean_relation(rows, key, member, sentinels)


def relation_from_column_docs(docs: DataFrame, text_col: str, key_aliases: Sequence[str],
                              member_aliases: Sequence[str], key: str = "key", member: str = "member",
                              sentinels: Sequence[str] = ()) -> DataFrame:
    """A4 + D2 + B17: dict-of-columns JSON documents only (see ``relation_from_docs``)."""
    return relation_from_docs(docs, text_col, key_aliases, member_aliases, key, member, sentinels, "columns")


def relation_from_record_docs(docs: DataFrame, text_col: str, key_aliases: Sequence[str],
                              member_aliases: Sequence[str], key: str = "key", member: str = "member",
                              sentinels: Sequence[str] = ()) -> DataFrame:
    """A3 + B17: list-of-records JSON documents that together make a relation (see ``relation_from_docs``)."""
    return relation_from_docs(docs, text_col, key_aliases, member_aliases, key, member, sentinels, "records", whole=False)


def count_members(rel: DataFrame, key: str = "key", member: str = "member",
                  dst: str = "n_members", distinct: bool = False) -> DataFrame:
    """COUNT(DISTINCT member) per key.

    Written as distinct (key, member) followed by a grouped count: the first shuffle is on the
    pair, so a key with many members is spread over all tasks; the second is partially
    aggregated to one row per key per task. NULL members are not counted. ``distinct`` says that
    the pairs are distinct already (the output of ``clean_relation``) and saves the first one.
    """
    pairs = rel.select(key, member) if distinct else rel.select(key, member).dropDuplicates()
    return pairs.groupBy(key).agg(F.count(member).cast("long").alias(dst))


def relation_summary(rel: DataFrame, key: str = "key") -> DataFrame:
    """Number of rows and of distinct keys (two-level distinct, see ``count_members``)."""
    per_key = rel.groupBy(key).agg(F.count(F.lit(1)).alias("_fp_n"))
    return per_key.agg(F.coalesce(F.sum("_fp_n"), F.lit(0)).cast("long").alias("n_rows"),
                       F.count(key).cast("long").alias("n_keys"))


def join_counts(df: DataFrame, key: str, counts: Mapping[str, DataFrame]) -> DataFrame:
    """D1 + B11: left-join per-key count tables (each grouped by ``key``), missing -> 0.

    Row-preserving because every count table has one row per key. Join strategy is left to
    Catalyst/AQE (broadcast when the measured count table is small, sort-merge otherwise; the
    count tables are already hash-partitioned on the key by their aggregation).
    """
    out = df
    for name, table in counts.items():
        out = out.join(table.select(key, name), key, "left")
    return out.withColumns({name: F.coalesce(F.col(name), F.lit(0)).cast("long") for name in counts})
