"""Operator 9: quality rules on repetition inside a document, from its suffix array.

Words of many documents form one sequence with a separator after each document and keys that
differ between documents, so one suffix sort serves a whole group of texts. The longest common
prefix of neighbours in suffix order gives, for every position, the longest repeat that starts
there; positions whose predecessor does not carry the same repeat one word further are the
left ends of maximal repeats. The union of their spans is the repeated part of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import ASCII_SPACE, WordIds, text_groups
from featurepipe.llm.suffixes import suffix_ranks

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict. Whole numbers, so that borders are exact."""
    min_words: int = 20              # base: fewer words fail
    repeat_percent: int = 30         # base: share of words in repeated 8-word windows
    covered_percent: int = 30        # method: share of characters inside maximal repeats, as of words above
    longest_words: int = 100         # method: words of the longest repeat


def repeats(words: list[list[bytes]], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents given as word lists: repeated words marked over all words in turn, the
    longest repeat of each document, and its number of maximal repeat occurrences.

    Only repeats of ``window`` words or more count.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    ids = WordIds()
    flat = ids.of([x for w in words for x in w])
    doc = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) + doc                   # one separator after each document
    keys = np.zeros(len(flat) + len(words) + 1, np.int64)
    keys[place] = doc * len(ids) + flat + 1
    mark, longest, count = np.zeros(len(flat), bool), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    levels: list[np.ndarray] = []
    rank = suffix_ranks(keys, levels)
    order = np.empty(len(keys), np.int64)
    order[rank] = np.arange(len(keys))
    first = window.bit_length() - 1                      # levels[first] tells beginnings of 2**first <= window words
    if len(levels) <= first:
        return mark, longest, count
    near = np.flatnonzero(levels[first][order[:-1]] == levels[first][order[1:]])
    a, b = order[near], order[near + 1]
    lcp = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + lcp] == levels[k][b + lcp]
        lcp[same] += 1 << k
    best = np.zeros(len(keys) + 1, np.int64)             # longest repeat that starts at a place
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    left = np.flatnonzero(best >= window)
    left = left[(left == 0) | (best[left - 1] != best[left] + 1)]
    cover = np.zeros(len(keys) + 1, np.int64)
    np.add.at(cover, left, 1)
    np.add.at(cover, left + best[left], -1)
    mark = np.cumsum(cover)[place] > 0
    owner = np.searchsorted(np.cumsum(sizes + 1), left, side="right")
    np.maximum.at(longest, owner, best[left])
    np.add.at(count, owner, 1)
    return mark, longest, count


_FIELDS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "repeat_chars long, longest_repeat long, n_repeats long, base_failed boolean, kept boolean")
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _dup_lines(text: str) -> int:
    seen: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            dups += line in seen
            seen.add(line)
    return dups


def measure(texts: list, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """Figures and verdict of each text, by column."""
    texts = [t or "" for t in texts]
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    mark, longest, count = repeats(words)
    n_words = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(words)), n_words)
    flat = [x for w in words for x in w]
    hit = np.flatnonzero(mark)
    hit_chars = [len(flat[i].decode("utf-8", "surrogatepass")) for i in hit]
    word_chars = np.array([len(t) - sum(map(t.count, ASCII_SPACE)) for t in texts], np.int64)
    n_repeat = np.bincount(doc[hit], minlength=len(texts)).astype(np.int64)
    repeat_chars = np.bincount(doc[hit], hit_chars, len(texts)).astype(np.int64)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.repeat_percent * n_words)
    passes = (100 * repeat_chars <= rules.covered_percent * word_chars) & (longest <= rules.longest_words)
    return {"n_words": n_words, "word_chars": word_chars,
            "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
            "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64), "n_repeat_words": n_repeat,
            "repeat_chars": repeat_chars, "longest_repeat": longest, "n_repeats": count, "base_failed": failed,
            "kept": ~failed & passes}


def repetition_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``kept`` and the method's own figures.

    ``n_repeat_words`` are the words inside 8-word windows found twice or more in the text;
    ``repeat_chars`` their code points, ``longest_repeat`` the words of the longest maximal
    repeat and ``n_repeats`` the number of occurrences of maximal repeats. A document is kept
    if the base rules pass, repeats cover at most ``covered_percent`` of its characters and none is
    longer than ``longest_words``. Null and empty texts have no words and fail the base rule.
    Null ids, repeated rows and ties need no care: rows are judged one by one. Other columns
    of ``docs`` are not read; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_groups(batch, "text"):
                figures = measure(texts, rules)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(figures[n]) for n in _NAMES[1:])], _NAMES)

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, _FIELDS)


def keep_unrepetitive(docs: DataFrame, *, text_col: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`repetition_report` keeps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_groups(batch, text_col):
                yield rows.filter(pa.array(measure(texts, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
