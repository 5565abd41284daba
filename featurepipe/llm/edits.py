"""Operator 5: edit-aware token counts.

A document is cut into segments of about 512 characters, each beginning at white space
after another character. No pre-token crosses such a place, so a segment's count does not
depend on its neighbours. A tree over the segments holds sums of characters and of tokens.
An edit finds its segments by the character sums, re-encodes only them - and neighbours,
where the edit has moved a border off such a place - and updates the sums above.

Trees are rows next to their documents; edits are an array column that ``attach_edits`` makes
from a table of edits with one grouped join.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import list_array, text_groups, worker_cache

SEGMENT = 512
_SPACE = " \t\n\x0b\x0c\r"
_BORDER = re.compile(rf"(?<=\S)[{_SPACE}]")
_CHUNK = re.compile(rf"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: white space to the tokenizer's pattern or to Python that chunks are not cut at
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_HELD = 96 << 20          # bytes of chunks whose counts a worker remembers


class TokenCounter:
    """Token counts of texts with a byte-level BPE given by its ranks file and pre-token pattern."""

    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.held = 0

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def __call__(self, text: str) -> int:
        """Tokens of a segment; chunks of white space and what follows are remembered."""
        if _OTHER_SPACE.search(text):
            return self.whole(text)
        known, total = self.known, 0
        for chunk in _CHUNK.findall(text):
            n = known.get(chunk)
            if n is None:
                self.held += 160 + len(chunk)
                if self.held > _HELD:
                    known.clear()
                    self.held = 160 + len(chunk)
                n = known[chunk] = self.whole(chunk)
            total += n
        return total


def segments(text: str) -> list[str]:
    """The text cut at the first border after every SEGMENT characters; one segment at least."""
    out, at = [], 0
    while True:
        border = _BORDER.search(text, at + SEGMENT)
        if border is None:
            return [*out, text[at:]]
        out.append(text[at: border.start()])
        at = border.start()


def _counter(ranks_file: str, pattern: str) -> TokenCounter:
    """The worker's counter for a vocabulary."""
    held = worker_cache("token counters")
    if (ranks_file, pattern) not in held:
        held[ranks_file, pattern] = TokenCounter(ranks_file, pattern)
    return held[ranks_file, pattern]


class SegmentTree:
    """Sums of characters and tokens over segments, as two heaps (root at 1, leaves from ``size``)."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = len(chars) // 2
        self.chars, self.tokens = chars, tokens

    @classmethod
    def build(cls, chars: list[int], tokens: list[int]) -> SegmentTree:
        size = 1 << max(0, (len(chars) - 1).bit_length())
        out = []
        for leaves in (chars, tokens):
            heap = np.zeros(2 * size, np.int64)
            heap[size: size + len(leaves)] = leaves
            low = size
            while low > 1:                                    # each level from the one below
                heap[low // 2: low] = heap[low: 2 * low].reshape(-1, 2).sum(1)
                low //= 2
            out.append(heap)
        return cls(*out)

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last non-empty one beyond), and the characters before it."""
        i, before = 1, 0
        place = min(place, max(0, int(self.chars[1]) - 1))
        while i < self.size:
            i *= 2
            if before + self.chars[i] <= place and self.chars[i + 1]:
                before += int(self.chars[i])
                i += 1
        return i - self.size, before

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.size
        more_chars, more_tokens = chars - self.chars[i], tokens - self.tokens[i]
        while i:
            self.chars[i] += more_chars
            self.tokens[i] += more_tokens
            i //= 2


class EditedText:
    """A text in segments with its tree; ``edit`` replaces characters [start, end)."""

    def __init__(self, parts: list[str], tree: SegmentTree, count):
        self.parts = parts + [""] * (tree.size - len(parts))
        self.tree, self.count, self.encoded = tree, count, 0

    def edit(self, start: int, end: int, new: str) -> None:
        total = int(self.tree.chars[1])
        start = min(max(0, start), total)
        end = min(max(start, end), total)
        low, before = self.tree.find(start)
        high, last = self.tree.find(max(start, end - 1))
        text = "".join(self.parts[low: high + 1])
        text = text[: start - before] + new + text[end - before:]
        # borders with the neighbours must still be white space after another character
        while (at := self._beside(low, -1)) is not None and not (text and self._border(self.parts[at][-1], text[0])):
            low, text = at, self.parts[at] + text
        while (at := self._beside(high, 1)) is not None and not (text and self._border(text[-1], self.parts[at][0])):
            high, text = at, text + self.parts[at]
        for leaf in range(low + 1, high + 1):
            if self.parts[leaf]:
                self.parts[leaf] = ""
                self.tree.put(leaf, 0, 0)
        self.parts[low] = text
        self.encoded += len(text)
        self.tree.put(low, len(text), self.count(text))

    def _beside(self, leaf: int, step: int) -> int | None:
        """The next segment with text on one side."""
        leaf += step
        while 0 <= leaf < len(self.parts):
            if self.parts[leaf]:
                return leaf
            leaf += step
        return None

    @staticmethod
    def _border(left: str, right: str) -> bool:
        return right in _SPACE and not left.isspace()


def _tree(text: str | None, count: TokenCounter) -> SegmentTree:
    parts = segments(text or "")
    return SegmentTree.build([len(p) for p in parts], [count(p) for p in parts])


def _edited(text: str | None, tree: SegmentTree, edits: list[dict], count: TokenCounter) -> tuple[str, int]:
    """The text after its edits, and how many characters were encoded again; the tree is updated."""
    text, at, parts = text or "", 0, []
    for n in tree.chars[tree.size:].tolist():
        parts.append(text[at: at + n])
        at += n
    held = EditedText(parts, tree, count)
    for e in edits:
        held.edit(e["start"] or 0, e["end"] or 0, e["new"] or "")
    return "".join(held.parts), held.encoded


_TREE = "tree_chars array<long>, tree_tokens array<long>"
_EDIT = "array<struct<start: long, end: long, new: string>>"


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def count_tokens(docs: DataFrame, ranks_file: str, pattern: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and each document's tree, ``tree_chars`` and ``tree_tokens``.

    Null texts count as empty. Columns of these names are replaced; all others, null ids and
    repeated rows pass through. An empty table gives an empty one.
    """
    base = docs.drop("n_tokens", "tree_chars", "tree_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(ranks_file, pattern)
        for batch in batches:
            for rows, texts in text_groups(batch, text_col):
                trees = [_tree(t, count) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array([int(t.tokens[1]) for t in trees], pa.int64()),
                     list_array([t.chars for t in trees], pa.int64()), list_array([t.tokens for t in trees], pa.int64())],
                    [*rows.schema.names, "n_tokens", "tree_chars", "tree_tokens"])

    return base.mapInArrow(run, f"{_fields(base)}, n_tokens long, {_TREE}")


def attach_edits(docs: DataFrame, edits: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the array column ``edits`` from a table ``(id, seq, start, end, new)``.

    Edits of a document apply in order of ``seq``, each to the text as the one before left it,
    so they stay together in its row. Documents without edits get null; null ids match nothing.
    """
    own = (edits.groupBy(F.col(id_col)).agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "new"))).alias("_e"))
           .select(id_col, F.transform("_e", lambda x: F.struct(x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"),
                                                                x["new"].alias("new"))).alias("edits")))
    return docs.drop("edits").join(own, id_col, "left")


def apply_edits(counted: DataFrame, ranks_file: str, pattern: str, *, text_col: str = "text") -> DataFrame:
    """Result of :func:`count_tokens` with its ``edits`` applied: text, trees and counts brought up to date.

    Adds ``n_tokens_before``, ``n_edits`` and ``n_encoded`` (characters that were encoded again) and
    drops ``edits``. Ranges outside the text are cut to it; a null replacement deletes.
    """
    base = counted.drop("n_tokens_before", "n_edits", "n_encoded")
    out = base.drop("edits")
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(ranks_file, pattern)
        for batch in batches:
            for rows, texts in text_groups(batch, text_col):
                col = {n: rows.column(rows.schema.get_field_index(n)) for n in rows.schema.names}
                before = col["n_tokens"]
                chars, tokens, n_edits, encoded = [], [], [], []
                for i, edits in enumerate(col["edits"].to_pylist()):
                    c, t = (np.array(col[n][i].values) for n in ("tree_chars", "tree_tokens"))
                    n_edits.append(len(edits or ()))
                    encoded.append(0)
                    if edits:
                        texts[i], encoded[i] = _edited(texts[i], SegmentTree(c, t), edits, count)
                    chars.append(c)
                    tokens.append(t)
                col[text_col] = pa.array(texts, rows.schema.field(text_col).type)
                col["n_tokens"] = pa.array([int(t[1]) for t in tokens], pa.int64())
                col["tree_chars"], col["tree_tokens"] = list_array(chars, pa.int64()), list_array(tokens, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(col[n] for n in names), before, pa.array(n_edits, pa.int64()), pa.array(encoded, pa.int64())],
                    [*names, "n_tokens_before", "n_edits", "n_encoded"])

    return base.mapInArrow(run, f"{_fields(out)}, n_tokens_before long, n_edits long, n_encoded long")


#: what :func:`contact_edits` replaces
CONTACTS = {"<email>": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<ip>": r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
            "<phone>": r"\+?\d{1,2}? ?\(\d{3}\) ?\d{3}-\d{4}"}


def _contact_finder():
    kinds, tags = re.compile("|".join(f"({p})" for p in CONTACTS.values())), list(CONTACTS)

    def find(text: str) -> list[dict]:
        return [{"start": m.start(), "end": m.end(), "new": tags[m.lastindex - 1]} for m in kinds.finditer(text)][::-1]
    return find


def recount_contacts(docs: DataFrame, ranks_file: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`count_tokens`, :func:`contact_edits` and :func:`apply_edits` in one pass, so that a task
    needs one Python worker: ``doc_id, text, n_tokens_before, n_tokens, n_edits, n_encoded``."""
    base, find = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), _contact_finder()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(ranks_file, pattern)
        for batch in batches:
            for rows, texts in text_groups(batch, "text"):
                out = []
                for text in texts:
                    tree, edits = _tree(text, count), find(text or "")
                    before = int(tree.tokens[1])
                    new, encoded = _edited(text, tree, edits, count) if edits else (text, 0)
                    out.append((new, before, int(tree.tokens[1]), len(edits), encoded))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                                 ["doc_id", "text", "n_tokens_before", "n_tokens", "n_edits", "n_encoded"])

    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, text string, n_tokens_before long, "
                                "n_tokens long, n_edits long, n_encoded long")


def contact_edits(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``edits`` that replace e-mail addresses, IP addresses and phone numbers, last one first."""
    base, find = docs.drop("edits"), _contact_finder()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("new", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_groups(batch, text_col):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([find(t or "") for t in texts], kind)], [*rows.schema.names, "edits"])

    return base.mapInArrow(run, f"{_fields(base)}, edits {_EDIT}")
