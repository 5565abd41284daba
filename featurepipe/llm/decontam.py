"""Operator 10: benchmark decontamination with an FM-index per shard of training text.

A shard is a group of whole documents of bounded size inside one Spark partition. Its words
become symbols of the phrases' vocabulary; any other word, and the end of a document, is a
separator. From the suffix order come the Burrows-Wheeler transform, kept as a wavelet matrix
(bit vectors with block counts), and suffix positions sampled at every 16th place and after
each separator. Test phrases are searched backwards, all at once, by wavelet ranks; rows of
the found ranges walk back to a sampled position. The occurrences give spans of words, which
are merged per document. Documents are never shuffled.

The phrases are the windows of the benchmark items. Items form blocks of bounded size
(``block_bytes`` of text, counted first). There is one pass over the documents for each block, and a
block's phrases are at the driver and in the tasks only during its pass, so nothing holds a whole
benchmark; a benchmark of one block takes one pass and no intermediate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import list_array, text_groups
from featurepipe.llm.suffixes import suffix_ranks
from featurepipe.session import materialized, newest, release

SAMPLE = 16
BLOCK_BYTES = 2 << 20
#: bytes of words: digits, letters (lower-cased) and everything beyond ASCII; all others part words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def item_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after lower-casing A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WaveletMatrix:
    """Ranks over a sequence of small integers: one bit vector per bit, most significant first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.words, self.before, self.zeros = bits, [], [], []
        for k in range(bits - 1, -1, -1):
            bit = ((symbols >> k) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            word = np.zeros(len(bit) // 64 + 1, np.uint64)
            word.view(np.uint8)[: len(packed)] = packed
            self.words.append(word)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(word), dtype=np.int64))))
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k][at] + np.bitwise_count(self.words[k][at] & mask)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` comes before place ``i``, for each pair."""
        low = np.zeros_like(i)
        for k in range(self.bits):
            one = ((c >> (self.bits - 1 - k)) & 1).astype(bool)
            ones_low, ones_i = self._ones(k, low), self._ones(k, i)
            low = np.where(one, self.zeros[k] + ones_low, low - ones_low)
            i = np.where(one, self.zeros[k] + ones_i, i - ones_i)
        return i - low

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place ``i`` and how often it comes before, for each place."""
        c, low, at = np.zeros_like(i), np.zeros_like(i), i
        for k in range(self.bits):
            one = ((self.words[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            ones_low, ones_at = self._ones(k, low), self._ones(k, at)
            low = np.where(one, self.zeros[k] + ones_low, low - ones_low)
            at = np.where(one, self.zeros[k] + ones_at, at - ones_at)
            c = (c << 1) | one
        return c, at - low


class FMIndex:
    """Full-text index of a symbol sequence that ends in a separator (0); see the module's text."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        rank = suffix_ranks(text)
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        bwt = text[order - 1]                                 # the last symbol is a separator
        self.n = n
        self.tree = WaveletMatrix(bwt, max(1, symbols.bit_length()))
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        kept = (bwt == 0) | (order % SAMPLE == 0)
        self.kept = np.concatenate(([0], np.cumsum(kept)))
        self.places = order[kept]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the suffixes that begin with each phrase (rows of equal length)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            both = self.tree.rank(np.concatenate((c, c)), np.concatenate((low[live], high[live])))
            low[live], high[live] = self.less[c] + both[: len(c)], self.less[c] + both[len(c):]
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows: walks back to the nearest sampled place."""
        out, steps, todo, at = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows
        while len(todo):
            done = self.kept[at + 1] > self.kept[at]
            out[todo[done]] = self.places[self.kept[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            if len(todo):
                c, before = self.tree.access(at)
                at, steps = self.less[c] + before, steps + 1
        return out


@dataclass
class Phrases:
    """The windows of a block of items: vocabulary, symbol rows by length, items of each window."""
    vocabulary: dict
    by_length: dict
    items: list

    @classmethod
    def of(cls, items: list[tuple[str, str | None]], window: int) -> Phrases:
        found: dict[tuple, set] = {}
        for item, text in items:
            w = item_words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[i: i + window]), set()).add(item)
        vocabulary: dict[bytes, int] = {}
        for phrase in found:
            for w in phrase:
                vocabulary.setdefault(w, len(vocabulary) + 1)
        rows: dict[int, list] = {}
        for k, phrase in enumerate(found):
            rows.setdefault(len(phrase), []).append([k, *(vocabulary[w] for w in phrase)])
        return cls(vocabulary, {n: np.array(x, np.int64) for n, x in rows.items()}, [sorted(x) for x in found.values()])

    def search(self, docs: list[list[bytes]]) -> tuple[list[np.ndarray], list[set]]:
        """Merged hit spans of each document (flat array of first word, end) and its items."""
        sizes = np.array([len(w) for w in docs], np.int64)
        ends = np.cumsum(sizes + 1)
        get = self.vocabulary.get
        text = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        place = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(docs)), sizes)
        text[place] = np.fromiter((get(x, 0) for w in docs for x in w), np.int64, len(place))
        spans, items = [np.empty(0, np.int64)] * len(docs), [set() for _ in docs]
        if not len(text) or not self.vocabulary:
            return spans, items
        index = FMIndex(text, len(self.vocabulary))
        cover = np.zeros(len(text) + 1, np.int64)
        for length, rows in self.by_length.items():
            low, high = index.ranges(rows[:, 1:])
            count = high - low
            which = np.repeat(np.arange(len(rows)), count)
            at = index.locate(np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + low[which])
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
            owner = np.searchsorted(ends, at, side="right")
            for d, k in set(zip(owner.tolist(), rows[which, 0].tolist(), strict=True)):
                items[d].update(self.items[k])
        hit = np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]))
        first, end = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
        owner = np.searchsorted(ends, first, side="right")
        base = np.concatenate(([0], ends))
        for d in np.unique(owner):
            mine = owner == d
            spans[d] = np.column_stack((first[mine], end[mine])).ravel() - base[d]
        return spans, items


def _merge(spans: list[np.ndarray]) -> np.ndarray:
    """Union of span lists of one document."""
    pairs = np.concatenate(spans).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1]) if len(pairs) else pairs[:, 1]
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:, 0] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1) if len(pairs) else []
    return np.column_stack((pairs[new, 0], reach[last])).ravel() if len(pairs) else pairs.ravel()


class _Blocks:
    """Benchmark items in blocks of about ``block_bytes`` of text, one of which is out at a time."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
        items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(
            "item IS NOT NULL AND text IS NOT NULL")
        self.spark, self.window = benchmark.sparkSession, window
        self.count = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
        items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(max(1, self.count))))
        self.items, self.folder = materialized(items, "benchmark-blocks") if self.count > 1 else (items, None)

    def shared(self, k: int) -> Broadcast:
        """Phrases of block ``k``."""
        rows = self.items.where(F.col("block") == k).select("item", "text").collect()
        return self.spark.sparkContext.broadcast(astuple(Phrases.of([tuple(r) for r in rows], self.window)))

    def passes(self, frame: DataFrame, step: Callable[[Broadcast, bool], Callable], schema) -> Iterator[DataFrame]:
        """``frame`` after each block's pass (``step`` makes the function of a block's phrases, and is told of the
        first pass). Where there are several blocks, each result is written and its phrases and input go."""
        last = None
        for k in range(self.count):
            phrases = self.shared(k)
            frame = frame.mapInArrow(step(phrases, k == 0), schema)
            if self.count > 1:
                frame, folder = materialized(frame, "benchmark-pass")
                phrases.destroy()
                if last:
                    release(self.spark, last)
                last = folder
            yield frame

    def close(self) -> None:
        if self.folder:
            release(self.spark, self.folder)


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items, spans``.

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. ``spans``
    holds the merged runs of document words inside any occurrence as [first, end, ...], n_hit
    their words, ``items`` the sorted ids (as text) of items with an occurring window. Null and
    empty texts have no words; items without id or text are no phrases; repeated rows are
    judged one by one; with an empty benchmark nothing is hit. Other columns are not read.
    """
    def step(phrases: Broadcast, first: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Phrases(*phrases.value).search
            for batch in batches:
                for rows, texts in text_groups(batch, "text"):
                    words = [item_words(t) for t in texts]
                    spans, items = search(words)
                    if not first:
                        before = [x.values.to_numpy(zero_copy_only=False) for x in rows.column("spans")]
                        spans = [_merge([x, y]) for x, y in zip(before, spans, strict=True)]
                        items = [y.union(x.as_py()) for x, y in zip(rows.column("items"), items, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.array([len(w) for w in words], pa.int64()),
                         pa.array([int((s[1::2] - s[::2]).sum()) for s in spans], pa.int64()),
                         pa.array([sorted(x) for x in items], pa.list_(pa.string())), list_array(spans, pa.int64())],
                        ["doc_id", "text", "n_words", "n_hit", "items", "spans"])
        return run

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _Blocks(benchmark, item_col, text_col, window, block_bytes)
    fields = "n_words long, n_hit long, items array<string>, spans array<long>"
    out = base.mapInArrow(_words_only, f"doc_id long, {fields}") if not blocks.count else base
    for out in blocks.passes(base, step, f"doc_id long, text string, {fields}"):
        pass
    blocks.close()
    return out.drop("text")


def _words_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents beside an empty benchmark."""
    for batch in batches:
        for rows, texts in text_groups(batch, "text"):
            none = pa.array([[]] * len(texts), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(item_words(t)) for t in texts], pa.int64()), pa.array([0] * len(texts), pa.int64()),
                 none, pa.array([[]] * len(texts), pa.list_(pa.int64()))], ["doc_id", "n_words", "n_hit", "items", "spans"])


def _without(text: str, spans: np.ndarray) -> str:
    """``text`` without the characters from the first to the last word of each span."""
    raw, places, at = text.encode("utf-8", "surrogatepass"), [], 0
    plain = raw.translate(_TABLE)
    for w in plain.split():
        at = plain.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, at = [], 0
    for first, end in spans.reshape(-1, 2):
        out.append(raw[at: places[first][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                         window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with every hit span cut out of its text, until no window occurs any more.

    All other columns and all rows pass through; null texts stay null.
    """
    def step(phrases: Broadcast, _first: bool) -> Callable:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Phrases(*phrases.value).search
            for batch in batches:
                at, cut = batch.schema.get_field_index(text_col), batch.schema.get_field_index("_fp_cut")
                for rows, texts in text_groups(batch, text_col):
                    todo = list(range(len(texts)))
                    done = rows.column(cut).to_pylist() if cut >= 0 else None
                    while todo:                              # a cut may bring words together anew
                        spans, _ = search([item_words(texts[i]) for i in todo])
                        hit = [(i, s) for i, s in zip(todo, spans, strict=True) if len(s)]
                        for i, s in hit:
                            texts[i] = _without(texts[i], s)
                            if done:
                                done[i] += 1
                        todo = [i for i, _ in hit]
                    rows = rows.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                    yield rows.set_column(cut, batch.schema.field(cut), pa.array(done, pa.int64())) if done else rows
        return clean

    blocks = _Blocks(benchmark, item_col, text_col, window, block_bytes)
    if blocks.count <= 1:
        return next(blocks.passes(docs, step, docs.schema), docs)
    spark = docs.sparkSession
    frame, before, last = docs.withColumn("_fp_cut", F.lit(0).cast("long")), 0, None
    while True:                                              # until no block cuts anything any more
        for out in blocks.passes(frame, step, frame.schema):
            pass
        frame, folder = out, newest(spark)
        if last:
            release(spark, last)
        last, now = folder, frame.agg(F.sum("_fp_cut")).first()[0] or 0
        if now == before:
            break
        before = now
    blocks.close()
    return frame.drop("_fp_cut")
