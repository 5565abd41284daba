"""Operator 13: grouping of spelling variants by dynamic programming over sorted word lists.

Two words are near if one insertion, deletion or replacement parts them. Near words share a half: the
edit lies behind the first half of the shorter word or before its second half. Each word of
length L thus goes into lists of words that share a first or a last half, for pairs whose shorter
word has L or L - 1 characters. What the list's words share is left off. A list above ``_LIST``
words is parted again by halves of the rest; a rest of one character ends that, so no list is
long, however many words share their beginnings.

A list is sorted, and every word of it is compared with all others in one scan: a prefix that
neighbours share (their longest common prefix) has one row of the edit matrix, of which only the
band of three cells beside the diagonal can hold values up to one; rows of longer prefixes go on
from it, and the range of words behind a prefix is skipped as soon as its row exceeds one. The
scan goes down the ranges of all words of a block together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.session import broadcast_if_small, materialize

_LIST = 20_000                  # words of a list that are scanned together
_ROWS = 100_000                 # rows of lists handled at once
_QUERIES = 8192                 # words that go down the ranges together
_HELD = 1 << 19                 # distinct words that a task counts before it hands them on
_FAR = 9

# letters A-Z a-z and U+00C0 to U+00FF in Latin-1, A-Z lower-cased; everything else parts words
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256))


def _counter(min_chars: int, plant: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                               pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                found = Counter(w for w in text.encode("latin-1", "replace").translate(_LETTERS).split() if len(w) >= min_chars)
                if plant:
                    start = zlib.crc32(f"{'' if key.as_py() is None else key.as_py()}:".encode())
                    for w in list(found):
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % plant == 0:
                            n, k = found.pop(w), h % len(w)
                            if len(w) > min_chars:
                                held[w[:k] + w[k + 1:]] += n
                held.update(found)
                if len(held) >= _HELD:
                    yield out()
                    held.clear()
        yield out()
    return run


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3,
                plant: int | None = None) -> DataFrame:
    """``(word, n)``: words of at least ``min_chars`` code points that occur ``min_count`` times in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With ``plant`` a word
    of a document loses one code point where ``plant`` divides the crc32 of ``<id>:<word>``. Null
    and empty texts have no words; a null id counts as an empty one.
    """
    base = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text"))
    return (base.mapInArrow(_counter(min_chars, plant), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


# ---------------------------------------------------------------- lists of words that share a half

def _halved(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, m, path, a, b, rest) twice: by the first and by the last half of the rest.

    ``m`` is the shorter word's length, ``a`` and ``b`` the characters shared at both ends and
    ``rest`` those of a word of length m between them.
    """
    half = F.floor(F.col("rest") / 2).cast("int")
    first = F.struct(F.concat("path", F.lit("f")).alias("path"), (F.col("a") + half).alias("a"), F.col("b"), (F.col("rest") - half).alias("rest"))
    last = F.struct(F.concat("path", F.lit("l")).alias("path"), F.col("a"), (F.col("b") + F.col("rest") - half).alias("b"), half.alias("rest"))
    out = rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("s")).select("word", "n", "m", "s.*")
    size = F.length("word")
    ends = [F.substr("word", F.lit(1), F.col("a")), F.substr("word", size - F.col("b") + 1, F.col("b"))]
    return (out.withColumn("key", F.concat_ws("|", "path", "m", *ends))
            .withColumn("mid", F.substr("word", F.col("a") + 1, size - F.col("a") - F.col("b"))))


def _lists(words: DataFrame, min_chars: int, most: int) -> DataFrame:
    """``(key, mid, word, n, rest, last)``: lists of at most ``most`` words that share ``key``."""
    size = F.length("word")
    classes = F.filter(F.array(size, size - 1), lambda m: m >= min_chars)
    rows = words.select("word", "n", F.explode(classes).alias("m")).select(
        "*", F.lit("").alias("path"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("m").alias("rest"))
    rows, done = _halved(rows), None
    while True:
        long = materialize(rows.where("rest > 1").groupBy("key").agg(F.count(F.lit(1)).alias("of")).where(F.col("of") > most)
                           .select("key"), "variant-lists")
        if long.isEmpty():
            return rows if done is None else done.unionByName(rows)
        long = broadcast_if_small(long)
        short = rows.join(long, "key", "left_anti")
        done = short if done is None else done.unionByName(short)
        rows = _halved(rows.join(long, "key", "left_semi").drop("key", "mid"))


def near_pairs(keys: np.ndarray, mids: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(x, y)`` of one key, x of ``queries``, whose ``mids`` are exactly one edit apart.

    Rows are sorted by (key, mid), and no two are equal.
    """
    n, width = len(mids), max(1, mids.dtype.itemsize // 4)
    text = np.zeros((n, width + 3), np.uint32)               # one column before, for the band's lower cell
    text[:, 1: width + 1] = np.ascontiguousarray(mids).view(np.uint32).reshape(n, width)
    size = (text > 0).sum(1).astype(np.int32)
    same_key = keys[1:] == keys[:-1]
    prefix = np.full(n + 1, -1, np.int32)                    # longest common prefix with the row before
    prefix[1:n] = np.where(same_key, np.argmin(np.column_stack((text[1:, 1:] == text[:-1, 1:], np.zeros(n - 1, bool))), 1), -1)
    border = np.concatenate(([0], np.flatnonzero(~same_key) + 1, [n]))
    splits = [np.flatnonzero(prefix[:n] == d).astype(np.int32) for d in range(width + 1)]
    xs, ys = [], []
    group = np.searchsorted(border, queries, side="right")
    for at in range(0, len(queries), _QUERIES):
        q = queries[at: at + _QUERIES].astype(np.int32)
        low, high = (border[group[at: at + _QUERIES] - k].astype(np.int32) for k in (1, 0))
        under, diag, over = (np.full(len(q), v, np.int8) for v in (_FAR, 0, 1))
        for d in range(width + 1):
            ends = np.flatnonzero(size[low] == d)            # the word that is this prefix itself comes first
            if len(ends):
                k = size[q[ends]] - d
                cell = np.select([k == -1, k == 0, k == 1], [under[ends], diag[ends], over[ends]], _FAR)
                hit = ends[cell == 1]
                xs.append(q[hit])
                ys.append(low[hit])
                low[ends] += 1
                live = low < high
                q, low, high, under, diag, over = (v[live] for v in (q, low, high, under, diag, over))
            if not len(q):
                break
            cut = splits[d]                                  # ranges behind the prefix, one for each next character
            s, t = np.searchsorted(cut, low, side="right"), np.searchsorted(cut, high, side="left")
            parts = t - s + 1
            src = np.repeat(np.arange(len(q)), parts)
            nth = np.arange(len(src)) - np.repeat(np.cumsum(parts) - parts, parts)
            bounds = np.append(cut, 0)
            first = np.where(nth > 0, bounds[np.minimum(s[src] + nth - 1, len(cut))], low[src])
            last = np.where(nth < parts[src] - 1, bounds[np.minimum(s[src] + nth, len(cut))], high[src])
            q, low, high = q[src], first.astype(np.int32), last.astype(np.int32)
            c = text[low, d + 1]
            u, g, o = under[src], diag[src], over[src]
            left = size[q] - d - 1                           # query characters behind the diagonal cell
            under = np.minimum(u + (c != text[q, d]), g + 1).astype(np.int8)
            diag = np.minimum(np.minimum(g + (c != text[q, d + 1]), o + 1), under + 1).astype(np.int8)
            diag[left < 0] = _FAR
            over = np.minimum(o + (c != text[q, d + 2]), diag + 1).astype(np.int8)
            over[left < 1] = _FAR
            live = np.minimum(np.minimum(under, diag), over) <= 1
            q, low, high, under, diag, over = (v[live] for v in (q, low, high, under, diag, over))
    if not xs:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(xs), np.concatenate(ys)


_FOUND = "word string, n long, near long, best_n long, best string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of whole lists: rows come sorted by (key, mid)."""
    def judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
        queries = np.flatnonzero(count[which] > 1)
        if not len(queries):
            return
        # lists of one word hold no pair
        table = table.take(pa.array(queries))
        keys = keys[queries]
        mids = np.array(table.column("mid").to_pylist())
        rest, last = (table.column(c).to_numpy() for c in ("rest", "last"))
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        x, y = near_pairs(keys, mids, np.arange(len(keys)))
        size = np.char.str_len(mids)
        # a pair belongs to the length of its shorter word, and to the first half if it shares both
        fits = (size[x] == rest[x]) | (size[y] == rest[x])
        back = np.flatnonzero(fits & last[x])
        fits[back[[mids[a][:r] == mids[b][:r] for a, b, r in zip(x[back], y[back], rest[x[back]], strict=True)]]] = False
        x, y = x[fits], y[fits]
        if not len(x):
            return
        order = np.lexsort((np.array(words)[y], -n[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in x[first]]), pa.array(n[x[first]]), pa.array(np.diff(np.append(first, len(x)))),
             pa.array(n[y[first]]), pa.array([words[i] for i in y[first]])], ["word", "n", "near", "best_n", "best"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _ROWS:
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_pylist()
            cut = len(keys) - 1
            while cut > 0 and keys[cut - 1] == keys[-1]:
                cut -= 1
            if cut:                                           # the last list may go on in the next batch
                yield from judged(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                rows = len(keys) - cut
    if rows:
        yield from judged(pa.Table.from_batches(held))


def near_words(words: DataFrame, *, min_chars: int = 5, longest_list: int = _LIST) -> DataFrame:
    """``(word, n, near, best_n, best)`` of the words of ``(word, n)`` that have near words: their
    number and the one of largest n (the smallest of equals). Words are distinct."""
    lists = _lists(words, min_chars, longest_list).select("key", "mid", "word", "n", "rest", F.contains("path", F.lit("l")).alias("last"))
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = lists.repartition(parts, "key").sortWithinPartitions("key", "mid").mapInArrow(_scan, _FOUND)
    best: Column = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return (found.groupBy("word", "n").agg(F.sum("near").alias("near"), best.alias("b"))
            .select("word", "n", "near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best")))


def group_variants(words: DataFrame, *, ratio: int = 2, min_chars: int = 5, longest_list: int = _LIST) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all rows of ``(word, n)``, one a word.

    ``n_near`` counts the near words, ``form`` is the near word of largest n (the smallest in
    code-point order of equals) if that is at least ``ratio`` * n, else null, with its count in
    ``form_n``; ``root`` is the last word when forms are followed (the word itself without one).
    ``ratio`` is 2 or more, so counts grow along forms and no circle closes. An empty table gives
    an empty result.
    """
    words = materialize(words.select("word", "n"), "variant-words")
    near = materialize(near_words(words, min_chars=min_chars, longest_list=longest_list)
                       .withColumn("fits", F.col("best_n") >= ratio * F.col("n")), "variant-near")
    up = near.where("fits").select("word", F.col("best").alias("up"))
    while True:                                             # pointer jumping: chains halve each round
        higher = up.select(F.col("word").alias("up"), F.col("up").alias("higher"))
        jumped = materialize(up.join(higher, "up", "left").select(
            "word", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved")), "variant-roots")
        up = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            break
    forms = near.select("word", "near", F.when(F.col("fits"), F.col("best")).alias("form"), F.when(F.col("fits"), F.col("best_n")).alias("form_n"))
    return (words.join(forms, "word", "left").join(up, "word", "left")
            .select("word", "form", F.coalesce("up", "word").alias("root"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
