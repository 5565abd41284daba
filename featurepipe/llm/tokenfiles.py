"""Operator 2: token-id files in canonical length-limited Huffman code.

Writing: texts are tokenised once into a table of ids in the shared folder; a global count of
every id gives code lengths of at most ``max_bits`` (package-merge) and with them the canonical
code; documents are encoded, sent to range shards of the id and written in ascending order.
A document's row holds its bits, byte-aligned, and the bit offset of every 256th id, so each
run of 256 ids is a block that decodes on its own. The code's lengths lie beside the rows.

Reading: a table of 2**max_bits entries gives the id and length of the code at any bit place;
all blocks of a batch advance together, one id per step.

Only id counts (bounded by the vocabulary) and shard bounds come to the driver.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm.common import Remembered, byte_slices, closed, in_order, list_array, looked_up, text_groups, worker_cache
from featurepipe.session import checkpoint_dir, keep_until_release

BLOCK = 256
_HELD = 192 << 20         # bytes of words and their ids that a worker remembers
_TOGETHER = 128           # words in one call of the library
# lower-case Latin-1 letters, and marks that the tokenizer parts from letters before them
_LETTERS = bytes([*range(97, 123), *(c for c in range(0xDF, 0x100) if c != 0xF7)])
_MARKS = b".,;:!?*#%&$|"
_LOWER = bytes(ord(chr(c).lower()) for c in range(256))
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LETTER, _MARK = (np.isin(np.arange(256), list(x)) for x in (_LETTERS, _MARKS))
_IDS_AT_ONCE = 2 << 20


# ---------------------------------------------------------------- the code

def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Bits of every id (0: never seen) of the best prefix code of at most ``max_bits`` bits."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids need more than {max_bits} bits")
    if len(ids) < 2:
        lengths[ids] = 1
        return lengths
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weight = counts[ids].astype(np.int64)
    row, leaf = weight, [np.ones(len(ids), bool)]
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((weight, pairs))
        order = np.argsort(both, kind="stable")
        row = both[order]
        leaf.append(order < len(weight))
    take = 2 * len(ids) - 2                                  # cheapest items of the last row
    for is_leaf in reversed(leaf):
        n = int(is_leaf[:take].sum())
        lengths[ids[:n]] += 1                                # leaves come in order of weight
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): each is the last one plus 1, shifted to its length."""
    codes = np.zeros(len(lengths), np.int64)
    code = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == bits)
        codes[own] = code + np.arange(len(own))
        code = (code + len(own)) << 1
    return codes


def decode_table(lengths: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, bits) for every value of the next ``max_bits`` bits."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    spread = 1 << (max_bits - lengths[ids].astype(np.int64))
    sym, bits = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.uint8)
    sym[: spread.sum()] = np.repeat(ids, spread)
    bits[: spread.sum()] = np.repeat(lengths[ids], spread)
    return sym, bits


def encode(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """Bits of each document (runs of ``sizes`` in ``ids``) and the bit offsets of its blocks."""
    bits = lengths[ids].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(bits)))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    whole = ends[bounds[1:]] - ends[bounds[:-1]]
    first = np.concatenate(([0], np.cumsum((whole + 7) // 8)))        # first byte of each document
    at = ends[:-1] + np.repeat(8 * first[:-1] - ends[bounds[:-1]], sizes)
    word = codes[ids] << (32 - bits - (at & 7))                       # four bytes from the code's first byte on
    held = np.bincount(at >> 3, word, first[-1] + 4).astype(np.int64)  # codes share bytes, never bits
    raw = np.zeros(len(held) + 3, np.uint8)
    for k in range(4):
        raw[k: k + len(held)] |= ((held >> (24 - 8 * k)) & 255).astype(np.uint8)
    data = raw.tobytes()
    offset = at - np.repeat(8 * first[:-1], sizes)
    return ([data[a:b] for a, b in zip(first[:-1], first[1:], strict=True)],
            [offset[a:b:BLOCK] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])


def decode(payloads: list[bytes], sizes: np.ndarray, offsets: list[np.ndarray], table: tuple[np.ndarray, np.ndarray],
           max_bits: int) -> np.ndarray:
    """Ids of all documents in turn; all blocks go on together, one id a step."""
    data = np.frombuffer(b"".join(payloads) + bytes(8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    first = np.concatenate(([0], np.cumsum([len(p) for p in payloads])))[:-1]
    blocks = -(-sizes // BLOCK)
    place = (np.concatenate(offsets) if len(offsets) else np.empty(0, np.int64)) + 8 * np.repeat(first, blocks)
    base = np.concatenate(([0], np.cumsum(sizes)))
    nth = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = np.repeat(base[:-1], blocks) + BLOCK * nth
    left = np.minimum(BLOCK, np.repeat(sizes, blocks) - BLOCK * nth)
    order = np.argsort(-left, kind="stable")                          # longest first: the live ones stay in front
    place, start, left = place[order], start[order], left[order]
    out = np.empty(int(base[-1]), np.uint32)
    sym, bits = table
    mask, ended = np.uint32((1 << max_bits) - 1), -left
    for step in range(int(left.max(initial=0))):
        live = int(np.searchsorted(ended, -step, side="left"))
        at = place[:live]
        code = (window[at >> 3] >> (32 - max_bits - (at & 7)).astype(np.uint32)) & mask
        out[start[:live] + step] = sym[code]
        place[:live] += bits[code]
    return out


# ---------------------------------------------------------------- tokenising

class WordTokenizer:
    """Packed ids of single words, by a file of the tokenizers library, remembered by the worker.

    Latin-1 texts are lower-cased and parted between a letter and a mark first, where loading shows
    that the file's tokenizer does both itself; words of letters then go through its model without
    normalizer and patterns, many in one call, as the model marks the last token of a word. All
    other words, and the words of all other texts, go through the tokenizer one by one.
    """

    def __init__(self, tokenizer_file: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(tokenizer_file)
        self.size = max(self.whole.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.end = end_id
        self.known = Remembered(_HELD)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(),
                                                           pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.ends = np.array([bool(suffix) and (self.whole.id_to_token(i) or "").endswith(suffix) for i in range(self.size)])
        self.folds = bool(suffix) and self._folds()

    def _folds(self) -> bool:
        def ids(text: str) -> list[int]:
            return self.whole.encode(text, add_special_tokens=False).ids

        letters, marks = _LETTERS.decode("latin-1"), _MARKS.decode()
        return (all(ids(chr(c) * 2 + "x") == ids((chr(c) * 2 + "x").lower()) for c in range(33, 256))
                and ids("straße") == self.bare.encode("straße", add_special_tokens=False).ids
                and all(ids(f"a{x}b {x}") == self.bare.encode(f"a{x}b {x}", add_special_tokens=False).ids for x in letters)
                and all(ids(x + m * n + "b1") == ids(x) + ids(m * n + "b1") for x in "aéß" for m in marks for n in (1, 3))
                and all(ids("a" + m + k) == ids("a") + ids(m + k) for m in marks for k in marks))

    def _packed(self, words: list[str]) -> Iterator[bytes]:
        for e in self.whole.encode_batch_fast(words, add_special_tokens=False):
            yield np.array(e.ids, self.kind).tobytes()

    def _cores(self, words: list[str]) -> Iterator[bytes]:
        wide = self.kind.itemsize
        calls = [words[k: k + _TOGETHER] for k in range(0, len(words), _TOGETHER)]
        for call, e in zip(calls, self.bare.encode_batch_fast([" ".join(c) for c in calls], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.kind)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * wide
            if len(cuts) != len(call) or cuts[-1] != len(ids) * wide:
                raise AssertionError("the model does not mark the ends of words")
            raw, cuts = ids.tobytes(), cuts.tolist()
            yield from [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def _cut(self, raws: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Words of Latin-1 texts, folded and parted, and the number of each text. White space is dropped
        by the tokenizer and never joined across."""
        codes = np.frombuffer(b"\n".join([*raws, b""]).translate(_LOWER), np.uint8)
        first = np.cumsum([0, *(len(r) + 1 for r in raws)])
        said = ~_SPACE[codes]
        begin = said.copy()
        begin[1:] &= ~said[:-1] | (_LETTER[codes[:-1]] & _MARK[codes[1:]])
        at = np.flatnonzero(begin)
        return byte_slices(codes[said], (np.cumsum(said) - 1)[at]), np.diff(np.searchsorted(at, first))

    def _learn(self, fresh: list) -> None:
        cores, rest = [], []
        for w in fresh:
            (rest if isinstance(w, str) or w.translate(None, _LETTERS) else cores).append(w)
        self.known.put_all(cores, list(self._cores([w.decode("latin-1") for w in cores])))
        self.known.put_all(rest, list(self._packed([w if isinstance(w, str) else w.decode("latin-1") for w in rest])))

    def pack(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, in one array, and the number of each; null is empty."""
        folded, raws, rest = [], [], []
        for k, t in enumerate(texts):
            t = t or ""
            try:
                if not self.folds or "<|" in t:               # the file's special tokens begin so, in their case
                    rest.append(k)
                else:
                    raws.append(t.encode("latin-1"))
                    folded.append(k)
            except UnicodeEncodeError:
                rest.append(k)
        parts, kind = [], self.kind
        if folded or not rest:
            keys, n = self._cut(raws)
            ids, sizes = looked_up(keys, self.known, self._learn, kind)
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(n)))]
            parts.append((folded, *closed(ids, np.diff(ends), self.end)))
        if rest:
            split = [[w.decode("utf-8", "surrogatepass") for w in (texts[k] or "").encode("utf-8", "surrogatepass").split()] for k in rest]
            self._learn(self.known.missing(chain.from_iterable(split)))
            packed = [b"".join(map(self.known.__getitem__, u)) for u in split]
            parts.append((rest, *closed(np.frombuffer(b"".join(packed), kind), np.array([len(x) // kind.itemsize for x in packed]), self.end)))
        return in_order(parts, len(texts), kind)


_DRAWN = "doc_id long, ids binary, counted array<struct<id:long,n:long>>"


def _tokenised(tokenizer_file: str, end_id: int):
    """Rows (doc_id, ids, null) of all texts, and a last row of each partition with the counts of its ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache("word tokenizers")
        if (tokenizer_file, end_id) not in held:
            held[tokenizer_file, end_id] = WordTokenizer(tokenizer_file, end_id)
        tokenizer = held[tokenizer_file, end_id]
        counts, kind = np.zeros(tokenizer.size, np.int64), pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
        names = ["doc_id", "ids", "counted"]
        for batch in batches:
            for rows, texts in text_groups(batch, "text"):
                ids, sizes = tokenizer.pack(texts)
                counts += np.bincount(ids, minlength=tokenizer.size)
                starts = (np.cumsum(sizes) - sizes) * tokenizer.kind.itemsize
                yield pa.RecordBatch.from_arrays([rows.column(0), byte_slices(ids.view(np.uint8), starts), pa.nulls(len(sizes), kind)], names)
        seen = np.flatnonzero(counts)
        each = pa.StructArray.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])], ["id", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                          pa.ListArray.from_arrays(pa.array([0, len(seen)], pa.int32()), each)], names)

    tokenizer = WordTokenizer(tokenizer_file, end_id)
    return run, tokenizer.size, tokenizer.kind.itemsize


def _grouped(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of about _IDS_AT_ONCE ids."""
    part = np.cumsum(sizes) // _IDS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 1, max_bits: int = 18, shards: int | None = None) -> None:
    """Tokenise whole texts, append ``end_id`` to each and write the ids to ``path``.

    ``path/code`` holds (id, bits), ``path/docs`` one row per document: shard, doc_id,
    n_tokens, bits, block offsets and start, the ids of all documents before it; shards and the
    rows inside them ascend with the id. Null
    and empty texts are the end id alone; null ids come last; rows that repeat an id keep all
    their rows, side by side. Other columns are not read. An empty table gives empty files.
    """
    if not 1 <= max_bits <= 25:
        raise ValueError("max_bits must be 1 to 25: codes are read from windows of 32 bits")
    spark = docs.sparkSession
    run, size, wide = _tokenised(tokenizer_file, end_id)
    kind = f"<u{wide}"
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    drawn = os.path.join(checkpoint_dir(spark), "featurepipe", f"token-ids-{uuid.uuid4().hex}")
    base.mapInArrow(run, _DRAWN).write.option("compression", "zstd").parquet(drawn)
    keep_until_release(spark, drawn)
    drawn = spark.read.parquet(drawn)
    ids = drawn.where("counted IS NULL").select("doc_id", "ids")

    counts = np.zeros(size, np.int64)
    each = drawn.select(F.explode("counted").alias("c")).select("c.*")
    for row in each.groupBy("id").agg(F.sum("n").alias("n")).collect():        # bounded by the vocabulary
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts, max_bits)
    seen = [(int(i), int(lengths[i]), max_bits) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(seen, "id long, bits int, max_bits int").coalesce(1).write.parquet(os.path.join(path, "code"))

    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)] or [0.5], 10 * shards)).first()[0] or []
    cuts = np.array(sorted(set(cuts))[: shards - 1], np.int64)

    def shard_of(ids: pa.Array) -> np.ndarray:
        return np.searchsorted(cuts, ids.fill_null(2 ** 63 - 1).to_numpy(zero_copy_only=False), side="left")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shards, np.int64)
        for batch in batches:
            np.add.at(total, shard_of(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shards)), pa.array(total)], ["shard", "n"])

    sizes = ids.select("doc_id", F.expr(f"CAST(octet_length(ids) DIV {wide} AS LONG) AS n"))
    before = np.zeros(shards, np.int64)                       # ids in the shards up to and with this one
    for row in sizes.mapInArrow(measure, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n")).collect():
        before[row["shard"]] = row["n"]
    before = np.concatenate(([0], np.cumsum(before)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) // wide for x in batch.column(1)], np.int64)
            for rows in _grouped(batch, sizes):
                runs = [np.frombuffer(x.as_buffer(), kind) for x in rows.column(1)]
                n = np.array([len(r) for r in runs], np.int64)
                payloads, offsets = encode(np.concatenate(runs).astype(np.int64), n, lengths, codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard_of(rows.column(0)).astype(np.int32)), rows.column(0), pa.array(n),
                     pa.array(payloads, pa.binary()), list_array(offsets, pa.int64())],
                    ["shard", "doc_id", "n_tokens", "bits", "offsets"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}                            # a partition holds one shard, in order
        for batch in batches:
            starts = []
            for shard, n in zip(batch.column("shard").to_pylist(), batch.column("n_tokens").to_pylist(), strict=True):
                at = total.setdefault(shard, int(before[shard]))
                starts.append(at)
                total[shard] = at + n
            yield batch.append_column("start", pa.array(starts, pa.int64()))

    fields = "shard int, doc_id long, n_tokens long, bits binary, offsets array<long>"
    (ids.mapInArrow(pack, fields).repartitionById(shards, F.col("shard"))
     .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_last(), "n_tokens", "bits")
     .mapInArrow(place, f"{fields}, start long").write.parquet(os.path.join(path, "docs")))


def read_token_files(spark: SparkSession, path: str, as_bytes: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of the files: start counts the ids of all documents before.

    ``ids`` is array<int>, or little-endian unsigned 32-bit integers with ``as_bytes``.
    """
    code = spark.read.parquet(os.path.join(path, "code")).collect()          # bounded by the vocabulary
    max_bits = code[0]["max_bits"] if code else 1
    lengths = np.zeros(max([0, *(r["id"] for r in code)]) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths, max_bits)
        for batch in batches:
            for rows in _grouped(batch, batch.column("n_tokens").to_numpy(zero_copy_only=False)):
                n = rows.column("n_tokens").to_numpy(zero_copy_only=False)
                offsets = [x.values.to_numpy(zero_copy_only=False) for x in rows.column("offsets")]
                ids = decode([x.as_py() for x in rows.column("bits")], n, offsets, table, max_bits)
                parts = np.split(ids, np.cumsum(n)[:-1])
                held = (pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary()) if as_bytes
                        else list_array([p.astype(np.int32) for p in parts], pa.int32()))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", "start", "n_tokens")), held],
                                                 ["doc_id", "start", "n_tokens", "ids"])

    kind = "binary" if as_bytes else "array<int>"
    return spark.read.parquet(os.path.join(path, "docs")).mapInArrow(
        unpack, f"doc_id long, start long, n_tokens long, ids {kind}")
