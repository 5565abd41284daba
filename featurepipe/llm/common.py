"""Shared helpers of the text operators: batches of whole texts, word hashes, components.

Python tasks take whole texts in groups of bounded size (a longer text is a group of its own),
so a task's memory follows the group size and its longest text, never its partition.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from featurepipe.session import materialized, release

ASCII_SPACE = " \t\n\x0b\x0c\r"          # [\x20\x09-\x0D], what bytes.split() splits at
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GROUP_CHARS = 4 << 20                    # characters of text that a task handles at once


def text_groups(batch: pa.RecordBatch, column: str, limit: int = GROUP_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of ``batch`` with at most ``limit`` characters of text each (one text at least),
    with their texts as a list (None for null)."""
    col = batch.column(batch.schema.get_field_index(column))
    start, held = 0, 0
    texts: list = []
    for i in range(len(col)):
        text = col[i].as_py()
        size = len(text) if text else 0
        if texts and held + size > limit:
            yield batch.slice(start, i - start), texts
            start, held, texts = i, 0, []
        texts.append(text)
        held += size
    if texts:
        yield batch.slice(start), texts


def worker_cache(name: str) -> dict:
    """A dictionary that the tasks of one Python worker share; it lives as long as the process.

    What it holds must only save work: a new worker starts with an empty one. Users bound it.
    """
    held = sys.modules.setdefault("_text_worker_cache", ModuleType("_text_worker_cache"))
    return held.__dict__.setdefault(name, {})


class Remembered(dict):
    """Values by key, of which a worker holds about ``limit`` bytes: two halves, of which the older goes
    when the newer is full and what is still asked for moves over. Keys and values have lengths."""

    ENTRY = 200                              # bytes of a key, a value and their place without their contents

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.size, self.old = limit, 0, {}

    def missing(self, keys: Iterable) -> list:
        """Those of ``keys`` (each once) that must be put before any key of this call is looked up."""
        if self.size > self.limit // 2:
            self.old, self.size = dict(self), 0
            self.clear()
        out = []
        for k in set(keys).difference(self):
            v = self.old.get(k)
            if v is None:
                out.append(k)
            else:
                self.put(k, v)
        return out

    def put(self, key, value) -> None:
        self[key] = value
        self.size += self.ENTRY + len(key) + len(value)

    def put_all(self, keys: list, values: list) -> None:
        self.update(zip(keys, values, strict=True))
        self.size += len(keys) * self.ENTRY + sum(map(len, keys)) + sum(map(len, values))


def byte_slices(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Arrow binary array of the slices of ``data`` from each start (ascending, the first 0) to the next."""
    ends = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def looked_up(keys: pa.Array, known: Remembered, learn: Callable[[list], None], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that ``known`` holds, packed, for each of ``keys`` in turn, and how many each has.
    Different keys are looked up once; ``learn`` puts those that are not known."""
    coded = keys.dictionary_encode()
    different = coded.dictionary.to_pylist()
    learn(known.missing(different))
    packed = list(map(known.__getitem__, different))
    values = np.frombuffer(b"".join(packed), kind)
    size = np.fromiter(map(len, packed), np.int64, len(packed)) // kind.itemsize
    which = coded.indices.to_numpy()
    n = size[which]
    shift = (np.cumsum(size) - size)[which] - (np.cumsum(n) - n)
    return values[np.arange(int(n.sum())) + np.repeat(shift, n)], n


def closed(values: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``sizes`` values with ``end`` after each, and their sizes."""
    sizes = sizes + 1
    out = np.empty(len(values) + len(sizes), values.dtype)
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner], out[last] = values, end
    return out, sizes


def in_order(parts: list[tuple[list[int], np.ndarray, np.ndarray]], n: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several parts (places, values, sizes) by their places 0..n-1."""
    if len(parts) == 1:
        return parts[0][1:]
    runs: list = [None] * n
    for places, values, sizes in parts:
        for k, run in zip(places, np.split(values, np.cumsum(sizes)[:-1]), strict=True):
            runs[k] = run
    return np.concatenate(runs) if runs else np.empty(0, kind), np.array([len(r) for r in runs], np.int64)


class WordHashes(dict):
    """Word bytes -> signed 64-bit hash, remembered per task up to a bound in bytes."""

    BOUND = 128 << 20

    def __init__(self):
        super().__init__()
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        self.size += 160 + len(word)
        if self.size > self.BOUND:
            self.clear()
            self.size = 160 + len(word)
        h = xxh3_64_intdigest(word)
        h = self[word] = h - (1 << 64) if h >> 63 else h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


class WordIds(dict):
    """Word bytes -> small integer, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrow list array with one list per numpy array."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of ``edges``, component being its smallest node.

    Alternating large-star and small-star rounds: each is two joins on a node with that node's
    smallest neighbour, which grouped partial aggregation finds without gathering a hub's edges.
    The edge set is written each round in the shared folder, where the round before it goes, and the
    rounds end when it no longer changes. Null ends are dropped, loops ignored, repeated edges count once.
    """
    edge = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    spark = edges.sparkSession
    before = None
    edge, folder = materialized(edge, "components")
    while True:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        last, (edge, folder) = folder, materialized(small, "components")
        release(spark, last)
        now = edge.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edge.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
