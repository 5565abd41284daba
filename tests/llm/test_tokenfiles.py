import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from featurepipe.llm import tokenfiles as T

from helpers import frame

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def expected(rows, library):
    """[(doc_id, start, ids)] in ascending id order, from the library alone."""
    out, start = [], 0
    for i, t in sorted(rows):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_table_round_trip(spark, library, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    T.write_token_files(docs, f"{tmp_dir}/x", FILE, shards=5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.start, r.ids) for r in T.read_token_files(spark, f"{tmp_dir}/x").collect())
    assert got == expected(rows, library)
    crc = {r.doc_id: zlib.crc32(r.ids) for r in T.read_token_files(spark, f"{tmp_dir}/x", as_bytes=True).collect()}
    assert crc == {i: zlib.crc32(np.array(x, "<u4").tobytes()) for i, _, x in got}
    last = None
    for part in sorted(spark.read.parquet(f"{tmp_dir}/x/docs").select("shard").distinct().collect()):
        ids = [r.doc_id for r in spark.read.parquet(f"{tmp_dir}/x/docs").where(f"shard = {part.shard}").collect()]
        assert ids == sorted(ids) and (last is None or ids[0] > last)
        last = ids[-1]


def test_odd_texts_equal_the_library(spark, library, tmp_dir):
    odd = [None, "", " \n\t", "I'll don't 'S 12a3 \x0b\x0c x\x1cy", "é ́x   ÅΣΑΣ ΟΔΟΣ", "<|endoftext|> a<|startoftext|>b",
           "Word, WORD. word.. straße, ÄRGER. é, E\u0301, İstanbul, ΣΑΣ, don't. it's, ÿ. µm, ª, x× a.b c,d", "日本語テスト 😀👩‍👩‍👧", "a" * 20_000, "word " * 3000, " nbsp\u0085nel"]
    ids = list(range(len(odd)))
    T.write_token_files(frame(spark, odd, ids).selectExpr("*", "1 AS ids", "2 AS shard"), f"{tmp_dir}/x", FILE, shards=3)
    got = sorted((r.doc_id, r.start, r.ids) for r in T.read_token_files(spark, f"{tmp_dir}/x").collect())
    assert got == expected(zip(ids, odd, strict=True), library)


def test_ties_repeats_null_ids_and_empty_table(spark, tmp_dir):
    docs = frame(spark, ["b b", "a", "a", None, "c c c"], ids=[7, 7, 7, None, -3])
    T.write_token_files(docs, f"{tmp_dir}/x", FILE, shards=4)
    rows = sorted(((r.start, r.doc_id, r.n_tokens) for r in T.read_token_files(spark, f"{tmp_dir}/x").collect()))
    assert rows == [(0, -3, 4), (4, 7, 2), (6, 7, 2), (8, 7, 3), (11, None, 1)]
    T.write_token_files(frame(spark, []), f"{tmp_dir}/y", FILE)
    assert T.read_token_files(spark, f"{tmp_dir}/y").collect() == []


@pytest.mark.parametrize(("n", "limit"), [(1, 4), (2, 4), (5, 3), (300, 9), (40, 18)])
def test_code_is_optimal_under_its_limit(n, limit):
    rng = random.Random(n)
    counts = np.zeros(n + 7, np.int64)
    counts[rng.sample(range(n + 7), n)] = [int(2 ** rng.uniform(0, 30)) for _ in range(n)]
    lengths = T.code_lengths(counts, limit)
    used = lengths[lengths > 0].astype(float)
    assert len(used) == n and used.max() <= limit
    assert (2.0 ** -used).sum() <= 1
    if n > 1:
        assert (2.0 ** -used).sum() == 1
        # no better code: dynamic programming over sorted counts and codes of growing length
        assert int((counts * lengths).sum()) == best_cost(sorted(counts[counts > 0].tolist(), reverse=True), limit)
    ids = np.repeat(np.flatnonzero(lengths), 3)
    rng.shuffle(ids)
    sizes = np.array([0, len(ids) // 2, len(ids) - len(ids) // 2])
    bits, offsets = T.encode(ids, sizes, lengths, T.canonical_codes(lengths))
    assert T.decode(bits, sizes, offsets, T.decode_table(lengths, limit), limit).tolist() == ids.tolist()


def best_cost(counts, limit):
    """Cheapest prefix code of at most ``limit`` bits, by leaves taken per level of the tree."""
    from functools import cache
    total = [0]
    for c in counts:
        total.append(total[-1] + c)
    n = len(counts)

    @cache
    def cost(level, done, free):
        left = n - done
        if not left:
            return 0
        if level == limit:
            return 0 if left <= free else float("inf")
        best = float("inf")
        for leaves in range(min(left, free) + 1):
            nodes = min(2 * (free - leaves), n - done - leaves)
            if n - done - leaves and not nodes:
                continue
            best = min(best, total[n] - total[done + leaves] + cost(level + 1, done + leaves, nodes))
        return best
    return cost(0, 0, 1) if n <= 50 else greedy(counts, limit)


def greedy(counts, limit):
    """Plain Huffman cost, equal to the limited one where the limit does not bind."""
    import heapq
    heap = [(c, 0) for c in counts]
    heapq.heapify(heap)
    cost, depth = 0, 0
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        depth = max(x, y) + 1
        heapq.heappush(heap, (a + b, depth))
    return cost if depth <= limit else cost_by_packages(counts, limit)


def cost_by_packages(counts, limit):
    row = sorted((c, (i,)) for i, c in enumerate(counts))
    leaves = list(row)
    for _ in range(limit - 1):
        pairs = [(row[i][0] + row[i + 1][0], row[i][1] + row[i + 1][1]) for i in range(0, len(row) - 1, 2)]
        row = sorted(leaves + pairs, key=lambda x: x[0])
    return sum(c for c, _ in row[: 2 * len(counts) - 2])
