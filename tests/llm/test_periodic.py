import hashlib
import random
import zlib

import numpy as np
import pytest
from featurepipe.llm.periodic import COVER, MODULUS, CommonExtensions, collapse_runs, planted
from helpers import frame, sha, words


def runs_of(w, exponent=4, least=6):
    """Runs by looking at every word for every period."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def expected(doc_id, text, plant=True):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def repetitive(rng):
    kinds = rng.choice([1, 2, 3, 30])
    out = []
    for _ in range(rng.randrange(0, 9)):
        out += [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, 12))] * rng.choice([1, 1, 2, 4, 9])
    return out


def test_cover_meets_all_distances():
    assert {(a - b) % MODULUS for a in COVER for b in COVER} == set(range(MODULUS))


def test_common_extensions_equal_comparison():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(1, rng.choice([2, 3, 9]) + 1) for _ in range(rng.randrange(2, 80))] for _ in range(3)]
        keys = np.array([x for t in texts for x in [*t, 0]])
        pairs, at = [], 0
        for t in texts:
            pairs += [(at + i, at + j) for i in range(len(t)) for j in range(i + 1, len(t))]
            at += len(t) + 1
        i, j = np.array(pairs).T
        got = CommonExtensions(keys).of(i, j)
        for a, b, n in zip(i, j, got, strict=True):
            k = 0
            while keys[a + k] == keys[b + k] and keys[b + k]:
                k += 1
            assert k == n


def test_query_equals_brute_force(spark, tmp_path):
    from featurepipe.llm.queries import op11_periodic_runs
    rng = random.Random(4)
    texts = [" ".join(repetitive(rng)) for _ in range(150)]
    texts += [None, "", " \n\t ", "a " * 6, "a " * 5, "a b " * 4, "﻿x é\x0bé x y", "x " * 3000, " ".join(f"w{i % 700}" for i in range(2900)),
              " ".join(f"u{i}" for i in range(2000))]
    texts += texts[:5]
    ids = [*range(len(texts) - 1), 3]
    frame(spark, texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, *r[1:]) for r in op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    want = sorted((i, *expected(i, t)) for i, t in zip(ids, texts, strict=True))
    key = str
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 60


@pytest.mark.parametrize("doc_id", [None, 0, 7, 18, -3])
def test_planting(doc_id):
    w = [b"%d" % i for i in range(50)]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    assert (planted(doc_id, w) == w) == (h % 10 != 0 or planted(doc_id, w) == w)
    assert planted(doc_id, []) == []


def test_odd_rows(spark):
    df = frame(spark, ["a a a a a a b", None, "x"], [None, 2, 2]).selectExpr("*", "1 AS runs", "'q' AS start", "0 AS period")
    out = sorted(((r.doc_id, r.n_runs, r.text) for r in collapse_runs(df).collect()), key=str)
    assert out == sorted([(None, 1, "a b"), (2, 0, ""), (2, 0, "x")], key=str)
    assert collapse_runs(df.limit(0)).collect() == []
