import random
import re
import zlib
from collections import Counter

import numpy as np
from featurepipe.llm.variants import group_variants, near_pairs, word_counts
from helpers import ascii_lower, frame


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, plant=97):
    n = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if plant and h % plant == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= 3}


def grouped(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def spellings(rng, stems, count, letters="aeiostrné"):
    out = []
    for _ in range(count):
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]])
        out.append(w)
    return out


def test_scan_equals_all_pairs():
    rng = random.Random(2)
    for _ in range(100):
        letters = rng.choice(["ab", "abc", "abcdé"])
        rows = sorted({(rng.randrange(3), "".join(rng.choice(letters) for _ in range(rng.randrange(1, 7)))) for _ in range(60)})
        x, y = near_pairs(np.array([k for k, _ in rows]), np.array([w for _, w in rows]), np.arange(len(rows)))
        got = list(zip(x.tolist(), y.tolist(), strict=True))
        assert len(got) == len(set(got))
        assert set(got) == {(i, j) for i, (k, a) in enumerate(rows) for j, (m, b) in enumerate(rows) if k == m and a != b and one_edit(a, b)}


def test_query_equals_brute_force(spark, tmp_path):
    from featurepipe.llm.queries import op13_spelling_variants
    rng = random.Random(8)
    stems = ["".join(rng.choice("aeiostrné") for _ in range(rng.randrange(4, 11))) for _ in range(40)]
    texts = [" ".join(spellings(rng, stems, 60)) for _ in range(60)]
    texts += [None, "", "ABCDE abcde Abcde, abcdé-ABCDÉ×abcde÷x", "āabcdeſabcde x1abcde2", "aaaaa " * 50 + "aaaaaa " * 20 + "aaaaaaa " * 5]
    rows = list(enumerate(texts)) + [(3, "abcde " * 9), (None, "abcde abcdf")]
    frame(spark, [t for _, t in rows], [i for i, _ in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op13_spelling_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    want = grouped(counted(rows))
    assert got == want
    assert sum(w[1] is not None for w in want) > 30 and any(w[1] not in (None, w[2]) for w in want)


def test_long_lists_are_parted_exactly(spark):
    rng = random.Random(5)
    # a third of the words share a long beginning, others a long end
    words = {"prefix" + w for w in spellings(rng, ["stone", "seats"], 400)} | {w + "suffix" for w in spellings(rng, ["trees"], 200)}
    words |= set(spellings(rng, ["aeiost", "onestar"], 300))
    n = {w: rng.randrange(3, 300) for w in words if len(w) >= 5}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    want = grouped(n)
    for longest in (20_000, 30, 3):
        got = sorted(map(tuple, group_variants(df, longest_list=longest).collect()))
        assert got == want


def test_odd_tables(spark):
    df = frame(spark, ["abcde abcde abcde", None]).selectExpr("*", "1 AS word", "2 AS n", "3 AS near")
    assert group_variants(word_counts(df)).collect() == [("abcde", None, "abcde", 3, 0, None)]
    assert group_variants(word_counts(df.limit(0))).collect() == []
