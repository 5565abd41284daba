import random

import pytest

from featurepipe.llm.linededup import LineRuns, dedup_lines

from helpers import ascii_lower, frame, prose

SPACE = " \t\n\x0b\x0c\r"


def oracle(rows, min_chars=10):
    held = {}
    keys = [[ascii_lower(line.strip(SPACE)) for line in (t or "").split("\n")] for _, t in rows]
    for (i, _), ks in zip(rows, keys, strict=True):
        for k in ks:
            if len(k) >= min_chars:
                held[k] = min(held.get(k, i), i)
    out = {}
    for (i, t), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [line for line, k in zip(lines, ks, strict=True) if len(k) < min_chars or held[k] == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def got(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in df.collect()}


@pytest.mark.parametrize(("seed", "batches", "fanout"), [(1, 1, 2), (2, 4, 2), (3, 7, 3)])
def test_equals_brute_force(spark, seed, batches, fanout):
    rng = random.Random(seed)
    shared = [" ".join(prose(rng, rng.choice([1, 2, 6]))) for _ in range(30)] + ["", "  ", "Grüße ÄÖ über", "GRÜßE äö ÜBER"]
    texts = []
    for _ in range(150):
        lines = [rng.choice(shared) if rng.random() < 0.4 else " ".join(prose(rng, 5)) for _ in range(rng.randrange(1, 12))]
        texts.append("\n".join(rng.choice(["", "\t", " \x0b"]) + rng.choice([x, x.upper(), x]) + rng.choice(["", "\r"]) for x in lines))
    ids = rng.sample(range(1000), len(texts))
    docs = frame(spark, texts, ids)
    assert got(dedup_lines(docs, batches=batches, fanout=fanout)) == oracle(list(zip(ids, texts, strict=True)))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    line = "a line of some length"
    texts = [None, "", line, line + "\n" + line, "\n\n", line, line + "\nx", line]
    docs = frame(spark, texts, ids=[1, 2, 5, 4, 6, 5, None, None])
    docs = docs.selectExpr("*", "7 AS n_lines", "8 AS ord", "9 AS gone", "'m' AS mark", "1 AS `a.b`")
    rows = dedup_lines(docs).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped, r.ord, r["a.b"]) for r in rows), key=str) == sorted([
        (1, "", 1, 0, 8, 1), (2, "", 1, 0, 8, 1), (4, line + "\n" + line, 2, 0, 8, 1), (5, "", 1, 1, 8, 1),
        (5, "", 1, 1, 8, 1), (6, "\n\n", 3, 0, 8, 1), (None, "x", 2, 1, 8, 1), (None, "", 1, 1, 8, 1)], key=str)


def test_empty_table_and_long_text(spark):
    assert dedup_lines(frame(spark, [])).collect() == []
    many = "\n".join(f"line number {i % 4000}" for i in range(30_000))
    assert got(dedup_lines(frame(spark, ["line number 7", many]))) == oracle([(0, "line number 7"), (1, many)])


def test_runs_are_levelled_and_hold_a_hash_once(spark):
    runs = LineRuns(spark, fanout=2)
    for n in range(5):
        runs.compact()
        runs.add(runs.fresh(spark.createDataFrame([(h, h, n) for h in range(n, n + 3)], "h1 long, h2 long, first long")))
    assert sorted(level for level, _ in runs.runs) == [0, 2]
    assert {r.h1: r.first for r in runs.table().collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2, 5: 3, 6: 4}
    assert runs.table().count() == 7
