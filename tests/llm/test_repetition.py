import random

import numpy as np
import pytest

from featurepipe.llm.repetition import repetition_report
from featurepipe.llm.suffixes import suffix_ranks

from helpers import frame, prose, words


def oracle(text, window=8):
    w = words(text)
    seen, hit, longest = {}, set(), 0
    for i in range(len(w) - window + 1):
        seen.setdefault(tuple(w[i:i + window]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(p + o for p in at for o in range(window))
            for x in range(len(at)):
                for y in range(x):
                    n = 0
                    while max(at[x], at[y]) + n < len(w) and w[at[x] + n] == w[at[y] + n]:
                        n += 1
                    longest = max(longest, n)
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    chars = sum(map(len, w))
    covered = sum(len(w[p]) for p in hit)
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), covered,
            longest, failed, not failed and 100 * covered <= 30 * chars and longest <= 100)


def got(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.repeat_chars,
                       r.longest_repeat, r.base_failed, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng, texts = random.Random(seed), [None, "", " \t\n", "é " * 7, "ü ß\n" * 30, "a " * 300, "x" * 5000]
    for _ in range(60):
        w = prose(rng, rng.randrange(1, 400), rng.choice([2, 5, 300]))
        for _ in range(rng.randrange(3)):
            at, n = rng.randrange(len(w)), rng.randrange(150)
            w[rng.randrange(len(w)):0] = w[at:at + n]
        texts.append("".join(x + rng.choice([" ", "  ", "\n", "\t", " #|  "]) for x in w))
    docs = frame(spark, texts).selectExpr("*", "1 AS kept", "2 AS n_words")
    assert got(repetition_report(docs)) == {i: oracle(t) for i, t in enumerate(texts)}


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = frame(spark, ["a b c", "a b c"], ids=[None, None])
    assert [(r.doc_id, r.n_words, r.kept) for r in repetition_report(docs).collect()] == [(None, 3, False)] * 2
    assert repetition_report(frame(spark, [])).collect() == []


def test_maximal_repeats_are_counted_once_an_occurrence(spark):
    part = [f"p{i}" for i in range(12)]
    text = " ".join([*part, "x", *part, "y", *(f"z{i}" for i in range(100))])
    row = repetition_report(frame(spark, [text])).first()
    assert (row.n_repeats, row.longest_repeat, row.n_repeat_words, row.kept) == (2, 12, 24, True)


def test_suffix_ranks():
    rng = random.Random(5)
    for _ in range(50):
        keys = [rng.randrange(3) for _ in range(rng.randrange(1, 60))] + [0]
        places = [k if k else -len(keys) + i for i, k in enumerate(keys)]
        order = sorted(range(len(keys)), key=lambda i, p=places: p[i:])
        assert np.argsort(suffix_ranks(np.array(keys))).tolist() == order
