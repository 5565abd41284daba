import random
import re

import numpy as np
import public_tokenizers
import pytest

from featurepipe.llm import edits as E

from helpers import frame

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ALPHABET = ["a", "the ", " ", "  ", "\n", "\n\n", "é", "'s", "12", "!?", "\t", "日", "\u00a0", "\u2003", "\x1c", "\x85", "word ", "x" * 40]


@pytest.fixture(scope="module")
def count():
    return E.TokenCounter(RANKS, PATTERN)


def text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_segments_count_alone(count, monkeypatch):
    monkeypatch.setattr(E, "SEGMENT", 5)
    rng = random.Random(1)
    for _ in range(400):
        t = text(rng, rng.randrange(60))
        parts = E.segments(t)
        assert "".join(parts) == t
        assert sum(map(count, parts)) == count.whole(t), repr(t)


def test_edits_equal_a_full_recount(count, monkeypatch):
    monkeypatch.setattr(E, "SEGMENT", 6)
    rng = random.Random(2)
    for _ in range(150):
        t = text(rng, rng.randrange(80))
        parts = E.segments(t)
        held = E.EditedText(parts, E.SegmentTree.build([len(p) for p in parts], [count(p) for p in parts]), count)
        for _ in range(12):
            start = rng.randrange(-2, len(t) + 3)
            end = start + rng.choice([0, 1, 3, 30])
            new = text(rng, rng.choice([0, 1, 6]))
            lo = min(max(0, start), len(t))
            hi = min(max(lo, end), len(t))
            t = t[:lo] + new + t[hi:]
            held.edit(start, end, new)
            assert "".join(held.parts) == t
            assert held.tree.tokens[1] == count.whole(t), repr(t)
            assert held.tree.chars[1] == len(t)
            for heap in (held.tree.tokens, held.tree.chars):
                assert all(heap[i] == heap[2 * i] + heap[2 * i + 1] for i in range(1, held.tree.size))


def test_only_touched_segments_are_encoded(count):
    t = "some words here " * 5000
    parts = E.segments(t)
    held = E.EditedText(parts, E.SegmentTree.build([len(p) for p in parts], [count(p) for p in parts]), count)
    held.edit(40_000, 40_004, "other")
    assert held.encoded < 2 * E.SEGMENT
    assert held.tree.tokens[1] == count.whole(t[:40_000] + "other" + t[40_004:])


def test_table_with_contact_edits(spark, count):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pattern = re.compile("|".join(f"({p})" for p in E.CONTACTS.values()))
    tags = list(E.CONTACTS)
    rows = E.apply_edits(E.contact_edits(E.count_tokens(docs, RANKS, PATTERN)), RANKS, PATTERN).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    fields = ["doc_id", "text", "n_tokens_before", "n_tokens", "n_edits", "n_encoded"]
    once = E.recount_contacts(docs, RANKS, PATTERN).select(*fields)
    assert sorted(map(tuple, once.collect())) == sorted(tuple(r[f] for f in fields) for r in rows)
    assert len(rows) == len(texts) and sum(r.n_edits for r in rows) > 10
    for r in rows:
        want = pattern.sub(lambda m: tags[m.lastindex - 1], texts[r.doc_id])
        assert (r.text, r.n_tokens_before, r.n_tokens) == (want, count.whole(texts[r.doc_id]), count.whole(want))


def test_edit_table_nulls_repeats_and_empty_table(spark, count):
    docs = frame(spark, [None, "", "one two", "one two", "x"], ids=[1, 2, 3, 3, None]).selectExpr("*", "1 AS n_tokens", "2 AS seq", "3 AS new")
    log = spark.createDataFrame([(3, 2, 0, 3, "1"), (3, 1, 99, 99, " end"), (2, 1, 0, 0, "hi there"), (1, 1, 0, 5, None), (None, 1, 0, 1, "y")],
                                "doc_id long, seq int, start long, end long, new string")
    counted = E.count_tokens(docs, RANKS, PATTERN)
    out = E.apply_edits(E.attach_edits(counted, log), RANKS, PATTERN).collect()
    assert sorted(((r.doc_id, r.text, r.n_tokens, r.n_edits) for r in out), key=str) == sorted(
        [(1, "", 0, 1), (2, "hi there", count.whole("hi there"), 1), (3, "1 two end", count.whole("1 two end"), 2),
         (3, "1 two end", count.whole("1 two end"), 2), (None, "x", 1, 0)], key=str)
    empty = E.count_tokens(frame(spark, []), RANKS, PATTERN)
    assert E.apply_edits(E.contact_edits(empty), RANKS, PATTERN).collect() == []
    assert np.array_equal(E.SegmentTree.build([3], [1]).chars, [0, 3]) or E.SegmentTree.build([3], [1]).chars[1] == 3
