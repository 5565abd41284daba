import random
import re

import numpy as np
import pytest

from featurepipe.llm.decontam import FMIndex, WaveletMatrix, contamination, remove_contamination

from helpers import ascii_lower, frame, prose


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def windows(items):
    out = {}
    for i, t in items:
        w = tokens(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            out.setdefault(tuple(w[j:j + 10]), set()).add(str(i))
    return out


def oracle(text, wins):
    w, hit, items = tokens(text), set(), set()
    for g, own in wins.items():
        for i in range(len(w) - len(g) + 1):
            if tuple(w[i:i + len(g)]) == g:
                hit.update(range(i, i + len(g)))
                items |= own
    return len(w), len(hit), sorted(items)


def planted(rng):
    items = [(i, " ".join(prose(rng, rng.choice([1, 4, 10, 14, 40]), 5000))) for i in range(20)]
    items += [(20, items[3][1]), (21, None), (22, "?!"), (23, "ÉÜ über, straße"), (24, "")]
    texts = [None, "", "--", "ÉÜ ÜBER straße"]
    for _ in range(60):
        w = prose(rng, rng.randrange(80), 5000)
        for _ in range(rng.randrange(3)):
            item = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(item) + 1)
            w[rng.randrange(len(w) + 1):0] = item[at if rng.random() < 0.3 else 0:]
        texts.append("".join(x.upper() + rng.choice([" ", ", ", "\n", "--"]) for x in w))
    return items, texts


@pytest.mark.parametrize(("seed", "block"), [(1, 1 << 20), (2, 200)])
def test_equals_brute_force(spark, seed, block):
    items, texts = planted(random.Random(seed))
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = windows(items)
    out = {r.doc_id: r for r in contamination(frame(spark, texts), bench, block_bytes=block).collect()}
    assert {i: (r.n_words, r.n_hit, r.items) for i, r in out.items()} == {i: oracle(t, wins) for i, t in enumerate(texts)}
    for r in out.values():
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_hit
        assert all(x < y for x, y in zip(r.spans, r.spans[1:]))


def test_removal_leaves_nothing_and_keeps_the_rest(spark):
    rng = random.Random(4)
    items, texts = planted(rng)
    item = [f"q{i}" for i in range(12)]
    items.append((99, " ".join(item)))
    texts.append(" ".join([*item[:6], *item, *item[6:]]))        # a cut joins a new occurrence
    texts.append("Clean text; stays – as it is.\n")
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = windows(items)
    docs = frame(spark, texts).selectExpr("*", "1 AS items", "2 AS item_id")
    out = {r.doc_id: r for r in remove_contamination(docs, bench).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        assert oracle(out[i].text, wins)[1] == 0
        if oracle(t, wins)[1] == 0:
            assert out[i].text == t
    assert out[0].text is None and out[0]["items"] == 1


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r.doc_id, r.n_words, r.n_hit, r.items) for r in contamination(frame(spark, ["a b"]), bench).collect()] == [(0, 2, 0, [])]
    assert contamination(frame(spark, []), bench).collect() == []
    assert remove_contamination(frame(spark, ["a b"]), bench).first().text == "a b"


def test_index_finds_and_locates():
    rng = np.random.default_rng(3)
    for _ in range(20):
        text = np.append(rng.integers(0, 5, rng.integers(1, 300)), 0)
        tree = WaveletMatrix(text, 3)
        at = np.arange(len(text))
        sym, before = tree.access(at)
        assert sym.tolist() == text.tolist()
        assert before.tolist() == [(text[:i] == text[i]).sum() for i in at]
        index = FMIndex(text, 4)
        phrases = rng.integers(1, 5, (30, 3))
        low, high = index.ranges(phrases)
        for p, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(len(text) - 2) if (text[i:i + 3] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_blocks_go_out_one_at_a_time(spark, monkeypatch):
    from featurepipe.llm import decontam
    from featurepipe.session import _MATERIALIZED
    items, texts = planted(random.Random(9))
    live, most = [0], [0]
    made = decontam._Blocks.shared

    def shared(self, k):
        b = made(self, k)
        live[0] += 1
        most[0] = max(most)
        most.append(live[0])
        gone = b.destroy

        def destroy(blocking=False):
            live[0] -= 1
            gone(blocking)
        b.destroy = destroy
        return b

    monkeypatch.setattr(decontam._Blocks, "shared", shared)
    bench = spark.createDataFrame(items, "item_id long, text string")
    before = len(_MATERIALIZED.get(spark.sparkContext.applicationId, []))
    out = contamination(frame(spark, texts), bench, block_bytes=100)
    wins = windows(items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.items) for r in out.collect()} == {i: oracle(t, wins) for i, t in enumerate(texts)}
    assert len(most) > 5 and max(most) == 1 and live[0] == 0
    assert len(_MATERIALIZED[spark.sparkContext.applicationId]) == before + 1      # the result alone
