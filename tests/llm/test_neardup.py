import random

import pytest

from featurepipe.llm import neardup
from featurepipe.llm.common import connected_components
from featurepipe.llm.neardup import near_duplicates

from helpers import frame, near_oracle, prose

SF = "/root/testdata/sf0.001"


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def edited(rng, base, share):
    out = list(base)
    for _ in range(max(1, int(share * len(out)))):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10_000)}"
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    """Copies, near copies on both sides of the threshold, chains, and a shared passage."""
    rng, texts = random.Random(seed), []
    passage = " ".join(prose(rng, 60))
    for _ in range(12):
        base = prose(rng, rng.choice([3, 4, 9, 40, 150, 400]))
        texts.append(" ".join(base))
        for share in (0, 0.005, 0.02, 0.03, 0.05, 0.08):
            texts.append(" ".join(edited(rng, base, share) if share else base).upper())
        step = base
        for _ in range(4):                                  # a chain whose ends are not alike
            step = edited(rng, step, 0.03)
            texts.append("\n".join(step))
    texts += [" ".join(prose(rng, 30)) + " " + passage + " " + " ".join(prose(rng, 20)) for _ in range(25)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert got(near_duplicates(frame(spark, texts), width=4)) == near_oracle(rows, 4)


def test_table_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert got(near_duplicates(docs, width=4)) == near_oracle(rows, 4)


def test_nulls_empties_repeats_and_clashing_columns(spark):
    texts = [None, "", "  \t\n", "one", "ONE", "one two three four five", "one two three four five", "Ångström É", "ångström é", None]
    docs = frame(spark, texts, ids=[5, 6, 7, 9, 8, 3, 3, 10, 11, None])
    docs = docs.selectExpr("*", "1 AS id", "2 AS n", "3 AS component", "4 AS value", "5 AS sketch")
    out = near_duplicates(docs, width=4).collect()
    assert len(out) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in out} == {
        5: (0, 5, True), 6: (0, 6, True), 7: (0, 7, True), 8: (1, 8, True), 9: (1, 8, False), 3: (2, 3, True),
        10: (1, 10, True), 11: (1, 11, True), None: (0, None, True)}


def test_empty_table(spark):
    assert near_duplicates(frame(spark, []), width=4).collect() == []


def test_long_text_and_hot_group(spark):
    rng = random.Random(3)
    base = prose(rng, 300)
    texts = [" ".join(edited(rng, base, 0.004)) for _ in range(150)] + [" ".join(prose(rng, 60_000))]
    assert got(near_duplicates(frame(spark, texts), width=4)) == near_oracle(list(enumerate(texts)), 4)


def test_pieces_of_a_group_lose_no_link(spark, monkeypatch):
    """A group of many pieces: around one text, and pairs that are only alike to one another."""
    monkeypatch.setattr(neardup, "PIECE", 8)
    rng = random.Random(9)
    base = prose(rng, 120, 5000)
    texts = [" ".join(base)]
    for k in range(40):
        far = edited(rng, base, 0.06)
        texts += [" ".join(far), " ".join(edited(rng, far, 0.01 if k % 2 else 0.05))]
    rng.shuffle(texts)
    want = near_oracle(list(enumerate(texts)), 4)
    assert len({c for _, c in want.values()}) > 10
    assert got(near_duplicates(frame(spark, texts), width=4)) == want


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (60, 59)]
    out = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 59: 59, 60: 59}
