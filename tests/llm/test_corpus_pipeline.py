import random

import corpus_pipeline
from featurepipe.llm.pieces import PieceCodec
from featurepipe.session import materialize

import test_decontam
import test_linededup
import test_repetition
from helpers import frame, near_oracle, prose
from test_pieces import MODEL

SF = "/root/testdata/sf0.001"


def brute(rows, items):
    """{doc_id: (ids, text)} stage by stage, in plain Python (cuts by word places)."""
    rows = [(i, t) for i, t in rows if test_repetition.oracle(t)[-1]]
    lines = test_linededup.oracle(rows)
    rows = [(i, lines[i][2]) for i, _ in rows]
    near = near_oracle(rows, 5)
    rows = [(i, t) for i, t in rows if near[i][1] == i]
    wins = test_decontam.windows(items)
    lib = PieceCodec(MODEL).library
    out = {}
    for i, t in rows:
        while True:
            cut = cut_hits(t, wins)
            if cut == t:
                break
            t = cut
        out[i] = lib.encode(t, add_eos=True)
    return out


def cut_hits(text, wins):
    import re
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text))
    w = [test_decontam.ascii_lower(m[0]) for m in found]
    hit = set()
    for n in {len(g) for g in wins}:
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
    out, at, p = "", 0, 0
    while p < len(w):
        if p in hit:
            out += text[at:found[p].start()]
            while p < len(w) and p in hit:
                p += 1
            at = found[p - 1].end()
        else:
            p += 1
    return out + text[at:]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == brute(sorted((r.doc_id, r.text) for r in docs), items)


def test_stages_handle_odd_rows_and_keep_columns(spark):
    rng = random.Random(1)
    clean = [" ".join(prose(rng, 60, 5000)) for _ in range(6)]
    texts = [*clean, clean[0] + " end", clean[1], None, "", "a b", clean[2], clean[3]]
    ids = [0, 1, 2, 3, 4, 5, 6, 1, 8, 9, 10, None, None]
    docs = frame(spark, texts, ids).selectExpr("*", "1 AS id", "2 AS n_lines", "3 AS ids", "4 AS _row", "5 AS items")
    columns = docs.columns
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        sizes.append(docs.count())
        if name != "tokenize":
            assert docs.columns == columns
    # nulls and short texts fail the rules; ids 2 and 3 keep their lines, the null-id copies lose theirs
    assert sizes == [10, 10, 8, 8, 8]


def test_stages_take_an_empty_table(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.count() == 0


def test_near_dedup_judges_texts_not_ids(spark):
    rng = random.Random(2)
    a, b, c, d = (" ".join(prose(rng, 60, 5000)) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (2, b + " end"), (3, c), (3, c + " more"), (None, a), (None, d), (None, d), (None, " "), (None, " "),
            (4, None), (4, ""), (5, d)]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows]).selectExpr("*", "1 AS _key", "2 AS _id")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    third = [t for i, t in got if i == 3]
    assert len(third) == 1 and third[0] in (c, c + " more")
    assert [r for r in got if r[0] != 3] == sorted([(1, a), (1, b), (4, None), (4, ""), (5, d), (None, " "), (None, " ")], key=str)
