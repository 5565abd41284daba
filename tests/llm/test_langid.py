import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurepipe.llm.langid import EMBED, WIDTHS, ByteNet, has_letter, held_out, predict_language, train_language_id, windows

from helpers import frame


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = train_language_id(docs.where(~held_out()))
    out = predict_language(docs, net, keep=("doc_id", "lang")).where(held_out())
    rows = out.collect()
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_pair_tables_give_the_same_answers():
    rng = np.random.default_rng(1)
    net = ByteNet.fresh(["a", "b", "c"], rng)
    x = rng.integers(0, 256, (20, 256)).astype(np.uint8)
    z = np.concatenate([a.max(1) for a in net.answers(x)], 1)
    h = np.maximum(z + net.bias, 0) @ net.out + net.out_bias
    p = np.exp(h) / np.exp(h).sum(1, keepdims=True)
    assert np.allclose(net.probabilities(x, net.pair_tables()), p, atol=1e-5)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    net = ByteNet.fresh(["a", "b"], rng)
    x, y = rng.integers(1, 40, (3, 12)).astype(np.uint8), np.array([0, 1, 0])

    def loss():
        z = np.concatenate([a.max(1) for a in net.answers(x)], 1)
        h = np.maximum(z + net.bias, 0) @ net.out + net.out_bias
        return -np.mean([h[i, k] - np.log(np.exp(h[i]).sum()) for i, k in enumerate(y)])

    grads = net._gradients(x, y)
    for param, grad in zip([net.embed, *net.filters, net.bias, net.out, net.out_bias], grads, strict=True):
        flat, g = param.reshape(-1), grad.reshape(-1)
        for i in rng.choice(len(flat), min(12, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-4)
    assert len(net.filters) == len(WIDTHS) and net.embed.shape == (256, EMBED)


def test_windows_cover_the_whole_text():
    text = "ÄB" * 1000
    assert windows(text).tobytes().rstrip(b"\0") == text.lower().encode()
    assert windows("").shape == (1, 256)


def test_odd_rows_and_tables(spark):
    rng = random.Random(3)
    words = {"xx": ["aba", "bab", "abba"], "yy": ["cdc", "dcd", "deed"]}
    texts = [" ".join(rng.choices(words[k % 2 and "xx" or "yy"], k=30)) for k in range(40)]
    docs = frame(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "xx").otherwise("yy"))
    net = train_language_id(docs.unionByName(frame(spark, [None, "aba"], [None, 70]).withColumn("lang", F.lit(None).cast("string"))))
    odd = frame(spark, [None, "", "12 -- 3!", "aba bab", "cdc " * 5000, "aba bab"], [1, 2, None, 4, 5, 4])
    rows = predict_language(odd.selectExpr("*", "1 AS score", "2 AS _x"), net).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in rows) == [
        ("1", "und"), ("2", "und"), ("4", "xx"), ("4", "xx"), ("5", "yy"), ("None", "und")]
    empty = frame(spark, [])
    assert train_language_id(empty) is None
    assert predict_language(empty, net).collect() == []
    assert predict_language(odd, None).where("lang_pred = 'und'").count() == 6


def test_the_sample_is_bounded_and_the_same_for_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = train_language_id(docs, per_language=5, epochs=1)
    b = train_language_id(docs.repartition(7), per_language=5, epochs=1)
    assert all(np.array_equal(x, y) for x, y in zip(a.filters, b.filters, strict=True))


def test_letters_are_category_l():
    import unicodedata
    for cp in [*range(0x3000), *range(0x1F000, 0x1F400), *range(0x10000, 0x10400)]:
        if not 0xD800 <= cp < 0xE000:
            assert has_letter(f"1 {chr(cp)}_") == unicodedata.category(chr(cp)).startswith("L")


def test_answers_equal_a_direct_convolution():
    rng = np.random.default_rng(5)
    net = ByteNet.fresh(["a", "b", "c"], rng)
    x = rng.integers(0, 256, (4, 256)).astype(np.uint8)
    got = net.probabilities(x, net.pair_tables())
    for row, p in zip(x, got, strict=True):
        best = []
        for width, kernel in zip(WIDTHS, net.filters, strict=True):
            answers = [sum(net.embed[row[i + k]] @ kernel[k] for k in range(width)) for i in range(len(row) - width + 1)]
            best.append(np.max(answers, axis=0))
        h = np.maximum(np.concatenate(best) + net.bias, 0) @ net.out + net.out_bias
        assert np.allclose(np.exp(h - h.max()) / np.exp(h - h.max()).sum(), p, atol=1e-5)
