import random

import numpy as np
import public_tokenizers
import pytest

from featurepipe.llm.pieces import PieceCodec, encode_pieces

from helpers import frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a", " a", "a ", "  a  b\tc\n", "\n\n x", "▁", "a▁b ▁ c", "<s>hi</s><0x41><unk>", "ﬁ é é 　 x",
       "\x00\x01", "😀👩‍👩‍👧 日本語", "x" * 3000, "aaa aaaa " * 50, "1234567890 " * 9, "    def f():\n        return\n"]


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def test_ids_and_text_equal_the_library(codec):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" ▁ aeéß\n日😀ther—") for _ in range(rng.randrange(60))) for _ in range(400)]
    lib = codec.library
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids == lib.encode(t, add_eos=True), t
        assert codec.decode(ids) == lib.decode(ids), t


def test_decoding_any_ids_equals_the_library(codec):
    rng = random.Random(2)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 259, 28705]) for _ in range(rng.randrange(12))]
        assert codec.decode(ids) == codec.library.decode(ids), ids


def test_table_of_texts_equals_the_library(codec):
    rng = random.Random(3)
    for _ in range(60):
        runs = [[rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 259, 28705]) for _ in range(rng.randrange(9))]
                for _ in range(rng.randrange(5))]
        runs += [x for x in codec.encode([rng.choice(ODD) for _ in range(rng.randrange(5))])]
        flat = np.array([i for r in runs for i in r], np.int32)
        assert codec.texts(flat, np.array([len(r) for r in runs], np.int64)).to_pylist() == [codec.library.decode(r) for r in runs]


def test_memory_is_bounded_by_bytes():
    codec = PieceCodec(MODEL)
    codec.known.limit = 1 << 20
    rng = random.Random(4)
    for k in range(30):                                        # texts without a space are one unit each
        texts = ["".join(rng.choice("abcdefgh") for _ in range(20_000)) for _ in range(5)] + [f"w{k} w{k}x"]
        assert codec.encode(texts[-1:])[0] == codec.library.encode(texts[-1], add_eos=True)
        codec.encode(texts)
        held = sum(len(x) + len(y) for d in (codec.known, codec.known.old) for x, y in d.items())
        assert held <= (1 << 20) + 6 * sum(map(len, texts))      # a group of texts may go beyond each half


def test_table_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib = PieceCodec(MODEL).library
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = encode_pieces(docs, MODEL).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.ids == lib.encode(texts[r.doc_id], add_eos=True)
        assert r.decoded == lib.decode(r.ids)


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    docs = frame(spark, [None, "", "a b", "a b"], ids=[1, None, 3, 3]).selectExpr("*", "1 AS ids", "2 AS decoded")
    rows = sorted(((r.doc_id, r.ids, r.decoded) for r in encode_pieces(docs, MODEL).collect()), key=str)
    assert rows == sorted([(1, [2], ""), (None, [2], ""), (3, [264, 287, 2], "a b"), (3, [264, 287, 2], "a b")], key=str)
    assert encode_pieces(frame(spark, []), MODEL).collect() == []


def test_a_difference_from_the_library_fails(codec):
    other = PieceCodec(MODEL)
    other.score = {k: -v for k, v in other.score.items()}
    with pytest.raises(AssertionError, match="agenda"):
        other.encode(["therefore whatever international statistics understanding"])
