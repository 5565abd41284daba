import math


from featurepipe.config import NULL_SENTINELS
from featurepipe.functions import has_match, null_if_sentinel, py_strip, strip_accents, to_number, word_count


def test_lenient_number_edge_cases(spark):
    # expected values as measured for pandas to_numeric(errors="coerce")
    cases = [(" 12 ", 12.0), ("1e3", 1000.0), ("12.5", 12.5), ("inf", math.inf), ("1d", None), ("1f", None),
             ("1L", None), ("nan", None), ("NaN", None), ("1_000", None), ("0x1A", None), ("", None),
             ("abc", None), (None, None), ("-.5", -0.5), ("+3", 3.0), ("\t7\n", 7.0), ("-Infinity", -math.inf)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r[0] for r in df.select(to_number("s")).collect()]
    assert got == [e for _, e in cases]


def test_sentinels_trim_and_exact(spark):
    vals = ["\\N", " \\N ", "\\\\N", "NA", "n/a", "N/A", "None", "none", "null", "NULL", "", " ", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    trimmed = [r[0] for r in df.select(null_if_sentinel("s", NULL_SENTINELS, trim=True)).collect()]
    assert trimmed == [None, None, None, None, "n/a", None, None, None, None, None, "", "", "x", None]
    exact = [r[0] for r in df.select(null_if_sentinel("s", NULL_SENTINELS, trim=False)).collect()]
    assert exact == [None, " \\N ", None, None, "n/a", None, None, None, None, None, None, None, "x", None]


# The ten dirty/clean title pairs published with the reference's outputs.
ACCENT_PAIRS = [
    ("Ớncé Úpớn á Timé Théré Wás á Singing Bláckbird", "Once Upon a Time There Was a Singing Blackbird"),
    ("Ớncé Úpớn á Timé in Phúkét", "Once Upon a Time in Phuket"),
    ("Ớné Bớdy Tớớ Mány", "One Body Too Many"),
    ("Ớpén Héárts", "Open Hearts"),
    ("Ớpérátiớn Kid Brớthér", "Operation Kid Brother"),
    ("Ớrgy ớf thé Déád", "Orgy of the Dead"),
    ("Ớrpháns ớf thé Stớrm", "Orphans of the Storm"),
    ("Ớrwéll Rớlls in His Grávé", "Orwell Rolls in His Grave"),
    ("Ớút ớf Áfricá", "Out of Africa"),
    ("Ớútcást", "Outcast"),
]


def test_strip_accents_pairs_and_edges(spark):
    import unicodedata
    extra = ["Báttling Bútlér", "한국어", "øłß", "", "ﬁ", "ȩ́"]
    df = spark.createDataFrame([(d,) for d, _ in ACCENT_PAIRS] + [(e,) for e in extra] + [(None,)], "t string")
    got = [r[0] for r in df.select(strip_accents("t")).collect()]
    assert got[:10] == [c for _, c in ACCENT_PAIRS]
    for e, g in zip(extra, got[10:16]):
        assert g == "".join(c for c in unicodedata.normalize("NFD", e) if unicodedata.category(c) != "Mn")
    assert got[-1] is None


def test_python_whitespace_semantics(spark):
    vals = ["  a b  c ", "", None, "x y", " pad　", "a\x1cb", "٣ apples", "no digits"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select(word_count("s").alias("w"), has_match("s").alias("d"), py_strip("s").alias("p")).collect()
    for v, r in zip(vals, rows):
        if v is None:
            assert r.w is None and r.d == 0 and r.p is None
            continue
        assert r.w == len(v.split())
        assert r.p == v.strip()
        assert r.d == int(any(ch.isdecimal() for ch in v))


def test_strip_accents_equals_python_everywhere(spark):
    import random
    import unicodedata

    def expected(t):
        return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")

    points = [chr(cp) for cp in range(1, 0x30000) if not 0xD800 <= cp < 0xE000] + [chr(cp) for cp in range(0xE0000, 0xE0200)]
    rng = random.Random(3)
    marks = [c for c in points if unicodedata.combining(c)]
    odd = [c for c in marks if unicodedata.category(c) != "Mn"]
    long = [c for c in points if len(unicodedata.normalize("NFD", c)) > 1 and not 0xAC00 <= ord(c) < 0xD7A4]
    free = [c for c in points if unicodedata.category(c) == "Mn" and not unicodedata.combining(c)]
    runs = ["".join(rng.choice(rng.choice([marks, odd, odd, long, free, ["a", "é", "한", "\uffff"]])) for _ in range(rng.randrange(1, 12)))
            for _ in range(10_000)]
    texts = [c + "x" for c in points] + runs
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = dict(df.select("i", strip_accents("t")).collect())
    assert [(texts[i], got[i]) for i in range(len(texts)) if got[i] != expected(texts[i])] == []
