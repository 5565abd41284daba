"""Steps of the gold build that cost per row: parsed once, cleaned after dedup, small tables joined
first, keys of the medians computed once; the results stay."""
import unicodedata

import pytest
from pyspark.sql import functions as F

from featurepipe.config import DEFAULT
from featurepipe.functions import py_strip, strip_accents, word_count
from featurepipe.operators import dedup_first, stats
from featurepipe.plans import bindings
from featurepipe.plans.silver import bronze_clean, clean_values, silver_clean

RAW = ("split string, tconst string, primaryTitle string, originalTitle string, startYear string, endYear string, "
       "runtimeMinutes string, numVotes string, label string, pos int")
ROWS = [("train", " tt1 ", " Çà x ", "NA", "\\N", " 1999", "90", "7", "True", 3),
        ("train", "tt1", "later", "o", "2001", "\\N", "700", "8", "false", 5),
        ("train", "tt1  ", "latest", "o", "2002", "\\N", "80", "9", "1", 9),
        ("val", "tt1", None, "", "unknown", "1700", " 1e2 ", "null", None, 4),
        ("val", "NA", "a", "b", "1890", "x", "nan", "inf", None, 6),
        ("val", None, "c", "d", "1879", "2031", "600", "-3", None, 2),
        ("val", "N/A ", "e", "f", "2030", None, "1", "0", None, 1)]


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_number_is_parsed_once(spark):
    plan = _optimized(clean_values(spark.createDataFrame(ROWS, RAW)))
    assert plan.count("RLIKE(") + plan.count(" RLIKE ") == 6 + 1      # two of the swap, four casts, one of the accents


def test_duplicates_go_before_the_other_columns_are_cleaned(spark):
    raw = spark.createDataFrame(ROWS, RAW)
    whole = silver_clean(bronze_clean(raw), ["pos"], DEFAULT, "split")
    kept = silver_clean(raw, ["pos"], DEFAULT, "split", raw=True)
    assert kept.schema == whole.schema
    grouped = dedup_first(raw, ["tconst", "split"], ["pos"])
    assert sorted(map(str, grouped.collect())) == sorted(map(str, dedup_first(raw, ["split", "tconst"], ["pos"]).collect()))
    assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))
    assert kept.count() == 3 and kept.where("tconst = 'tt1' AND split = 'train'").first()["primaryTitle"] == "Ca x"


def test_customers_meet_orders_before_lines(spark):
    plan = _optimized(bindings.entity_bronze_raw(spark, "/root/testdata/sf0.001")).splitlines()
    depth = {k: next(line.index("Join") for line in plan if "Join" in line and k in line) for k in ("l_orderkey", "c_custkey")}
    assert depth["l_orderkey"] < depth["c_custkey"]


def test_median_rounds_share_one_copy_of_the_keys(spark, monkeypatch):
    seen, join = [], stats._join_groups

    def watched(left, right, by, how="inner", broadcast=False):
        if "_key" in left.columns:
            seen.append(_optimized(left))
        return join(left, right, by, how, broadcast)

    monkeypatch.setattr(stats, "_join_groups", watched)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    values = [float(i * 37 % 101 - 50) / 8 for i in range(101)] + [None, float("nan")]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 0.0), ("b", -0.0), ("b", 5e-324), ("b", float("inf"))], "g string, x double")
    got = {r["g"]: r["median"] for r in stats.exact_median(df, "x", ["g"], cap=1).collect()}
    assert got == {"a": 0.0, "b": 0.0}
    assert len(seen) == 4 and all("InMemoryRelation" in p for p in seen)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_bits_by_columns_equal_bits_by_expression(spark):
    xs = [0.0, -0.0, 1.0, -1.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, -3.75e-9, 2.0 ** 52, None, float("nan")]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in stats.with_ordered_bits(df, "x", "a").withColumn("b", stats.ordered_bits(F.col("x"))).collect():
        assert r["a"] == r["b"]


def test_python_whitespace_without_regex(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = [f"{s}a{s}{s}b c{s}" for s in spaces] + ["", " ", "".join(spaces), "x", "​a​ b", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("t", py_strip("t").alias("s"), word_count("t").alias("n")).collect():
        assert (r["s"], r["n"]) == ((None, None) if r["t"] is None else (r["t"].strip(), len(r["t"].split())))
    assert "regexp" not in _optimized(df.select(py_strip("t"), word_count("t")))


@pytest.mark.parametrize("tail", ["", "z", "한", "́", "Ω"])
def test_accents_of_every_early_code_point(spark, tail):
    texts = [chr(c) + tail for c in range(1, 0x400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", strip_accents("t").alias("s")).collect():
        assert r["s"] == "".join(c for c in unicodedata.normalize("NFD", r["t"]) if unicodedata.category(c) != "Mn")


def test_dedup_with_and_without_comparable_payload(spark):
    df = spark.range(60).selectExpr("id % 7 AS k", "nullif(id % 5, 0) AS o", "id AS p", "id * 2 AS v", "map('a', id) AS m")
    rows = [r.asDict() for r in df.collect()]
    least = {}
    for r in rows:
        place = (r["o"] is not None, r["o"] or 0, r["p"])
        least[r["k"]] = min(least.get(r["k"], (place, r)), (place, r), key=lambda x: x[0])
    want = {k: r["v"] for k, (_, r) in least.items()}
    for frame in (df, df.drop("m")):
        out = dedup_first(frame, ["k"], ["o", "p"])
        assert out.columns == frame.columns and {r["k"]: r["v"] for r in out.collect()} == want
