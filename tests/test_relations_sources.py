import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from featurepipe.config import DIRECTOR_ALIASES, KEY_ALIASES, NULL_SENTINELS, WRITER_ALIASES
from featurepipe.operators import clean_relation, count_members, join_counts, relation_summary
from featurepipe.sources import (
    csv_rejects, model_report, read_csv_union, read_relation, read_stage, write_predictions, write_report, write_stage,
)


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_clean_relation_count_and_join(spark):
    rel = spark.createDataFrame([("t1", "n1"), ("t1", "n1"), ("t1", "n2"), ("t2", "\\N"), ("t2", " "), (None, "n3"),
                                 ("t3", "n3"), ("t3", " NA")], "key string, member string")
    clean = clean_relation(rel, "key", "member", NULL_SENTINELS)
    assert sorted(map(tuple, clean.collect())) == [("t1", "n1"), ("t1", "n2"), ("t3", " NA"), ("t3", "n3")]
    counts = count_members(clean, "key", "member", "n")
    ent = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "key string")
    got = sorted(map(tuple, join_counts(ent, "key", {"n": counts}).collect()))
    assert got == [("t1", 2), ("t2", 0), ("t3", 2)]
    assert relation_summary(rel, "key").first().asDict() == {"n_rows": 8, "n_keys": 3}


def test_read_relation_shapes(spark, tmp_dir):
    d = os.path.join(tmp_dir, "rel")
    os.makedirs(d)
    _write(os.path.join(d, "cols.json"), json.dumps(
        {" Movie": {"0": "t1", "1": "t2", "2": "t3"}, "DIRECTOR_ID": {"0": "n1", "1": "NA", "3": "n9"}}))
    _write(os.path.join(d, "recs.json"), "  " + json.dumps(
        [{"tconst": "t4", "Director": "n4"}, {"tconst": "t4", "Director": "n4"}, {"tconst": "t5"},
         {"tconst": "t6", "Director": "null"}]))
    got = sorted(map(tuple, read_relation(spark, d, KEY_ALIASES, DIRECTOR_ALIASES).collect()))
    assert got == [("t1", "n1"), ("t4", "n4")]
    lines = os.path.join(tmp_dir, "lines.json")
    _write(lines, "\n".join(json.dumps({"movie": f"t{i}", "writer": f"w{i % 2}"}) for i in range(5)))
    got = sorted(map(tuple, read_relation(spark, lines, KEY_ALIASES, WRITER_ALIASES, shape="lines").collect()))
    assert got == [(f"t{i}", f"w{i % 2}") for i in range(5)]


def test_read_relation_rejects_bad_shapes(spark, tmp_dir):
    bad = os.path.join(tmp_dir, "bad.json")
    _write(bad, json.dumps({"film": {"0": "t1"}, "person": {"0": "n1"}}))
    with pytest.raises(Exception, match="Keys found"):
        read_relation(spark, bad, KEY_ALIASES, DIRECTOR_ALIASES).collect()
    num = os.path.join(tmp_dir, "num.json")
    _write(num, "42")
    with pytest.raises(Exception, match="unexpected top-level"):
        read_relation(spark, num, KEY_ALIASES, DIRECTOR_ALIASES).collect()


BROKEN = {
    "records with unknown headers": ('[{"film": "t1", "person": "n1"}]', "auto", "Keys found: film, person"),
    "truncated list": ('[{"movie": "t1", "director": "n1"}, {"movie": "t2", "dir', "auto", "(?i)malformed"),
    "truncated dict": ('{"movie": {"0": "t1"}, "director": {"0": "n1"', "auto", "(?i)malformed"),
    "records asked of a dict": ('{"movie": {"0": "t1"}, "director": {"0": "n1"}}', "records", "found shape columns, expected records"),
    "columns asked of a list": ('[{"movie": "t1", "director": "n1"}]', "columns", "found shape records, expected columns"),
    "a malformed line": ('{"movie": "t1", "director": "n1"}\n{"movie": "t2"', "lines", "(?i)malformed"),
    "a line with unknown headers": ('{"film": "t1"}', "lines", "Keys found: film"),
}


@pytest.mark.parametrize("case", BROKEN)
def test_unreadable_relations_fail_loudly(spark, tmp_dir, case):
    text, shape, message = BROKEN[case]
    path = os.path.join(tmp_dir, "broken.json")
    _write(path, text)
    with pytest.raises(Exception, match=message):
        read_relation(spark, path, KEY_ALIASES, DIRECTOR_ALIASES, shape=shape).collect()


def test_auto_shape_reads_lines_and_blank_files(spark, tmp_dir):
    recs = [{"movie": f"t{i}", "director": 'a "quoted" } name'} for i in range(3)]
    for name, text in {"lines": "\n".join(map(json.dumps, recs)) + "\n", "one": json.dumps(recs[0]), "blank": " \n",
                       "crlf": "\r\n".join(map(json.dumps, recs)), "pretty": json.dumps(recs, indent=1), "none": "[]", "nix": "{}"}.items():
        path = os.path.join(tmp_dir, name + ".json")
        _write(path, text)
        if name == "nix":
            with pytest.raises(Exception, match="Keys found"):
                read_relation(spark, path, KEY_ALIASES, DIRECTOR_ALIASES).collect()
            continue
        got = sorted(r.key for r in read_relation(spark, path, KEY_ALIASES, DIRECTOR_ALIASES).collect())
        assert got == {"one": ["t0"], "blank": [], "none": []}.get(name, ["t0", "t1", "t2"]), name


def test_rfc_4180_quotes_survive_both_reads_and_stages(spark, tmp_dir):
    path = os.path.join(tmp_dir, "q.csv")
    _write(path, 'id,"the, title",n\n1,"Say ""A, B"" now",6\n2,plain,7\n')
    for on_error in ("fail", "drop"):
        rows = read_csv_union(spark, path, on_error=on_error).orderBy("id").collect()
        assert [(r["the, title"], r.n) for r in rows] == [('Say "A, B" now', "6"), ("plain", "7")]
    _write(path, 'id,title\n1,"two\nlines"\n2,"x\\N"\n')
    rows = read_csv_union(spark, path, multiline=True).orderBy("id").collect()
    assert [r.title for r in rows] == ["two\nlines", "x\\N"]
    stage = os.path.join(tmp_dir, "stage")
    df = read_csv_union(spark, path, multiline=True).select("id", F.concat("title", F.lit(' "q", z')).alias("title")).where("id = 2")
    write_stage(df, stage, "csv")
    with open(next(os.path.join(stage, f) for f in os.listdir(stage) if f.endswith(".csv"))) as f:
        assert list(csv.DictReader(f)) == [{"id": "2", "title": 'x\\N "q", z'}]
    assert read_stage(spark, stage, "csv", schema="id string, title string").first().title == 'x\\N "q", z'


def test_rejected_rows_are_listed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    _write(path, "a,b\n1,2\n3,4,5,6\n7,8\n9\n")
    assert sorted(r.record for r in csv_rejects(spark, path).collect()) == ["3,4,5,6", "9"]
    assert read_csv_union(spark, path, on_error="drop").count() == 2


def test_csv_union_by_name_and_errors(spark, tmp_dir):
    d = os.path.join(tmp_dir, "raw")
    os.makedirs(d)
    _write(os.path.join(d, "train-1.csv"), "tconst,primaryTitle,runtimeMinutes,label\nt1,A,90,True\nt2,B,\\N,False\n")
    _write(os.path.join(d, "train-2.csv"), "label,runtimeMinutes,tconst,primaryTitle\nTrue,100 min,t3,C\n")
    _write(os.path.join(d, "train-3.csv"), "tconst,primaryTitle\nt4,D\n")
    cols = ["tconst", "primaryTitle", "runtimeMinutes", "numVotes", "label"]
    df = read_csv_union(spark, os.path.join(d, "train-*.csv"), cols)
    rows = sorted((r.tconst, r.primaryTitle, r.runtimeMinutes, r.numVotes, r.label) for r in df.collect())
    assert rows == [("t1", "A", "90", None, "True"), ("t2", "B", "\\N", None, "False"),
                    ("t3", "C", "100 min", None, "True"), ("t4", "D", None, None, None)]
    order = [r.tconst for r in df.orderBy("_src_file", "_src_block", "_src_pos").collect()]
    assert order == ["t1", "t2", "t3", "t4"]
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    _write(os.path.join(bad, "v.csv"), "a,b\n1,2\n3,4,5,6\n7,8\n")
    assert read_csv_union(spark, os.path.join(bad, "*.csv"), on_error="drop").count() == 2
    with pytest.raises(Exception):
        read_csv_union(spark, os.path.join(bad, "*.csv"), on_error="fail").count()


def test_stage_round_trip_and_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(2, "b", 1.5), (0, "a", None), (1, "c", 2.0)], "_row_id long, t string, x double")
    for fmt in ("parquet", "csv"):
        p = os.path.join(tmp_dir, f"stage-{fmt}")
        write_stage(df, p, fmt, order_by="_row_id")
        back = read_stage(spark, p, fmt, schema="_row_id long, t string, x double")
        assert sorted(back.collect()) == sorted(df.collect())
    pred = spark.createDataFrame([(2, 1.0), (0, 0.0), (1, 1.0)], "_row_id long, prediction double")
    out = os.path.join(tmp_dir, "pred")
    write_predictions(pred, "_row_id", out, single_file=True)
    lines = []
    for f in sorted(os.listdir(out)):
        if f.startswith("part-"):
            lines += open(os.path.join(out, f)).read().splitlines()
    assert lines == ["False", "True", "True"]
    assert open(out + ".txt").read().splitlines() == lines
    rep = os.path.join(tmp_dir, "report")
    write_report(model_report(spark, ["Best model: X", "", "Feature importances:"]), rep)
    text = "".join(open(os.path.join(rep, f)).read() for f in sorted(os.listdir(rep)) if f.startswith("part-"))
    assert text.splitlines() == ["Best model: X", "", "Feature importances:"]


def test_long_headers_and_values(spark, tmp_dir):
    million = 1_000_000
    path = os.path.join(tmp_dir, "long.json")
    os.makedirs(path)
    _write(os.path.join(path, "a.json"), json.dumps({'\\"' * 20_000: {"0": "x"}, "movie": {"0": "t1"}, "director": {"0": "n" * million}}))
    _write(os.path.join(path, "b.json"), json.dumps([{"movie": "t" * million, "director": "n2"}]))
    _write(os.path.join(path, "c.json"), json.dumps({"movie": "\\" * million, "director": "n"}))
    got = sorted((len(k), len(m)) for k, m in read_relation(spark, path, KEY_ALIASES, DIRECTOR_ALIASES).collect())
    assert got == [(2, million), (million, 1), (million, 2)]
    # the JSON parser takes names of up to 50,000 characters: a longer one fails the job, not the executor
    _write(os.path.join(tmp_dir, "name.json"), json.dumps({'\\"' * (million // 2): {"0": "x"}, "movie": {}, "director": {}}))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_relation(spark, os.path.join(tmp_dir, "name.json"), KEY_ALIASES, DIRECTOR_ALIASES).collect()
    assert spark.range(3).count() == 3


def test_each_document_is_parsed_once_a_shape(spark):
    from featurepipe.operators import relation_from_column_docs, relation_from_record_docs
    docs = spark.createDataFrame([('[{"movie": "a", "director": "b"}]',)], "json string")
    for read in (relation_from_column_docs, relation_from_record_docs):
        plan = read(docs, "json", KEY_ALIASES, DIRECTOR_ALIASES)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 3                     # one for each of the three shapes
