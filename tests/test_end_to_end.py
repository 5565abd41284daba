"""File-to-file run in the reference's raw layout: drifting train shards, tolerant hidden splits,
both JSON relation shapes; then training and the submission files."""

import json
import os

from pyspark.sql import functions as F

from featurepipe.operators.model import ModelSettings
from featurepipe.plans.build import run_build
from featurepipe.plans.train import run_train
from featurepipe.sources.published import stage_path


def _w(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _raw(d):
    os.makedirs(d)
    head = "tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes,label\n"
    rows1 = [f"tt{i},Títle {i},{'' if i % 2 else 'Orig ' + str(i)},{'\\N' if i % 5 == 0 else 1900 + i},"
             f"{1900 + i if i % 5 == 0 else '\\N'},{60 + i},{'NA' if i % 7 == 0 else 1000 * i},{i % 3 == 0}\n"
             for i in range(1, 31)]
    _w(os.path.join(d, "train-1.csv"), head + "".join(rows1[:15]))
    # second shard: columns in another order, runtime as text
    head2 = "label,tconst,numVotes,runtimeMinutes,primaryTitle,originalTitle,startYear,endYear\n"
    rows2 = [f"{i % 2 == 0},tt{i},{500 * i},{80 + i} ,Film {i},,{1990 + i % 10},\\N\n" for i in range(31, 46)]
    _w(os.path.join(d, "train-2.csv"), head2 + "".join(rows2))
    _w(os.path.join(d, "train-3.csv"), head + "".join(rows1[15:]))
    vhead = head.replace(",label", "")
    _w(os.path.join(d, "validation_hidden.csv"),
       vhead + "".join(f"tv{i},Vál {i},,{1950 + i},\\N,{90 + i},{10 * i}\n" for i in range(10)) + "bad,row\n")
    _w(os.path.join(d, "test_hidden.csv"),
       vhead + "".join(f"te{i},Test {i},X,\\N,{1960 + i},{70 + i},\n" for i in range(8)))
    _w(os.path.join(d, "directing.json"), json.dumps(
        {"movie": {str(i): f"tt{i}" for i in range(1, 46)}, "director": {str(i): f"nm{i % 4}" for i in range(1, 46)}}))
    _w(os.path.join(d, "writing.json"), json.dumps(
        [{"movie": f"tt{i}", "writer": f"nm{i % 6}"} for i in range(1, 46)] + [{"movie": "tv1", "writer": "nm1"}]))


def test_build_and_train_from_files(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    _raw(raw)
    st = run_build(spark, raw, out, fmt="parquet")
    counts = {r.split: r["count"] for r in st.gold.groupBy("split").count().collect()}
    assert counts == {"train": 45, "val": 10, "test": 8}
    folder = stage_path(spark, os.path.join(out, "processed"))
    gold = spark.read.option("mergeSchema", True).parquet(folder)
    hidden = spark.read.parquet(os.path.join(folder, "split=val"))
    assert "label" not in hidden.columns and len(hidden.columns) + 1 == len(spark.read.parquet(
        os.path.join(folder, "split=train")).columns)
    tr = {r.tconst: r for r in gold.where(F.col("split") == "train").collect()}
    assert tr["tt5"].startYear == 1905.0                 # swapped year repaired
    assert tr["tt1"].primaryTitle == "Title 1"           # accents stripped
    assert tr["tt7"].numVotes is not None                # imputed
    assert tr["tt3"].n_directors == 1 and tr["tt3"].n_writers == 1
    assert sorted(r._row_id for r in tr.values()) == list(range(45))
    # file order: train-1 (tt1..tt15), train-2 (tt31..tt45), train-3 (tt16..tt30)
    assert tr["tt1"]._row_id == 0 and tr["tt31"]._row_id == 15 and tr["tt16"]._row_id == 30
    prof = spark.read.option("header", True).csv(os.path.join(out, "profiles", "processed"))
    assert prof.where((F.col("column") == "label") & (F.col("split") == "gold_train")).count() == 1
    assert prof.where((F.col("column") == "label") & (F.col("split") != "gold_train")).count() == 0
    assert {r.split for r in prof.select("split").distinct().collect()} == {"gold_train", "gold_val", "gold_test"}
    assert prof.where((F.col("split") == "gold_val") & (F.col("column") == "tconst")).first().n_rows == "10"
    res = run_train(spark, os.path.join(out, "processed"), os.path.join(out, "model"),
                    settings=ModelSettings.quick(), fmt="parquet")
    for split, n in (("val", 10), ("test", 8)):
        d = os.path.join(out, "model", f"predictions_{split}")
        lines = [ln for f in sorted(os.listdir(d)) if f.startswith("part-") for ln in open(os.path.join(d, f)).read().splitlines()]
        assert len(lines) == n and set(lines) <= {"True", "False"}
        assert open(f"{d}.txt").read().splitlines() == lines
    assert res.report_lines()[0].startswith("Best model: ")
    from featurepipe.session import release_materialized
    assert release_materialized(spark) >= 1     # the row-id intermediate
