import os
import time

from featurepipe.config import DEFAULT
from featurepipe.streaming import clean_stream, start_clean_stream


def test_row_local_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes,label\n"
                "t1,Báttling Bútlér,,\\N,1925,90,1200000,True\n"
                "t2, Up ,Oben,2009,\\N,700,NA,false\n")
    cols = ["tconst", "primaryTitle", "originalTitle", "startYear", "endYear", "runtimeMinutes", "numVotes", "label"]
    stream = clean_stream(spark, src, cols, DEFAULT)
    assert stream.isStreaming
    out = os.path.join(tmp_dir, "out")
    q = start_clean_stream(stream, out, name=f"t{int(time.time() * 1000)}", available_now=True)
    q.awaitTermination(120)
    rows = {r.tconst: r for r in spark.read.parquet(out).collect()}
    assert rows["t1"].primaryTitle == "Battling Butler" and rows["t1"].startYear == 1925.0
    assert rows["t1"].endYear is None and rows["t1"].is_old_film == 1 and rows["t1"].is_blockbuster == 1
    assert rows["t2"].runtimeMinutes is None and rows["t2"].numVotes is None and rows["t2"].label == 0
    assert rows["t2"].is_foreign_title == 1 and rows["t2"].title_word_count == 1


def test_stream_resumes_from_checkpoint(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in2")
    os.makedirs(src)
    head = "tconst,primaryTitle,originalTitle,startYear,endYear,runtimeMinutes,numVotes,label\n"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(head + "t1,A,,1990,\\N,90,10,True\n")
    cols = head.strip().split(",")
    out = os.path.join(tmp_dir, "out2")
    name = f"resume{int(time.time() * 1000)}"
    start_clean_stream(clean_stream(spark, src, cols), out, name=name, available_now=True).awaitTermination(120)
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(head + "t2,B,,1991,\\N,95,20,False\n")
    # a restarted query with the same checkpoint reads only the new file: no row twice
    start_clean_stream(clean_stream(spark, src, cols), out, name=name, available_now=True).awaitTermination(120)
    assert sorted(r.tconst for r in spark.read.parquet(out).collect()) == ["t1", "t2"]
