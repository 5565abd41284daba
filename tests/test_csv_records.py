"""Quoted line breaks in CSV files read by several tasks, against a plain sequential reader."""

import csv
import io
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from featurepipe.sources import ORDER_COLS, csv_rejects, read_csv_tolerant, read_csv_union
from featurepipe.sources.csv_records import _patterns, block_states, cut_records, line_ends, text_lines


def _write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.fixture
def small_blocks(spark):
    """Blocks of 700 bytes, so that small files have many."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _field(rng):
    kind = rng.randrange(8)
    if kind < 3:
        return "".join(rng.choice("ab é,\n") for _ in range(rng.randrange(1, 12)))
    if kind == 3:
        return 'say "x, y"\nand ""'
    if kind == 4:
        return "\n" * rng.randrange(1, 4)
    if kind == 5:
        return "one\r\ntwo"
    if kind == 6:
        return "line\n" * rng.randrange(1, 60) + "last"
    return '"'


def _rows(seed, n=150):
    rng = random.Random(seed)
    return [[str(i), _field(rng), _field(rng)] for i in range(n)]


def _text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_in_quotes_read_by_many_tasks(spark, tmp_dir, small_blocks, end):
    want = []
    for part in range(2):
        rows = _rows(part)
        _write(os.path.join(tmp_dir, f"{part}.csv"), _text([["id", "a b", "c"], *rows], end))
        want += [(str(part), *r) for r in rows]
    df = read_csv_union(spark, os.path.join(tmp_dir, "*.csv"))
    got = df.orderBy(*ORDER_COLS).select(F.regexp_extract("_src_file", r"(\d)\.csv$", 1).alias("f"), "id", "a b", "c").collect()
    assert [tuple(r) for r in got] == want
    blocks = text_lines(spark, os.path.join(tmp_dir, "*.csv")).select("file", "block").distinct().count()
    assert blocks > 10 and text_lines(spark, os.path.join(tmp_dir, "*.csv")).rdd.getNumPartitions() > 10


def _sequential_states(text, sep=","):
    """Whether each line begins inside quotes, character by character."""
    states, inside, fresh, i = [], False, True, 0
    for line in text.split("\n"):
        states.append(inside)
        i = 0
        fresh = not inside
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"':
                    if line[i + 1:i + 2] == '"':
                        i += 1
                    else:
                        inside = False
                        fresh = False
            elif fresh and c == '"':
                inside, fresh = True, False
            else:
                fresh = c in (sep, "\r")
            i += 1
    return states


def test_lines_as_functions_of_states(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice('",ab\r') for _ in range(rng.randrange(0, 9))) for _ in range(3000)]
    outside, inside = (re.compile(p.replace(r"\z", r"\Z")) for p in _patterns(","))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    a, b = line_ends(F.col("value"), ",")
    for i, x, ends_a, ends_b in df.select("i", "value", a, b).collect():
        want_a = _sequential_states(x + "\n")[1]
        want_b = _sequential_states('"\n' + x + "\n")[2]
        assert (ends_a, ends_b) == (want_a, want_b), repr(x)
        assert (bool(outside.match(x)), bool(inside.match(x))) == (want_a, want_b), repr(x)


def test_block_states_match_a_sequential_read(spark, tmp_dir, small_blocks):
    rng = random.Random(8)
    for n in range(3):
        text = "\n".join("".join(rng.choice('"",,ab') for _ in range(rng.randrange(0, 9))) for _ in range(2000))
        path = os.path.join(tmp_dir, f"{n}.csv")
        _write(path, text)
        lines = text_lines(spark, path)
        states, firsts = _sequential_states(text), {}
        for i, r in enumerate(lines.orderBy("block", "pos").collect()):
            firsts.setdefault(r.block, states[i])
        got = {r.block for r in block_states(lines, ",").collect()}
        assert got == {b for b, s in firsts.items() if s} and len(firsts) > 5


def test_a_stray_quote_shifts_nothing(spark, tmp_dir, small_blocks):
    path = os.path.join(tmp_dir, "s.csv")
    rows = "".join(f'{i},5" disk,"a\nb{i}"\n' for i in range(200))
    _write(path, "id,t,u\n" + rows)
    got = read_csv_union(spark, path).orderBy(*ORDER_COLS).collect()
    assert [(r.id, r.t, r.u) for r in got] == [(str(i), '5" disk', f"a\nb{i}") for i in range(200)]


def test_header_with_breaks_blank_lines_bom_and_empty_files(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.csv"), '﻿"the\ntitle",n\n\n"x\ny",1\n \n,\n"",2\n')
    _write(os.path.join(tmp_dir, "b.csv"), "")
    _write(os.path.join(tmp_dir, "c.csv"), "n\n7\n")
    got = read_csv_union(spark, os.path.join(tmp_dir, "*.csv"), ["the\ntitle", "n"]).orderBy(*ORDER_COLS).collect()
    assert [(r["the\ntitle"], r.n) for r in got] == [("x\ny", "1"), (None, None), (None, "2"), (None, "7")]        # an empty field is NULL, quoted or not
    none = read_csv_union(spark, os.path.join(tmp_dir, "b.csv"), ["n"])
    assert none.columns == ["n", *ORDER_COLS] and none.count() == 0
    with pytest.raises(FileNotFoundError):
        read_csv_union(spark, os.path.join(tmp_dir, "no-*.csv"))


def test_carriage_returns_alone_end_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    _write(path, 'id,t\r1,"a\rb"\r2,c\r')
    got = read_csv_union(spark, path).orderBy(*ORDER_COLS).collect()
    assert [(r.id, r.t) for r in got] == [("1", "a\rb"), ("2", "c")]


def test_malformed_records_fail_or_are_listed(spark, tmp_dir, small_blocks):
    path = os.path.join(tmp_dir, "bad.csv")
    lines = ["id,t"] + [f'{i},"x\ny"' + (",more" if i % 50 == 3 else "") for i in range(200)]
    _write(path, "\n".join(lines) + "\n")
    bad = sorted(f'{i},"x\ny",more' for i in range(200) if i % 50 == 3)
    with pytest.raises(Exception, match="malformed CSV record"):
        read_csv_union(spark, path).count()
    assert read_csv_union(spark, path, on_error="drop").count() == 196
    assert sorted(r.record for r in csv_rejects(spark, path).collect()) == bad
    rows, rejects = read_csv_tolerant(spark, path, ["id", "zzz"])
    assert rows.columns == ["id", "zzz", *ORDER_COLS]
    assert sorted(int(r.id) for r in rows.collect()) == [i for i in range(200) if i % 50 != 3]
    assert sorted(r.record for r in rejects.collect()) == bad


def test_both_ways_in_one_read_and_other_separators(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.csv"), "id|t\n1|x,y\n")
    _write(os.path.join(tmp_dir, "b.csv"), 't|id\n"p|\nq"|2\n')
    _write(os.path.join(tmp_dir, "c.csv"), "id|t\n3|z\n4\n")
    rows, rejects = read_csv_tolerant(spark, os.path.join(tmp_dir, "*.csv"), sep="|")
    assert sorted((r.id, r.t) for r in rows.collect()) == [("1", "x,y"), ("2", "p|\nq"), ("3", "z")]
    assert [r.record for r in rejects.collect()] == ["4"]


def test_very_long_lines_and_fields(spark, tmp_dir):
    million = 1_000_000
    path = os.path.join(tmp_dir, "long.csv")
    _write(path, "id,t\n1," + '"' + '""' * million + '"\n2,' + "x" * million + '\n3,"' + "a\n" * million + '"\n4,' + '"a"' + "\n")
    got = {r.id: r.n for r in read_csv_union(spark, path).select("id", F.length("t").alias("n")).collect()}
    assert got == {"1": million, "2": million, "3": 2 * million, "4": 1}
    wide = cut_records(text_lines(spark, path)).count()
    assert wide == 5
