import random
import re

from featurepipe.llm.chat import format_chats
from helpers import ascii_lower

SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    return {(r.conv_id, r.turn): (r.text, r.n_quoted, r.parent_turn, r.root_turn, r.place) for r in df.collect()}


def test_quotes_link_replies_and_go(spark):
    rows = [(1, 0, "a", "First question?\nSecond line."), (1, 1, "b", "Another Topic\n\nwith  two paragraphs"),
            (1, 2, "c", "> First question?\n> Second line.\n\nAn answer."),                    # whole message
            (1, 3, "d", "> > First question?\n> An answer.\nThanks\n"),                        # nested: answers turn 2
            (1, 4, "a", ">with two PARAGRAPHS\nYes"), (1, 5, "b", "> unknown words\nhm"),       # paragraph; nothing
            (1, 6, "c", "> Second line.\n> made up\nline only"),                               # a line of turn 0
            (2, 0, "a", "First question?"), (2, 1, "b", "> An answer.\nelsewhere")]             # other conversation
    out = got(format_chats(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert out == {(1, 0): ("First question?\nSecond line.", 0, None, 0, 0), (1, 2): ("An answer.", 2, 0, 0, 1),
                   (1, 3): ("Thanks", 2, 2, 0, 2), (1, 6): ("line only", 2, 0, 0, 3),
                   (1, 1): ("Another Topic\n\nwith  two paragraphs", 0, None, 1, 4), (1, 4): ("Yes", 1, 1, 1, 5),
                   (1, 5): ("hm", 1, None, 5, 6), (2, 0): ("First question?", 0, None, 0, 0), (2, 1): ("elsewhere", 1, None, 1, 1)}


def test_long_reply_chain_and_ties(spark):
    rows = [(5, 0, "a", "word 0 here")] + [(5, k, "a", f"> word {k - 1} here\nword {k} here") for k in range(1, 40)]
    rows += [(6, 0, "a", "same words"), (6, 1, "a", "same words"), (6, 2, "b", "> same words\nreply")]
    out = got(format_chats(spark.createDataFrame(rows, SCHEMA)))
    assert all(out[5, k][2:] == (k - 1 if k else None, 0, k) for k in range(40))
    assert out[6, 2] == ("reply", 1, 1, 1, 2)                                                   # the latest original


def test_odd_rows(spark):
    rows = [(1, 0, "a", None), (1, 1, None, ""), (None, 0, "a", "> x\ny"), (1, None, "a", "> >"), (1, 2, "a", "x"), (1, 2, "a", "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS lines", "3 AS up")
    out = sorted(((r.conv_id, r.turn, r.text, r.n_quoted, r.place) for r in format_chats(df).collect()), key=str)
    assert out == sorted([(1, None, "", 1, 0), (1, 0, "", 0, 1), (1, 1, "", 0, 2), (1, 2, "x", 0, 3), (1, 2, "x", 0, 4),
                          (None, 0, "y", 1, 0)], key=str)
    assert format_chats(df.limit(0)).collect() == []


def test_deeper_quotes_link_too(spark):
    rows = [(1, 0, "a", "The original\nin two lines"), (1, 1, "b", "> The original\n> in two lines\nFirst reply"),
            (1, 2, "c", ">> The original\n>> in two lines\nonly deeper quotes"),                 # holds it at level 1: turn 1
            (1, 3, "d", "> > The original\n> > in two lines\n> First re-ply\naltered above"),    # level 1 unknown: turn 1
            (1, 4, "e", ">>> in two lines\ndeeper still"),                                       # a level 2 line: turn 3
            (1, 5, "f", "> made up\n>> First reply\n>>> the ORIGINAL\n>>> in two lines\nmixed"),  # level 3 held by turn 3
            (1, 6, "g", "> First reply\n>> in two lines\nshallow"),                              # the shallowest match
            (2, 0, "a", "The original"), (2, 1, "b", ">> The original\nno message between"), (2, 2, "c", ">> elsewhere\nx"),
            (3, 0, "a", "> p one\n> p two\n>\n> q one\n> q two\nsaid"), (3, 1, "b", ">> q one\n>> q two\nits paragraph")]
    out = got(format_chats(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert {k: v[2] for k, v in out.items()} == {(1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 1, (1, 4): 3, (1, 5): 3, (1, 6): 1,
                                                 (2, 0): None, (2, 1): 0, (2, 2): None, (3, 0): None, (3, 1): 0}
    assert {v[3] for k, v in out.items() if k[0] == 1} == {0}
    assert out[1, 2][:2] == ("only deeper quotes", 2) and out[2, 1][:2] == ("no message between", 1)


def brute(rows):
    """Parents by comparing every quote with every earlier turn."""
    def level(line):
        m = re.match(r"[ \t>]*>", line)
        return (m[0].count(">"), line[m.end():].removeprefix(" ")) if m else (0, line)

    def normal(t):
        return ascii_lower(re.sub(r"[\x20\x09-\x0D]+", " ", t).strip(" "))

    def passages(lines):
        runs = []
        for lv, body in lines:
            if runs and runs[-1][0] == lv:
                runs[-1][1].append(body)
            else:
                runs.append((lv, [body]))
        return [(lv, "\n".join(b)) for lv, b in runs if lv]

    held, asks, out = {}, [], {}
    for conv, turn, _, text in rows:
        lines = [level(x) for x in re.split(r"\r?\n", text)]
        own = [b for lv, b in lines if not lv]
        while own[:-1] and not own[0].strip(" \t"):
            own.pop(0)
        while own[1:] and not own[-1].strip(" \t"):
            own.pop()
        quoted = passages(lines)
        for lv, body in [(0, "\n".join(own)), *quoted]:
            for unit in [body, *re.split(r"\n[ \t]*\n", body), *body.split("\n")]:
                held.setdefault((conv, normal(unit)), set()).add((lv, turn))
        asks += [(conv, turn, lv, normal(u), rank) for lv, b in quoted for u, rank in [(b, 1), *((x, 0) for x in b.split("\n"))]]
    for conv, turn, lv, unit, rank in asks:
        fits = [(h, t) for h, t in held.get((conv, unit), ()) if h < lv and t < turn] if unit else []
        if fits:
            h, t = max(fits)
            out[conv, turn] = max(out.get((conv, turn), (-10 ** 9,)), (h - lv, -lv, rank, t))
    return {(c, t): out.get((c, t), (None,))[-1] for c, t, *_ in rows}


def test_random_threads_equal_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rng.randrange(1, 25)):
            lines = []
            for _ in range(rng.randrange(0, 3)):
                if said:
                    old = rng.choice(said).split("\n")
                    at = rng.randrange(len(old))
                    lines += [f"{'>' * rng.choice([1, 1, 1, 2, 3])}{rng.choice([' ', ''])}{x}" for x in old[at: at + rng.randrange(1, 4)]]
                    if rng.random() < .3:
                        lines[-1] += " altered"
            lines += [rng.choice(["", " ", "ok", f"line {rng.randrange(9)}", f"Said  {turn}"]) for _ in range(rng.randrange(0, 4))]
            said.append("\n".join(lines))
            rows.append((conv, turn, "a", said[-1]))
    out = got(format_chats(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    expected = brute(rows)
    assert {k: v[2] for k, v in out.items()} == expected and sum(v is not None for v in expected.values()) > 40


def test_common_line_in_one_long_conversation(spark):
    n = 6000                                     # every turn quotes and holds the same line
    df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "'a' AS role", "concat('> ok\n', 'ok') AS text")
    out = got(format_chats(df))
    assert all(out[7, k] == ("ok", 1, k - 1 if k else None, 0, k) for k in range(n))


def test_a_million_marks_and_blank_lines(spark):
    million = 1_000_000
    rows = [(1, 0, "a", "\n" * million + "said" + "\n \t" * million), (1, 1, "b", ">" * million + " said\nyes"), (1, 2, "c", "> said\n" + " >" * million)]
    out = got(format_chats(spark.createDataFrame(rows, SCHEMA)))
    assert [out[1, k][:3] for k in range(3)] == [("said", 0, None), ("yes", 1, 0), ("", 2, 0)]
    assert got(format_chats(spark.createDataFrame([(1, 0, "a", "\n" * 5 + "  ")], SCHEMA)))[1, 0][0] == "  "
