import random

import numpy as np
import pytest
from featurepipe.llm.htmlblocks import blocks
from featurepipe.llm.maintext import (
    HIDDEN, BlockLabeller, _Maker, _sigmoid, extract_text, fit, page_number, structural_label, training_pages, vectors,
)

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def net(pages):
    return fit(training_pages([h for i, h in pages if page_number(i) % 5], 4, 7))


def test_blocks():
    page = ("<!doctype html><title>T &amp; x</title><script>if (a < b) '</p>' </script><style>p{}</style><body>lead"
            "<p class='Big postBody'>One <b>bo</b>ld&nbsp;&eacute;&#33;<br>two<p>next <a href='/x>y'>li<i>n</i>k</a> end<div id=side><ul><li>a<li>b</ul></div>"
            "a < b<!-- <p>no</p> --><template><p>hidden</p></template><select><option>x</select><table><tr><td>1<td>2</table></p>tail<p> </p><unknown>z")
    got = [(b.text, [t for t, _ in b.path], b.linked) for b in blocks(page)]
    assert got == [("lead", ["body"], 0), ("One bold é! two", ["body", "p"], 0), ("next link end", ["body", "p"], 4), ("a", ["body", "div", "ul", "li"], 0),
                   ("b", ["body", "div", "ul", "li"], 0), ("a < b", ["body"], 0), ("1", ["body", "table", "tr", "td"], 0),
                   ("2", ["body", "table", "tr", "td"], 0), ("tail", ["body"], 0), ("z", ["body"], 0)]
    assert blocks(page)[1].path[1][1] == {"big", "post", "body"}
    assert blocks(None) == blocks("") == blocks("<p> </p>") == blocks("<script>x") == []


@pytest.mark.parametrize("odd", ["<" * 200_000, "<p>" * 100_000, "<a b='" * 2000, "<!--" * 50_000, "&" * 100_000, "<div><p>x</div>" * 20_000])
def test_long_odd_pages(odd):
    assert isinstance(blocks(odd), list)


def test_gradients_equal_differences():
    rng = random.Random(3)
    maker = _Maker(rng, ["some words here.", "other"], ["Home", "Ad"])
    data = []
    while len(data) < 3:
        html, labels = maker.page("Title", ["one text", "two texts."])
        if len(found := blocks(html)) == len(labels):
            data.append((found, np.array(labels)))
    seqs, labels = vectors([b for b, _ in data]), np.concatenate([y for _, y in data]).astype(int)
    net, rows = BlockLabeller.fresh(1), np.arange(len(labels))
    _, grads = net.gradients(seqs, rows, seqs.sizes, labels)
    pick = np.random.default_rng(0)
    for name, w in net.weights.items():
        live = np.argwhere(np.abs(grads[name]) > 1e-7)
        for at in map(tuple, live[pick.permutation(len(live))[:12]]):
            old, step = w[at], 1e-5
            w[at] = old + step
            up, _ = net.gradients(seqs, rows, seqs.sizes, labels)
            w[at] = old - step
            down, _ = net.gradients(seqs, rows, seqs.sizes, labels)
            w[at] = old
            assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-6 + 1e-4 * abs(grads[name][at])


def test_recurrence_equals_one_block_at_a_time(net, pages):
    found = [blocks(h) for _, h in pages[:9]] + [[]]
    w, got = net.weights, net.predict(found)
    for page, shares in zip(found, got, strict=True):
        if not page:
            assert len(shares) == 0
            continue
        x, _ = net.inputs(vectors([page]), np.arange(len(page)))
        states = []
        for way, order in ((0, range(len(page))), (1, range(len(page) - 1, -1, -1))):
            h = c = np.zeros(HIDDEN)
            seen = {}
            for k in order:
                i, f, o, g = np.split(x[k] @ w["into"][way] + h @ w["over"][way] + w["bias"][way], 4)
                c = _sigmoid(f) * c + _sigmoid(i) * np.tanh(g)
                seen[k] = h = _sigmoid(o) * np.tanh(c)
            states.append(seen)
        for k in range(len(page)):
            z = np.concatenate((states[0][k], states[1][k], x[k])) @ w["out"] + w["out_bias"]
            assert abs(1 / (1 + np.exp(z[0] - z[1])) - shares[k]) < 1e-9


def test_held_out_pages(net, pages):
    held = [blocks(h) for i, h in pages if page_number(i) % 5 == 0]
    truth = [[bool(structural_label(b)) for b in p] for p in held]
    got = [(s >= 0.5).tolist() for s in net.predict(held)]
    assert np.mean([g == t for g, t in zip(got, truth, strict=True)]) >= 0.98


def test_other_markup(net, pages):
    held = [h for i, h in pages if page_number(i) % 5 == 0]
    made = training_pages(held, 4, 1234)[len(held):]
    got = net.predict([b for b, _ in made])
    right = np.concatenate([(s >= 0.5) == y for s, (_, y) in zip(got, made, strict=True)])
    assert len(made) > 100 and right.mean() >= 0.98


def test_comments_and_the_like_go(net):
    prose = ["The first paragraph of the article tells at length what it is about.", "Another one goes on, with some more words in it."]
    page = ("<body><header class='site-header'><div class='logo'>Daily</div><nav><ul><li><a href='/'>Home</a><li><a href='/s'>Sport</a></ul></nav></header>"
            "<div class='cookie-notice'><p>We use cookies.</p></div><main><h1>A headline of today</h1><p>" + "</p><p>".join(prose) +
            "</p></main><section class='comments'><h3>Comments</h3><div class='comment'><p>I do not agree with this article at all.</p></div></section>"
            "<aside class='sidebar'><h3>Related</h3><p>Other stories of the day</p></aside><form class='newsletter'><p>Your email</p></form>"
            "<footer><p>&copy; Daily</p></footer>")
    shares = net.predict([blocks(page)])[0]
    assert [b.text for b, s in zip(blocks(page), shares, strict=True) if s >= 0.5] == ["A headline of today", *prose]


def test_table(spark, net, pages):
    rows = [(1, "u", pages[0][1]), (2, None, None), (2, "v", ""), (None, "w", "<nav><ul><li><a href='/'>Home</a></ul></nav>"), (1, "u", pages[0][1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "5 AS n_chars")
    out = extract_text(df, net)
    assert out.columns == ["page_id", "url", "n_chars", "text"]
    got = sorted(((r.page_id, r.url, r.text) for r in out.collect()), key=str)
    want = "\n".join(b.text for b in blocks(pages[0][1]) if structural_label(b))
    assert got == sorted([(1, "u", want), (1, "u", want), (2, None, ""), (2, "v", ""), (None, "w", "")], key=str)
    assert extract_text(df.limit(0), net).collect() == []


def test_query_gives_every_page(spark):
    from featurepipe.llm.queries import op12_main_text
    got = op12_main_text(spark, "/root/testdata/sf0.001").collect()
    source = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r.page_id for r in got} == set(source) and len(got) == len(source)
    right = [r.text == "\n".join(b.text for b in blocks(source[r.page_id].html) if structural_label(b)) and r.n_chars == len(r.text) for r in got]
    assert np.mean(right) >= 0.95
