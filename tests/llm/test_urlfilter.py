from featurepipe.llm.urlfilter import filter_urls, page_links

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string").repartition(3)


def got(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_hosts_paths_and_longest_rule(spark):
    rows = [("HTTP://WWW.Example.ORG/es/x?q#f", None), ("http://example.org", ""), ("https://a.example.org/en/12", "x"),
            ("http://example.org/en/2", "x"), ("http://x.com/FR/", "x"), ("http://x.com/fr/a://b", "x"), ("http://com/de/", "x"),
            (None, None), ("mailto:a@b", None), ("http://notorg/", "x"), ("x://Österreich.ORG?u=/es/", ""), ("http://b.xorg/", "")]
    assert got(filter_urls(pages(spark, rows), RULES)) == {
        0: ("www.example.org", "/es/x", "example.org/es/", "block"), 1: ("example.org", "", None, "allow"),
        2: ("a.example.org", "/en/12", "example.org/en/1", "block"), 3: ("example.org", "/en/2", "org/", "allow"),
        4: ("x.com", "/FR/", None, "allow"), 5: ("x.com", "/fr/a://b", "com/fr/", "allow"), 6: ("com", "/de/", "com/de/", "block"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("notorg", "/", None, "allow"),
        10: ("Österreich.org", "", None, "allow"), 11: ("b.xorg", "/", None, "allow")}


def canonical(href):
    return f'<html><HEAD><link href="{href}" rel=canonical></head></html>'


def test_blocks_reach_aliases_and_allow_comes_first(spark):
    rows = [("http://a.net/1", canonical("http://m.com/de/x")),                     # alias of a blocked URL
            ("http://a.net/2", '<meta http-equiv="Refresh" content="0; URL=http://a.net/1#top">'),
            ("http://b.net/1", canonical("http://m.com/de/y")),                     # blocked, but an allowed member
            ("http://b.net/2", canonical("/1")),
            ("http://c.org/z", canonical("http://b.net/2")),
            ("http://d.com/fr/a", canonical("http://m.com/de/x")),                  # its own rule stands, protects all
            ("http://e.net/q", "<link rel=stylesheet href='http://m.com/de/x'>"),   # no alias
            ("http://f.net/a/b", "<link rel='canonical' href='c'>"), ("http://f.net/a/c#f", canonical("//m.com/de/z"))]
    out = got(filter_urls(pages(spark, rows), RULES))
    assert [out[i][3] for i in range(9)] == ["allow", "allow", "allow", "allow", "allow", "allow", "allow", "block", "block"]
    out = got(filter_urls(pages(spark, rows[:4]), RULES))
    assert [out[i][3] for i in range(4)] == ["block"] * 4


def test_redirect_table_and_links(spark):
    rows = [("http://a.net/1", None), ("http://b.net/1?x=1#z", canonical("#here")), ("http://b.net/1?x=1", canonical(" javascript:x"))]
    moves = spark.createDataFrame([("http://a.net/1#q", "http://b.net/1?x=1"), ("http://b.net/1?x=1", "http://w.com/de/"), (None, "x")],
                                  "source string, target string")
    assert page_links(pages(spark, rows)).collect() == []
    assert {v[3] for v in got(filter_urls(pages(spark, rows), RULES, redirects=moves)).values()} == {"block"}


def test_clashing_columns_repeats_and_empty_table(spark):
    df = pages(spark, [("http://w.com/de/", None)]).selectExpr("*", "1 AS host", "2 AS node", "3 AS `a.b`", "4 AS row")
    rows = filter_urls(df.unionByName(df), RULES).collect()
    assert [(r.host, r.verdict, r.node, r["a.b"], r["row"]) for r in rows] == [("w.com", "block", 2, 3, 4)] * 2
    assert filter_urls(df.limit(0), RULES).collect() == []


def test_links_are_decoded_lowered_and_resolved(spark):
    rows = [("https://a.net/x/p?a=1&b=2", None), ("http://b.net/1", canonical("HTTPS://A.net/x/y/../p?a=1&amp;b=2")),
            ("https://a.net/x/q", canonical("./p?a=1&#38;b=2")), ("http://c.net/a/b/c", canonical("../../d/.")),
            ("http://C.net/d/", '<link rel="canonical" href=""><link rel="canonical" href="http://e.net/">'
                                '<meta http-equiv=refresh content="0;url=http://w.com/de/">'), ("http://e.net/", None), ("http://f.net/..", None)]
    moves = spark.createDataFrame([("https://a.net/x/p?a=1&b=2", "http://w.com/de/1")], "source string, target string")
    out = got(filter_urls(pages(spark, rows), RULES, redirects=moves))
    assert [out[i][3] for i in range(7)] == ["block"] * 6 + ["allow"]
    assert out[4][:2] == ("c.net", "/d/") and out[1][:2] == ("b.net", "/1")
