"""Operator 7: URL filters with decisions that follow redirects and canonical links.

Rules name a host and a path beginning, and allow or block; the longest that fits decides. Pages
without a rule get the method's verdict: URLs linked by redirects or canonical links are
aliases, found as connected components over those edges. A component with a blocked URL
blocks its members, unless one of them is explicitly allowed; a page's own rule always stands.

Everything is column expressions and joins on URLs; a rule list is a small parameter (it is
written into the plan), the links are a table of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import ASCII_LOWER, ASCII_UPPER, connected_components
from featurepipe.session import materialize

Rule = tuple[str, str]                  # (verdict, "host/path")
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*>"""
_TARGET = r"""(?is)\burl\s*=\s*'?([^'">\s]+)"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, ASCII_UPPER, ASCII_LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (its text) for the host or a parent domain and the path's beginning; null if none fits."""
    def fits(rule: str) -> Column:
        own, slash, rest = rule.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    return reduce(lambda rest, r: F.when(fits(r[1]), F.lit(r[1])).otherwise(rest), reversed(ordered), F.lit(None).cast("string"))


def rule_verdict(rule: Column, rules: Sequence[Rule]) -> Column:
    return reduce(lambda rest, r: F.when(rule == r[1], F.lit(r[0])).otherwise(rest), rules, F.lit(None).cast("string"))


def _decoded(text: Column) -> Column:
    """Attribute text with the character references that URLs use."""
    for pattern, char in ((r"&(?:quot|#34|#x22);", '"'), (r"&(?:apos|#39|#x27);", "'"), (r"&(?:lt|#60|#x3c);", "<"), (r"&(?:gt|#62|#x3e);", ">"),
                          (r"&(?:amp|#38|#x26);", "&")):
        text = F.regexp_replace(text, f"(?i){pattern}", char)
    return text


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, s: F.when(s == ".", acc).when(
        s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).otherwise(F.concat(acc, F.array(s))))
    joined = F.concat(F.array_join(kept, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(""))
    return F.when(path.contains("/."), joined).otherwise(path)


def _resource(url: Column) -> Column:
    """The URL without its fragment, scheme and host in lower case, ``./`` and ``../`` resolved."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head, path, rest = (F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)([^?]*)(.*)$", k) for k in (1, 2, 3))
    return F.when(bare.contains("://"), F.concat(F.translate(head, ASCII_UPPER, ASCII_LOWER), _without_dots(path), rest)).otherwise(bare)


def _absolute(link: Column, url: Column) -> Column:
    """``link`` as found on the page ``url``, made absolute; null where that is not possible."""
    scheme, site = F.regexp_extract(url, r"(?s)^(.*?):", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    return (F.when(link.isNull() | (link == ""), None)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
            .when(~url.contains("://"), None)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("#") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def page_links(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(a, b)``: page URL and the target of each canonical link or refresh redirect, where it has one."""
    tags = F.regexp_extract_all(html_col, F.lit(_CANONICAL), F.lit(0))
    moves = F.regexp_extract_all(html_col, F.lit(_REFRESH), F.lit(0))
    targets = F.concat(F.transform(tags, lambda t: F.concat(*[F.regexp_extract(t, _HREF, k) for k in (1, 2, 3)])),
                       F.transform(moves, lambda t: F.regexp_extract(t, _TARGET, 1)))
    found = pages.select(F.col(url_col).alias("a"), F.explode(targets).alias("link")).withColumn("link", F.trim(_decoded(F.col("link"))))
    return (found.where("link != ''").select(_resource(F.col("a")).alias("a"), _resource(_absolute(F.col("link"), F.col("a"))).alias("b"))
            .where("a IS NOT NULL AND b IS NOT NULL AND a != b"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], *, redirects: DataFrame | None = None, url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """``pages`` (all rows and columns) with ``host, path, rule, verdict``.

    ``redirects`` may add known redirects as columns ``source`` and ``target``. Null URLs and URLs
    without ``://`` have an empty host and path, fit no rule and have no aliases by markup.
    Repeated rows are judged alike. Columns of ``pages`` that are already named like the four
    results are replaced. An empty table gives an empty one.
    """
    links = page_links(pages, url_col=url_col, html_col=html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select(_resource(F.col("source")).alias("a"), _resource(F.col("target")).alias("b")))
    names = connected_components(links)
    own = rule_verdict(matching_rule(url_host(F.col("node")), url_path(F.col("node")), rules), rules)
    # an alias takes the block of its component, but an allowed member protects the whole
    blocked = (names.withColumn("own", own).groupBy("component")
               .agg(F.max(F.col("own") == "block").alias("block"), F.max(F.col("own") == "allow").alias("allow"))
               .where("block AND NOT coalesce(allow, false)").select("component"))
    bad = materialize(names.join(blocked, "component", "left_semi").select("node"), "blocked-urls")

    judged = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url_col).alias("u"))
    host, path = url_host(F.col("u")), url_path(F.col("u"))
    judged = (judged.withColumn("rule", matching_rule(host, path, rules)).withColumn("key", _resource(F.col("u")))
              .join(bad.withColumn("alias", F.lit(True)), F.col("key") == F.col("node"), "left"))
    verdict = F.coalesce(rule_verdict(F.col("rule"), rules), F.when(F.col("alias"), F.lit("block")).otherwise(F.lit("allow")))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return judged.select(*[F.col("row")[c].alias(c) for c in keep], host.alias("host"), path.alias("path"), "rule",
                         verdict.alias("verdict"))
