"""Operator 12: main text of HTML pages by a recurrent labeller of blocks.

A page is the sequence of its leaf blocks. A block's vector joins the mean of its tag path's
hashed vectors, the mean of its words' hashed vectors and a few figures (length, share of
links, punctuation, place). A bidirectional long short-term memory reads the sequence both ways,
and a softmax over both states labels each block, so that a label rests on the whole page: what
follows a heading of reader comments is a comment, whatever its own tags.

The network is trained here in numpy, on pages of the table whose own structure tells the labels
(blocks of ``article`` or ``main`` elements without the parts inside them that are none) and on
pages made from their texts in the markup of other sites, drawn from a grammar of regions with
known labels. Training takes a bounded sample; every block of every page is classified.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import text_groups
from featurepipe.llm.htmlblocks import PATH_SLOTS, WORD_SLOTS, Block, Slots, blocks, path_tokens

HIDDEN, PATH_DIM, WORD_DIM, FIGURES = 24, 20, 12, 8
INPUT = PATH_DIM + WORD_DIM + FIGURES
_CELLS = 1 << 14                      # blocks, padding included, that run through the network together

# fixed values: names that tell parts of pages, in the order of the parts
CONTENT_NAMES = frozenset("article content entry post story body text main".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner nav navigation navbar menu breadcrumb breadcrumbs header masthead logo "
    "footer foot copyright sidebar side widget aside related recommended share social newsletter subscribe signup login form search "
    "cookie consent notice popup modal comment comments reply respond disqus discussion tags meta pagination pager toolbar skip".split())
CONTENT_TAGS, OTHER_TAGS = frozenset(["article", "main"]), frozenset("nav aside footer form dialog menu fieldset header".split())


# ---------------------------------------------------------------- pages whose labels are known

def structural_label(block: Block) -> bool | None:
    """Whether a block is main text by the elements around it, the innermost that tells; None on pages without such elements."""
    inside = any(tag in CONTENT_TAGS for tag, _ in block.path)
    for tag, names in reversed(block.path):
        if names & OTHER_NAMES or (tag in OTHER_TAGS and not (tag == "header" and inside)):
            return False
        if tag in CONTENT_TAGS or names & CONTENT_NAMES:
            return True
    return None


@dataclass
class _Maker:
    """Pages in many kinds of markup around given texts."""
    rng: random.Random
    prose: list[str]                  # paragraphs that may stand anywhere
    short: list[str]                  # texts of menus, adverts and footers

    def some(self, pool: list[str], low: int, high: int) -> list[str]:
        return [self.rng.choice(pool) for _ in range(self.rng.randint(low, high))]

    def named(self, tag: str, *names: str) -> str:
        """An opening tag with one of the names, as class or id, or with a name that tells nothing."""
        r = self.rng
        if not names or r.random() < 0.2:
            return f"<{tag}>" if r.random() < 0.5 else f'<{tag} class="{r.choice("abcdefgh")}{r.randrange(90)}">'
        name = r.choice(names) + r.choice(["", "", "-wrap", " box", "-inner", "_1"])
        return f'<{tag} {r.choice(["class", "class", "id"])}="{name}">'

    def around(self, tag: str, inner: list, *names: str) -> list:
        return [(self.named(tag, *names), None), *inner, (f"</{tag}>", None)]

    def links(self, low: int, high: int) -> list:
        r, tag = self.rng, self.rng.choice(["li", "li", "div", "p"])
        items = [x for t in self.some(self.short, low, high) for x in ((f'<{tag}><a href="#">', None), (t, False), (f"</a></{tag}>", None))]
        return self.around(r.choice(["ul", "ol", "div"]), items) if tag == "li" else items

    def paragraphs(self, texts: list[str], label: bool, tags: list[str]) -> list:
        tag = self.rng.choice(tags)
        out = []
        for t in texts:
            own = tag if self.rng.random() < 0.9 else self.rng.choice(["blockquote", "h2", "h3", "pre", "li"] if label else ["p"])
            out += [(f"<{own}>", None), (t, label), (f"</{own}>" if own != "p" or self.rng.random() < 0.7 else "", None)]
        return out

    def heading(self, words: list[str]) -> list:
        tag = self.rng.choice(["h2", "h3", "h4", "div", "p"])
        return [(f"<{tag}>", None), (self.rng.choice(words), False), (f"</{tag}>", None)]

    def region(self, kind: str) -> list:
        r = self.rng
        if kind == "menu":
            return self.around(r.choice(["nav", "nav", "div", "ul"]), self.links(2, 9), "nav", "menu", "navbar", "navigation", "breadcrumbs", "toolbar")
        if kind == "header":
            return self.around(r.choice(["header", "div"]), self.paragraphs(self.some(self.short, 1, 2), False, ["h1", "div", "p", "h2"])
                               + (self.region("menu") if r.random() < 0.5 else []), "header", "masthead", "logo", "banner", "site-header")
        if kind == "advert":
            return self.around(r.choice(["div", "aside", "section"]), self.paragraphs(self.some(self.short + self.prose[:3], 1, 2), False, ["p", "div", "span"]),
                               "ad", "ads", "advert", "sponsored", "promo", "advertisement", "banner")
        if kind == "notice":
            text = ["We use cookies to improve this site.", "Accept all cookies", "Your privacy choices", "Subscribe to read on", "Notice to readers"]
            return self.around(r.choice(["div", "section", "dialog", "aside"]), self.paragraphs(self.some(text + self.short, 1, 3), False, ["p", "div"]),
                               "cookie", "consent", "notice", "popup", "modal", "alert")
        if kind == "form":
            text = ["Subscribe to our newsletter", "Your email", "Search", "Log in", "Password", "Sign up", "Send"]
            return self.around(r.choice(["form", "form", "div"]), self.paragraphs(self.some(text, 1, 4), False, ["p", "div", "label", "legend"]),
                               "newsletter", "subscribe", "signup", "login", "search", "form", "contact")
        if kind == "sidebar":
            inner = [x for _ in range(r.randint(1, 3)) for x in self.heading(["Related", "Most read", "Popular", "See also", "About us", "Tags", *self.short])
                     + (self.links(2, 6) if r.random() < 0.6 else self.paragraphs(self.some(self.prose, 1, 2), False, ["p", "div"]))]
            return self.around(r.choice(["aside", "aside", "div", "section"]), inner, "sidebar", "side", "widget", "related", "recommended", "aside")
        if kind == "comments":
            one = r.choice(["article", "div", "li", "section"])
            inner = self.heading(["Comments", "Reader comments", "3 comments", "Discussion", "Responses", "Leave a reply"])
            for _ in range(r.randint(1, 6)):
                by = [("<" + (tag := r.choice(["b", "h4", "div", "cite"])) + ">", None), (r.choice(["Anna", "guest", "Reader 7", "Tom wrote:"]), False), (f"</{tag}>", None)]
                by = by if tag in ("h4", "div") else []
                inner += self.around(one, by + self.paragraphs(self.some(self.prose, 1, 2), False, ["p", "p", "div"]), "comment", "reply", "comment-body", "response")
            return self.around(r.choice(["section", "div", "ol", "aside"]), inner, "comments", "comment-list", "discussion", "respond", "disqus")
        if kind == "share":
            return self.around("div", self.links(2, 4), "share", "social", "tags", "meta")
        return self.around(r.choice(["footer", "footer", "div"]), self.paragraphs(["© " + t for t in self.some(self.short, 1, 3)], False, ["p", "div", "small"])
                           + (self.links(1, 5) if r.random() < 0.5 else []), "footer", "copyright", "foot", "site-footer")

    def page(self, title: str, texts: list[str]) -> tuple[str, list[bool]]:
        """A page around the article, and the labels of its blocks."""
        r = self.rng
        head = [(f"<{(tag := r.choice(['h1', 'h1', 'h2']))}>", None), (title, True), (f"</{tag}>", None)]
        head = self.around("header", head) if r.random() < 0.2 else head
        body = head + [x for t in texts for x in self.paragraphs([t], True, ["p", "p", "p", "div"])
                       + (self.region(r.choice(["advert", "share", "form", "sidebar"])) if r.random() < 0.06 else [])]
        wrap = [("article", ()), ("main", ()), ("div", ("content", "article-body", "entry", "post", "story", "main")),
                ("section", ("content", "article", "post-content")), ("td", ("content", "text", "main"))]
        for _ in range(r.randint(1, 2)):
            tag, names = r.choice(wrap)
            body = self.around(tag, body, *names)
        if r.random() < 0.35:
            body += self.region("comments")
        if r.random() < 0.3:
            body = self.around(r.choice(["main", "div"]), body, "wrapper", "page", "container")
        top = [k for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.4]
        r.shuffle(top)
        low = [k for k in ("sidebar", "comments", "share", "form", "advert", "footer", "notice") if r.random() < 0.35]
        left = self.region("sidebar") if r.random() < 0.15 else []
        parts = [x for k in top for x in self.region(k)] + left + body + [x for k in low for x in self.region(k)]
        text = "".join(_escaped(x) if label is not None else x for x, label in parts)
        return f"<html><body>{text}</body></html>", [label for _, label in parts if label is not None]


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def training_pages(pages: list[str], each: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks and labels of the pages whose structure tells them, and of ``each`` pages made from each of these."""
    told = []
    for page in pages:
        found = blocks(page)
        labels = [structural_label(b) for b in found]
        if any(labels):
            told.append((found, np.array([bool(x) for x in labels])))
    articles = [[b.text for b, x in zip(*t, strict=True) if x] for t in told]
    rng = random.Random(seed)
    prose = [t for a in articles for t in a[1:]] or ["text"]
    short = [b.text for f, x in told for b, y in zip(f, x, strict=True) if not y and len(b.text) < 120] + ["Home", "About", "Contact", "News"]
    out = list(told)
    for a in articles:
        for _ in range(each):
            maker = _Maker(rng, rng.sample(prose, min(len(prose), 12)), short)
            keep = a[1:] if len(a) <= 40 else rng.sample(a[1:], 39)
            page, labels = maker.page(a[0], keep)
            found = blocks(page)
            if len(found) == len(labels):                  # a text of white space or of one tag's name makes no block
                out.append((found, np.array(labels)))
    return out


# ---------------------------------------------------------------- vectors

@dataclass
class Sequences:
    """Pages as numbers: hashed tokens of all blocks in turn, their ends, figures, blocks of each page."""
    path: np.ndarray
    path_ends: np.ndarray
    words: np.ndarray
    word_ends: np.ndarray
    figures: np.ndarray
    sizes: np.ndarray


_paths, _words = Slots(0, PATH_SLOTS), Slots(0, WORD_SLOTS)


def vectors(pages: list[list[Block]]) -> Sequences:
    path, words, figures = [], [], []
    for page in pages:
        for k, b in enumerate(page):
            path.append([_paths[t] for t in path_tokens(b.path)])
            w = b.text.lower().split()
            words.append([_words[x] for x in w])
            n = len(b.text)
            figures.append((np.log1p(len(w)) / 4, min(1.0, b.linked / n), b.text[-1] in ".!?…:\"”", sum(map(str.isdigit, b.text)) / n,
                            b.text[:1].isupper(), k / len(page), (len(page) - k) / len(page), "©" in b.text or "|" in b.text))
    ends = [np.cumsum([len(x) for x in part], dtype=np.int64) for part in (path, words)]
    flat = [np.fromiter(chain.from_iterable(part), np.int64) for part in (path, words)]
    return Sequences(flat[0], ends[0], flat[1], ends[1], np.array(figures, np.float64).reshape(-1, FIGURES), np.array([len(p) for p in pages], np.int64))


def _spread(seqs: Sequences, rows: np.ndarray, part: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the blocks ``rows`` and, for each, the block's place among the rows."""
    ends, flat = getattr(seqs, f"{part}_ends"), seqs.path if part == "path" else seqs.words
    low = np.concatenate(([0], ends))[rows]
    n = ends[rows] - low
    owner = np.repeat(np.arange(len(rows)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + low[owner]
    return flat[at], owner


# ---------------------------------------------------------------- the network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class BlockLabeller:
    """Bidirectional LSTM over the blocks of pages; ``weights`` holds its arrays by name."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @staticmethod
    def fresh(seed: int) -> BlockLabeller:
        rng = np.random.default_rng(seed)
        bias = np.zeros((2, 4 * HIDDEN))
        bias[:, HIDDEN: 2 * HIDDEN] = 1                      # gates that keep the state begin open
        return BlockLabeller({
            "path": rng.normal(0, 0.3, (PATH_SLOTS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_SLOTS, WORD_DIM)),
            "into": rng.normal(0, INPUT ** -0.5, (2, INPUT, 4 * HIDDEN)), "over": rng.normal(0, HIDDEN ** -0.5, (2, HIDDEN, 4 * HIDDEN)),
            "bias": bias, "out": rng.normal(0, 0.1, (2 * HIDDEN + INPUT, 2)), "out_bias": np.zeros(2)})

    def inputs(self, seqs: Sequences, rows: np.ndarray) -> tuple[np.ndarray, list]:
        """Vectors of the blocks ``rows`` and what the way back needs."""
        x, kept = np.empty((len(rows), INPUT)), []
        for part, at, dim, more in (("path", 0, PATH_DIM, 0), ("word", PATH_DIM, WORD_DIM, 3)):
            tokens, owner = _spread(seqs, rows, part)
            # a mean drawn to zero where there are few words: one word says little
            share = 1 / np.maximum(1, np.bincount(owner, minlength=len(rows)) + more)
            table = self.weights[part]
            for k in range(dim):
                x[:, at + k] = np.bincount(owner, table[tokens, k], len(rows)) * share
            kept.append((tokens, owner, share))
        x[:, PATH_DIM + WORD_DIM:] = seqs.figures[rows]
        return x, kept

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict]:
        """Share of main text for each block of pages with ``sizes`` blocks, page after page in ``x``."""
        w = self.weights
        pages, steps = len(sizes), int(sizes.max(initial=0))
        first = np.cumsum(sizes) - sizes
        t = np.arange(steps)
        live = t < sizes[:, None]
        there = np.where(live, first[:, None] + t, len(x))                   # block at each step, forwards
        back = np.where(live, first[:, None] + sizes[:, None] - 1 - t, len(x))
        place = np.stack((there, back))                                       # the row behind all blocks is zero
        padded = np.concatenate((x, np.zeros((1, INPUT))))
        drive = np.matmul(padded[place].reshape(2, -1, INPUT), w["into"]).reshape(2, pages, steps, 4 * HIDDEN) + w["bias"][:, None, None]
        h, c = np.zeros((2, pages, HIDDEN)), np.zeros((2, pages, HIDDEN))
        gates, cells, states = [], [c], [h]
        for k in range(steps):
            z = drive[:, :, k] + np.matmul(h, w["over"])
            g = np.concatenate((_sigmoid(z[..., : 3 * HIDDEN]), np.tanh(z[..., 3 * HIDDEN:])), -1)   # in, keep, out, new
            c = g[..., HIDDEN: 2 * HIDDEN] * c + g[..., :HIDDEN] * g[..., 3 * HIDDEN:]
            h = g[..., 2 * HIDDEN: 3 * HIDDEN] * np.tanh(c)
            gates.append(g)
            cells.append(c)
            states.append(h)
        both = np.zeros((len(x) + 1, 2 * HIDDEN))
        if steps:
            seen = np.stack(states[1:], 2)
            for way in (0, 1):
                both[place[way], way * HIDDEN: (way + 1) * HIDDEN] = seen[way]
        both = np.concatenate((both[:-1], x), 1)
        logits = both @ w["out"] + w["out_bias"]
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return p[:, 1], {"place": place, "gates": gates, "cells": cells, "states": states, "both": both, "p": p, "padded": padded}

    def gradients(self, seqs: Sequences, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over the blocks and its gradient for every weight."""
        w = self.weights
        x, kept = self.inputs(seqs, rows)
        _, run = self.forward(x, sizes)
        n = len(rows)
        loss = -np.log(np.maximum(run["p"][np.arange(n), labels], 1e-12)).mean()
        error = (run["p"] - np.eye(2)[labels]) / n
        grads = {"out": run["both"].T @ error, "out_bias": error.sum(0)}
        deep = error @ w["out"].T
        dx = np.concatenate((deep[:, 2 * HIDDEN:], np.zeros((1, INPUT))))
        place, steps = run["place"], run["place"].shape[2]
        tail = np.concatenate((deep[:, : 2 * HIDDEN], np.zeros((1, 2 * HIDDEN))))
        arriving = np.stack((tail[place[0], :HIDDEN], tail[place[1], HIDDEN:]))
        dz = np.empty((2, len(sizes), steps, 4 * HIDDEN))
        dh, dc = np.zeros((2, len(sizes), HIDDEN)), np.zeros((2, len(sizes), HIDDEN))
        over = np.zeros_like(w["over"])
        for k in range(steps - 1, -1, -1):
            g, squashed = run["gates"][k], np.tanh(run["cells"][k + 1])
            i, f, o, new = (g[..., a * HIDDEN: (a + 1) * HIDDEN] for a in range(4))
            dh = dh + arriving[:, :, k]
            dc = dc + dh * o * (1 - squashed ** 2)
            z = dz[:, :, k]
            z[..., :HIDDEN] = dc * new * i * (1 - i)
            z[..., HIDDEN: 2 * HIDDEN] = dc * run["cells"][k] * f * (1 - f)
            z[..., 2 * HIDDEN: 3 * HIDDEN] = dh * squashed * o * (1 - o)
            z[..., 3 * HIDDEN:] = dc * i * (1 - new ** 2)
            over += np.matmul(run["states"][k].transpose(0, 2, 1), z)
            dh, dc = np.matmul(z, w["over"].transpose(0, 2, 1)), dc * f
        flat = dz.reshape(2, -1, 4 * HIDDEN)
        grads["over"], grads["bias"] = over, flat.sum(1)
        grads["into"] = np.matmul(run["padded"][place].reshape(2, -1, INPUT).transpose(0, 2, 1), flat)
        for way in (0, 1):
            live = place[way] < n                            # a block is at one step only
            dx[place[way][live]] += (dz[way] @ w["into"][way].T)[live]
        for (tokens, owner, share), name, at, dim in ((kept[0], "path", 0, PATH_DIM), (kept[1], "word", PATH_DIM, WORD_DIM)):
            d = dx[:-1, at: at + dim] * share[:, None]
            grads[name] = np.stack([np.bincount(tokens, d[owner, k], len(w[name])) for k in range(dim)], 1)
        return float(loss), grads

    def predict(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Share of main text of every block of every page; pages of like length run together."""
        seqs = vectors(pages)
        first = np.cumsum(seqs.sizes) - seqs.sizes
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = np.argsort(-seqs.sizes, kind="stable")
        order = order[seqs.sizes[order] > 0]
        at = 0
        while at < len(order):
            part = order[at: at + max(1, _CELLS // int(seqs.sizes[order[at]]))]
            at += len(part)
            sizes = seqs.sizes[part]
            rows = np.concatenate([np.arange(first[p], first[p] + seqs.sizes[p]) for p in part])
            p, _ = self.forward(self.inputs(seqs, rows)[0], sizes)
            for k, piece in zip(part, np.split(p, np.cumsum(sizes)[:-1]), strict=True):
                out[k] = piece
        return out


def fit(data: list[tuple[list[Block], np.ndarray]], *, epochs: int = 14, batch: int = 24, rate: float = 0.01,
        decay: float = 1.0, seed: int = 7) -> BlockLabeller:
    """A labeller trained by Adam on pages with labels, word vectors decaying; without any page, an untrained one."""
    net, rng = BlockLabeller.fresh(seed), np.random.default_rng(seed)
    if not data:
        return net
    seqs = vectors([b for b, _ in data])
    labels = np.concatenate([y for _, y in data]).astype(np.int64)
    first = np.cumsum(seqs.sizes) - seqs.sizes
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    batches = -(-len(data) // batch)
    for step in range(epochs * batches):
        if step % batches == 0:
            # pages of like length together, in random order of batches
            by_size = np.argsort(seqs.sizes + rng.random(len(data)) * 6, kind="stable")
            turns = rng.permutation(batches)
        part = by_size[turns[step % batches] * batch:][:batch]
        part = part[seqs.sizes[part] > 0]
        if not len(part):
            continue
        rows = np.concatenate([np.arange(first[p], first[p] + seqs.sizes[p]) for p in part])
        _, grads = net.gradients(seqs, rows, seqs.sizes[part], labels[rows])
        pace = rate * (1 - step / (epochs * batches)) ** 0.5
        for name, g in grads.items():
            m, v = moment[name]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            if name == "word":
                net.weights[name] *= 1 - pace * decay
            net.weights[name] -= pace * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-8)
    return net


# ---------------------------------------------------------------- tables

def train_extractor(pages: DataFrame, *, html_col: str = "html", sample: int = 384, most_chars: int = 32_768, each: int = 4,
                    seed: int = 7) -> BlockLabeller:
    """A labeller trained on ``sample`` different pages of at most ``most_chars`` characters, those of the smallest hashes of their
    text, and on ``each`` made pages for each of them. Hashes are chosen first, so the pages that come to the driver are bounded
    by sample and size alone (12 MB as given)."""
    text = F.col(html_col)
    fit_in = pages.where(text.isNotNull() & (F.length(text) <= most_chars)).select(text.alias("html"), F.xxhash64(text).alias("h"))
    least = [r["h"] for r in fit_in.select("h").distinct().orderBy("h").limit(sample).collect()]
    rows = fit_in.where(F.col("h").isin(least)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()
    return fit(training_pages([r["html"] for r in rows], each, seed), seed=seed)


def extract_text(pages: DataFrame, net: BlockLabeller, *, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` (all rows and columns but the markup) with ``text_col``, the main text of each page.

    Blocks that the labeller takes for main text are joined by ``\\n`` in page order. Null and empty
    pages, and pages without main text, have an empty text. Rows are judged one by one, so null
    ids, ties and repeated rows need no care; a column already named ``text_col`` is replaced.
    An empty table gives an empty result.
    """
    weights = {k: v.astype(np.float32) for k, v in net.weights.items()}
    keep = [c for c in pages.columns if c not in (html_col, text_col)]
    base = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).alias(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = BlockLabeller({k: v.astype(np.float64) for k, v in weights.items()})
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for rows, pages_ in text_groups(batch, text_col):
                found = [blocks(p) for p in pages_]
                shares = labeller.predict(found)
                texts = ["\n".join(b.text for b, s in zip(f, p.tolist(), strict=True) if s >= 0.5) for f, p in zip(found, shares, strict=True)]
                yield rows.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return base.mapInArrow(run, base.schema)


def page_number(page_id: int | None) -> int:
    """Hash of a page's id, for parting pages into those learnt from and those held out in tests."""
    return zlib.crc32(str(page_id).encode())
