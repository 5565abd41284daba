"""Operator 3: language identification by a byte convolutional network.

A text is lower-cased and cut into windows of 256 bytes (UTF-8), all of them, the last one padded. Per
window: byte embeddings, filters of widths 2, 3 and 4, the largest answer of each filter, and a
softmax layer. A document's score for a language is the mean probability over its windows.

The network is trained in numpy on the driver, on windows of a bounded sample of labelled
rows: at most about ``per_language`` documents of each language, chosen by a hash of the id so
that the choice does not depend on partitioning. Everything else covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import text_groups

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16              # of each width
EMBED = 8
_BLOCK = 512              # windows that go through the network at once
_MAYBE = re.compile(r"[^\W\d_]+")       # letters, and some numbers beside


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode category L)."""
    return any(any(map(str.isalpha, m[0])) for m in _MAYBE.finditer(text))


def windows(text: str) -> np.ndarray:
    """All windows of a text, zero-padded: (n, WINDOW) bytes, one at least."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteNet:
    """Weights: embedding (256, EMBED); filters by width (width, EMBED, FILTERS) and bias; output layer."""
    languages: list
    embed: np.ndarray
    filters: list
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> ByteNet:
        hidden = FILTERS * len(WIDTHS)
        embed = rng.normal(0, 0.5, (256, EMBED))
        embed[0] = 0
        return cls(languages, embed, [rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS)) for w in WIDTHS],
                   np.zeros(hidden), rng.normal(0, hidden ** -0.5, (hidden, len(languages))), np.zeros(len(languages)))

    def answers(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Answers of the filters of each width at every place: (windows, places, FILTERS)."""
        for weights in self.filters:
            tables = np.einsum("bd,wdf->wbf", self.embed, weights)
            places = x.shape[1] - len(weights) + 1
            yield sum(t[x[:, o: o + places]] for o, t in enumerate(tables))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, rng: np.random.Generator, rate: float = 0.01, batch: int = 64) -> None:
        """Adam on the cross entropy of windows ``x`` with language numbers ``y``."""
        params = [self.embed, *self.filters, self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        steps = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at: at + batch]
                grads = self._gradients(x[rows], y[rows])
                steps += 1
                now = rate * (1 - epoch / epochs)
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= now * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
                self.embed[0] = 0

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n = np.arange(len(x))[:, None]
        peaks, best = [], []
        for z in self.answers(x):
            p = z.argmax(1)
            peaks.append(p)
            best.append(np.take_along_axis(z, p[:, None], 1)[:, 0])
        z = np.concatenate(best, 1) + self.bias
        h = np.maximum(z, 0)
        d = _softmax(h @ self.out + self.out_bias)
        d[np.arange(len(x)), y] -= 1
        d /= len(x)
        dz = (d @ self.out.T) * (z > 0)
        d_embed, d_filters = np.zeros_like(self.embed), []
        for k, (weights, p) in enumerate(zip(self.filters, peaks, strict=True)):
            own = dz[:, k * FILTERS: (k + 1) * FILTERS]
            g = np.empty_like(weights)
            for o in range(len(weights)):
                seen = x[n, p + o]                              # the byte under each filter's peak
                g[o] = np.einsum("nfd,nf->df", self.embed[seen], own)
                np.add.at(d_embed, seen.ravel(), (own[:, :, None] * weights[o].T[None]).reshape(-1, EMBED))
            d_filters.append(g)
        return [d_embed, *d_filters, dz.sum(0), h.T @ d, d.sum(0)]

    def pair_tables(self) -> list[list[np.ndarray]]:
        """For each width, tables of the answers of byte pairs at offsets 0, 2, ... (the last may be one byte)."""
        out = []
        for weights in self.filters:
            t = np.einsum("bd,wdf->wbf", self.embed, weights).astype(np.float32)
            out.append([(t[o][:, None] + t[o + 1][None]).reshape(-1, FILTERS) if o + 1 < len(t) else t[o]
                        for o in range(0, len(t), 2)])
        return out

    def probabilities(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Language probabilities of each window."""
        out = []
        for at in range(0, len(x), _BLOCK):
            b = x[at: at + _BLOCK].astype(np.int32)
            pair = (b[:, :-1] << 8) | b[:, 1:]
            best = []
            for width, own in zip(WIDTHS, tables, strict=True):
                places = WINDOW - width + 1
                z = None
                for k, t in enumerate(own):
                    ids = (pair if len(t) > 256 else b)[:, 2 * k: 2 * k + places]
                    z = t[ids] if z is None else np.add(z, t[ids], out=z)
                best.append(z.max(1))
            h = np.maximum(np.concatenate(best, 1) + self.bias, 0)
            out.append(_softmax(h @ self.out + self.out_bias))
        return np.concatenate(out)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train_language_id(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      per_language: int = 1500, windows_each: int = 4, epochs: int = 6, seed: int = 7) -> ByteNet | None:
    """A network trained on rows with id, text and language (others are left out); None without any.

    Bounds of the sample: about ``per_language`` documents of a language and ``windows_each``
    windows, spread over the whole text, of each.
    """
    known = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "id IS NOT NULL AND length(text) > 0 AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / float(1 << 30)
    share = {lang: min(1.0, per_language / n) for lang, n in counts.items()}
    chosen = known.where(draw < F.element_at(F.create_map(*[F.lit(v) for kv in share.items() for v in kv]), F.col("lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_groups(batch, "text"):
                ids, langs, out = [], [], []
                for i, lang, text in zip(rows.column("id").to_pylist(), rows.column("lang").to_pylist(), texts, strict=True):
                    w = windows(text)
                    for k in np.unique(np.linspace(0, len(w) - 1, windows_each).astype(int)):
                        ids.append(str(i))
                        langs.append(lang)
                        out.append(w[k].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                                 ["id", "lang", "bytes"])

    rows = sorted((r["id"], r["lang"], bytes(r["bytes"])) for r in chosen.mapInArrow(cut, "id string, lang string, bytes binary").collect())
    languages = sorted(counts)
    x = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(r[1]) for r in rows])
    rng = np.random.default_rng(seed)
    net = ByteNet.fresh(languages, rng)
    net.train(x, y, epochs, rng)
    return net


def predict_language(docs: DataFrame, net: ByteNet | None, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score`` (mean probability, 0 to 1).

    Texts that are null or hold no letter get ``und`` and 0, as does everything without a
    network. Ties go to the language first in the alphabet. Rows are judged one by one, so null
    ids and repeated rows need no care; only the text is looked at.
    """
    weights = None if net is None else (net.languages, net.embed, net.filters, net.bias, net.out, net.out_bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if weights is None else ByteNet(*weights)
        tables = None if own is None else own.pair_tables()
        for batch in batches:
            for rows, texts in text_groups(batch, "_text"):
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                judged = [i for i, t in enumerate(texts) if own is not None and t and has_letter(t)]
                if judged:
                    cut = [windows(texts[i]) for i in judged]
                    p = own.probabilities(np.concatenate(cut), tables)
                    starts = np.cumsum([0, *map(len, cut)])[:-1]
                    mean = np.add.reduceat(p, starts) / np.array([len(c) for c in cut])[:, None]
                    for i, m in zip(judged, mean, strict=True):
                        k = int(m.argmax())
                        lang[i], score[i] = own.languages[k], min(1.0, float(m[k]))
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in range(len(keep))), pa.array(lang), pa.array(score)],
                                                 [*keep, "lang_pred", "score"])

    base = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in keep)
    return base.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row stays out of training: crc32 of the id as text, modulo 5, is 0 (null: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
