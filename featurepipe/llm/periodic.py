"""Operator 11: runs of periodic text, from longest common extensions over a difference cover.

Words of many texts form one sequence of symbols with a separator after each text. Only suffixes
that begin at places of a difference cover (4 of 13 residues) are sorted: their next 13 words
become one symbol each, in the order of the words, and prefix doubling over these symbols sorts
the samples. The longest common extension of two places compares words until both stand on the
cover, at most 12, and then takes a minimum over the prefixes that neighbouring samples share,
from a sparse table.

Runs are found period by period on a harmonic grid. A run of at least e periods holds a grid place
and the place one period on, if the grid of period q has steps of (e - 1) * q, so n words take
n / ((e - 1) * q) places a period and n log n / (e - 1) in all. Places whose word differs from
the one a period on go at once. The extension to the right comes from one query; to the left, the
first grid place of a run has fewer than a step's words before it, searched by halving.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import WordIds, text_groups
from featurepipe.llm.suffixes import suffix_ranks

# fixed values: a perfect difference set; every difference of residues is one of two members
MODULUS, COVER = 13, (0, 1, 3, 9)
MIN_EXPONENT, MIN_WORDS = 4, 6
_GROUP = 1 << 20                     # characters of text handled at once
_PLACES = 1 << 20                    # grid places looked at together

_IN = np.isin(np.arange(MODULUS), COVER)
#: words to go from places of two residues until both are on the cover
_SYNC = np.array([[next(k for k in range(MODULUS) if _IN[(a + k) % MODULUS] and _IN[(b + k) % MODULUS])
                   for b in range(MODULUS)] for a in range(MODULUS)])


class CommonExtensions:
    """Longest common extensions in ``keys``: symbols from 1 up, 0 after every text (and at the end)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.concatenate((keys, np.zeros(MODULUS, keys.dtype)))
        place = np.flatnonzero((keys > 0) & _IN[np.arange(len(keys)) % MODULUS])
        names = self._names(place)
        # samples text by text and residue by residue: a step there is MODULUS words
        text = np.cumsum(keys == 0)[place]
        order = np.argsort(text * MODULUS + place % MODULUS, kind="stable")
        place, names, text = place[order], names[order], text[order]
        last = np.ones(len(place), bool)
        last[:-1] = (text[1:] != text[:-1]) | (place[1:] % MODULUS != place[:-1] % MODULUS)
        at = np.arange(len(place)) + np.concatenate(([0], np.cumsum(last)[:-1])) if len(place) else place
        reduced = np.zeros(len(place) + int(last.sum()), np.int64)
        reduced[at] = names
        levels: list[np.ndarray] = []
        rank = suffix_ranks(reduced, levels) if len(reduced) else reduced
        self.rank = np.full(len(self.keys), -1, np.int64)
        self.rank[place] = rank[at]
        self.table = self._table(rank, levels, at, place)

    def _names(self, place: np.ndarray) -> np.ndarray:
        """Order numbers, from 1, of the next MODULUS words of each place; beyond a text's end all are 0."""
        bits = max(1, int(self.keys.max(initial=0)).bit_length())
        per = max(1, 63 // bits)
        columns, live = [], np.ones(len(place), bool)
        for low in range(0, MODULUS, per):
            packed = np.zeros(len(place), np.int64)
            for k in range(low, min(low + per, MODULUS)):
                word = np.where(live, self.keys[place + k], 0)
                live &= word > 0
                packed = (packed << bits) | word
            columns.append(packed)
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(place), bool)
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
        names = np.empty(len(place), np.int64)
        names[order] = np.cumsum(new) + 1
        return names

    def _table(self, rank: np.ndarray, levels: list[np.ndarray], at: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Sparse table of minima over the words that neighbours in suffix order share."""
        n = len(rank)
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        words = np.full(n, -1, np.int64)                       # text place of a reduced place; -1 at separators
        words[at] = place
        a, b = order[:-1], order[1:]
        steps = np.zeros(len(a), np.int64)
        near = np.flatnonzero(levels[0][a] == levels[0][b]) if levels else np.empty(0, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a[near] + steps[near]] == levels[k][b[near] + steps[near]]
            steps[near[same]] += 1 << k
        shared = steps * MODULUS
        x, y = words[np.minimum(a + steps, n - 1)], words[np.minimum(b + steps, n - 1)]
        live = np.flatnonzero((x >= 0) & (y >= 0))
        for k in range(MODULUS):                               # the words of the first symbols that differ
            live = live[(self.keys[x[live] + k] == self.keys[y[live] + k]) & (self.keys[x[live] + k] > 0)]
            shared[live] += 1
        table = [np.concatenate(([0], shared)).astype(np.int32)]     # table[0][r]: with the neighbour before
        width = 1
        while 2 * width <= n:
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``i`` < ``j``, places of one text, have in common."""
        out = _SYNC[i % MODULUS, j % MODULUS].astype(np.int64)
        live = np.arange(len(i))
        for k in range(MODULUS):
            stop = out[live] > k
            differ = stop & (self.keys[i[live] + k] != self.keys[j[live] + k])
            out[live[differ]] = -k - 1                         # ended: k words in common
            live = live[stop & ~differ]
            if not len(live):
                break
        done = out < 0
        go = np.flatnonzero(~done)
        go = go[self.keys[j[go] + out[go]] > 0]
        a, b = self.rank[i[go] + out[go]], self.rank[j[go] + out[go]]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            row = self.table[k]
            out[go[own]] += np.minimum(row[low[own]], row[high[own] - (1 << int(k))])
        out[done] = -out[done] - 1
        return out


def periodic_runs(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, exponent: int = MIN_EXPONENT,
                  least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of all runs of the texts that lie in ``keys`` at ``starts``,
    by text, start and period. ``keys`` are as for :class:`CommonExtensions`; ``exponent`` is 2 or more."""
    extend = CommonExtensions(keys).of
    per = sizes // exponent                                     # periods 1..per of each text
    text = np.repeat(np.arange(len(sizes)), per)
    period = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per) + 1
    step = (exponent - 1) * period
    grid = -(-(sizes[text] - period) // step)                   # places 0, step, 2 * step, ... before size - period
    cuts = np.unique(np.append(np.searchsorted(np.cumsum(grid), np.arange(0, int(grid.sum()) + 1, _PLACES)), len(grid)))
    found = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        n = grid[low:high]
        which = np.repeat(np.arange(low, low + len(n)), n)
        x = (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)) * step[which]
        at = starts[text[which]] + x
        same = keys[at] == keys[at + period[which]]
        which, x, at = which[same], x[same], at[same]
        q, gap = period[which], step[which]
        right = extend(at, at + q)
        need = np.maximum(0, np.maximum(least, exponent * q) - q - right)     # words that must fit on the left
        fits = np.flatnonzero((need <= x) & (need < gap))
        back = at[fits] - need[fits]
        fits = fits[extend(back, back + q[fits]) >= need[fits]]
        # another grid place before it in the run finds it too
        earlier = fits[x[fits] >= gap[fits]]
        back = at[earlier] - gap[earlier]
        drop = earlier[extend(back, back + q[earlier]) >= gap[earlier]]
        fits = np.setdiff1d(fits, drop, assume_unique=True)
        least_left, most = need[fits].copy(), np.minimum(x[fits], gap[fits] - 1)
        while len(open_ := np.flatnonzero(least_left < most)):
            mid = (least_left[open_] + most[open_] + 1) // 2
            back = at[fits[open_]] - mid
            good = extend(back, back + q[fits[open_]]) >= mid
            least_left[open_[good]] = mid[good]
            most[open_[~good]] = mid[~good] - 1
        found.append(np.column_stack((text[which[fits]], x[fits] - least_left, least_left + right[fits] + q[fits], q[fits])))
    rows = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    # a multiple of a run's period gives the same stretch: the smallest stays
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one text; one text of ten, by its id, ends in repeats of its own words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if not words or h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a: a + p] * (-(-(n - a) // p)))[: n - a]


_FIELDS = "doc_id long, n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, text string"


def collapse_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", exponent: int = MIN_EXPONENT,
                  least: int = MIN_WORDS, plant: bool = False) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, runs, text)`` of every row.

    A run is a stretch of words in which words ``period`` apart are identical, the smallest such
    period, of at least ``exponent`` periods and ``least`` words, that no neighbour extends. ``runs``
    lists them by start and period; start, length and period are those of the run with the
    greatest length / period (the smallest start, then period of equals; null without a run).
    ``text`` holds the words joined by single spaces without those that any run repeats: all of a
    run but its first period. Words are runs of characters other than ASCII white space, compared
    as they are. ``plant`` first makes one of ten documents periodic, by a hash of its id. Null
    and empty texts have no words, no run and an empty text; null ids are judged like others (and
    never planted), repeated rows one by one. Other columns are not read; an empty table gives
    an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_groups(batch, "text", _GROUP):
                words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
                if plant:
                    words = [planted(i, w) for i, w in zip(rows.column(0).to_pylist(), words, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *_judged(words, exponent, least)], _NAMES)

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, _FIELDS)


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "runs", "text"]


def _judged(words: list[list[bytes]], exponent: int, least: int) -> list[pa.Array]:
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    keys = np.zeros(int((sizes + 1).sum()), np.int64)
    keys[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(words)), sizes)] = WordIds().of([x for w in words for x in w]) + 1
    text, start, length, period = periodic_runs(keys, starts, sizes, exponent, least)
    cover = np.zeros(len(keys) + 1, np.int64)
    np.add.at(cover, starts[text] + start + period, 1)
    np.add.at(cover, starts[text] + start + length, -1)
    gone = np.cumsum(cover) > 0
    bounds = np.searchsorted(text, np.arange(len(words) + 1))
    best: list = [[], [], []]
    out = []
    for d, w in enumerate(words):
        mine = slice(bounds[d], bounds[d + 1])
        k = None
        if bounds[d] < bounds[d + 1]:
            triples = list(zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist(), strict=True))
            k = min(triples, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            drop = gone[starts[d]: starts[d] + sizes[d]]
            w = [x for x, g in zip(w, drop.tolist(), strict=True) if not g] if drop.any() else w
        for column, value in zip(best, k or (None, None, None), strict=True):
            column.append(value)
        out.append(b" ".join(w).decode("utf-8", "surrogatepass"))
    each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    return [pa.array(np.diff(bounds), pa.int64()), *(pa.array(c, pa.int64()) for c in best),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each), pa.array(out, pa.string())]
