"""Operator 8: SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs: the pair whose piece scores highest is
merged first, the leftmost of equals; a merge puts the pairs with its new neighbours on the
agenda (a heap; the plain list of pairs for short parts). Symbols that end outside the vocabulary
become byte pieces. A merge only ever makes pieces, so none goes over two characters that no piece
holds side by side: texts are cut there, by a table of the pairs of Latin-1 characters, or else
before space marks (no piece joins a character to a following mark, which the codec verifies on
loading). A worker loads the vocabulary once and remembers the ids of such parts as packed bytes,
up to a bound in bytes; every part that it works out is checked against the sentencepiece
library, and any difference fails the job. Ids are decoded by a table of the bytes that each stands for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import Remembered, byte_slices, closed, in_order, looked_up, text_groups, worker_cache

SPACE = "▁"
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]*")
_HELD = 128 << 20                               # bytes of parts that a worker remembers
_SHORT = 40                                     # symbols of a part whose agenda is a plain list
_NONE = float("-inf")
_CHARS = 1 << 20                                # characters of text coded at once


class PieceCodec:
    """Encoder and decoder for one merge-type vocabulary with byte fallback and a dummy prefix."""

    def __init__(self, model: str, check: bool = True):
        self.check = check                       # whether new parts are compared with the library
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, n = self.library, self.library.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: lib.get_score(i) for i in plain}
        byte_ids = [i for i in range(n) if lib.is_byte(i)]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in byte_ids}
        self.end = lib.eos_id()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or len(self.byte_id) != 256:
            raise ValueError("a merge-type vocabulary with byte fallback, and space marks at the front only, is needed")
        if lib.normalize("a  Åﬁ b") != "a  Åﬁ b".replace(" ", SPACE) and \
                lib.normalize("a  Åﬁ b") != SPACE + "a  Åﬁ b".replace(" ", SPACE):
            raise ValueError("the vocabulary changes texts before encoding them; only space marks are supported")
        # decoding: a piece's text, or the byte that it stands for
        self.text = [p.replace(SPACE, " ") for p in self.pieces]
        for i in range(n):
            if lib.is_control(i):
                self.text[i] = ""
            elif lib.is_unknown(i):
                self.text[i] = " ⁇ "
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.byte = {i: b for b, i in self.byte_id.items()}
        # packed ids of parts: Latin-1 bytes with spaces as marks, or text of which a single mark is left off
        self.known = Remembered(_HELD)
        beside = {p[i: i + 2] for p in self.ids for i in range(len(p) - 1)}
        letters = [SPACE if c == 32 else chr(c) for c in range(256)]
        self.apart = np.array([[a + b not in beside for b in letters] for a in letters])
        self.line = lib.encode("\n")
        if not all(self.apart[10]) or not self.line:
            raise ValueError("a vocabulary without line ends in its pieces is needed")
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        said = [bytes([self.byte[i]]) if i in self.byte else t.encode() for i, t in enumerate(self.text)]
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_ends = np.cumsum([len(x) for x in said])
        self.marked = np.array([p.startswith(SPACE) for p in self.pieces])

    def merge(self, unit: str) -> tuple[int, ...]:
        """Ids of one part, by the agenda."""
        sym: list = list(unit)
        n = len(sym)
        if n <= _SHORT:
            get = self.score.get
            agenda = [get(a + b, _NONE) for a, b in zip(sym, sym[1:], strict=False)]
            while agenda and (best := max(agenda)) != _NONE:
                i = agenda.index(best)
                sym[i: i + 2] = [sym[i] + sym[i + 1]]
                del agenda[i]
                if i < len(agenda):
                    agenda[i] = get(sym[i] + sym[i + 1], _NONE)
                if i:
                    agenda[i - 1] = get(sym[i - 1] + sym[i], _NONE)
            return self._ids(sym)
        score = self.score
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            s = score.get(sym[i] + sym[i + 1])
            if s is not None:
                agenda.append((-s, i, i + 1, sym[i] + sym[i + 1]))
        heapify(agenda)
        while agenda:
            _, i, j, piece = heappop(agenda)
            if sym[i] is None or sym[j] is None or after[i] != j or sym[i] + sym[j] != piece:
                continue                                     # one of the two has been merged since
            sym[i], sym[j] = piece, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                s = score.get(piece + sym[k])
                if s is not None:
                    heappush(agenda, (-s, i, k, piece + sym[k]))
            h = before[i]
            if h >= 0:
                s = score.get(sym[h] + piece)
                if s is not None:
                    heappush(agenda, (-s, h, i, sym[h] + piece))
        return self._ids([s for s in sym if s is not None])

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        ids = self.ids
        out: list[int] = []
        for s in symbols:
            i = ids.get(s)
            out.extend((i,) if i is not None else map(self.byte_id.__getitem__, s.encode("utf-8", "surrogatepass")))
        return tuple(out)

    @staticmethod
    def units(text: str) -> list[str]:
        """Units of a text: space marks and what follows up to the next space mark; a single mark is left off."""
        if not text:
            return []
        words = text.split(" ")
        if "" not in words and SPACE not in text:
            return words
        return [u[1:] if u[1:2] != SPACE and u[0] == SPACE else u for u in _UNITS.findall(SPACE + text.replace(" ", SPACE))[:-1]]

    def _cut(self, raws: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Parts of Latin-1 texts that no piece joins, and the number of each text."""
        codes = np.frombuffer(b"".join(raws), np.uint8)
        first = np.cumsum([0, *map(len, raws)])
        begin = np.zeros(len(codes) + 1, bool)
        begin[1:-1] = self.apart[codes[:-1], codes[1:]] if len(codes) else False
        begin[first[:-1]] = True
        starts = np.flatnonzero(begin[:-1])
        return byte_slices(codes, starts), np.diff(np.searchsorted(starts, first))

    @staticmethod
    def _marked(part) -> str:
        if isinstance(part, bytes):
            return part.decode("latin-1").replace(" ", SPACE)
        return part if part.startswith(SPACE) else SPACE + part

    def _learn(self, fresh: list) -> None:
        units = list(map(self._marked, fresh))
        found = list(map(self.merge, units))
        if self.check:
            self._compare(units, found)
        self.known.put_all(fresh, [np.array(ids, self.kind).tobytes() for ids in found])

    def pack(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, in one array, and the number of each; null is empty."""
        latin, raws, rest = [], [], []
        for k, t in enumerate(texts):
            try:
                raws.append((" " + t).encode("latin-1") if t else b"")
                latin.append(k)
            except UnicodeEncodeError:
                rest.append(k)
        parts, kind = [], self.kind
        if latin or not rest:
            keys, n = self._cut(raws)
            ids, sizes = looked_up(keys, self.known, self._learn, kind)
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(n)))]
            parts.append((latin, *closed(ids, np.diff(ends), self.end)))
        if rest:
            split = [self.units(texts[k]) for k in rest]
            self._learn(self.known.missing(chain.from_iterable(split)))
            packed = [b"".join(map(self.known.__getitem__, u)) for u in split]
            parts.append((rest, *closed(np.frombuffer(b"".join(packed), kind), np.array([len(x) // kind.itemsize for x in packed]), self.end)))
        return in_order(parts, len(texts), kind)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of every text with the end id; null is empty."""
        ids, sizes = self.pack(texts)
        return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(texts) else []

    def _compare(self, units: list[str], found: list[tuple[int, ...]]) -> None:
        # the library puts the first mark of a text itself; a part without one is read behind a line end
        plain = [(u[1:] if u.startswith(SPACE) else "\n" + u).replace(SPACE, " ") for u in units]
        for u, t, own, ids in zip(units, plain, found, self.library.encode(plain, num_threads=1), strict=True):
            if ids != (list(own) if u.startswith(SPACE) else [*self.line, *own]) and t:
                raise AssertionError(f"part {u!r}: agenda {own}, library {ids}")

    def texts(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """Texts of runs of ``sizes`` ids, as :meth:`decode` gives them."""
        ends = self.said_ends
        low = np.concatenate(([0], ends[:-1]))[ids]
        n = ends[ids] - low
        upto = np.concatenate(([0], np.cumsum(n)))
        data = self.said[np.arange(upto[-1]) - np.repeat(upto[:-1] - low, n)]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        first, last = upto[bounds[:-1]], upto[bounds[1:]]
        full = last > first
        head = ids[np.minimum(bounds[:-1], max(0, len(ids) - 1))]
        plain = not full.any() or not (((data[first[full]] & 0xC0) == 0x80).any() or (n[bounds[:-1][full]] == 0).any())
        try:
            raw = data.tobytes()
            raw.decode("utf-8")
        except UnicodeDecodeError:
            plain = False
        if not plain:                                          # byte pieces that are no whole characters, or ids without text in front
            return pa.array([self.decode(x.tolist()) for x in np.split(ids, bounds[1:-1])], pa.string())
        first = first + (full & self.marked[head])             # the dummy mark
        return pa.array([raw[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)], pa.binary()).cast(pa.string())

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids`` as the library gives it: marks to spaces, the dummy one dropped, bytes joined."""
        text, byte = self.text, self.byte
        if not byte.keys().isdisjoint(ids):
            return self._decode_bytes(ids)
        out = "".join(map(text.__getitem__, ids))
        return out[1:] if self._dummy(ids) else out

    def _dummy(self, ids: list[int]) -> bool:
        first = next((i for i in ids if i not in self.silent), None)
        return first is not None and self.pieces[first].startswith(SPACE)

    def _decode_bytes(self, ids: list[int]) -> str:
        out, run, byte, text = [], bytearray(), self.byte, self.text
        for i in ids:
            b = byte.get(i)
            if b is None:
                if run:
                    out.append(_from_bytes(run))
                    run.clear()
                out.append(text[i])
            else:
                run.append(b)
        out.append(_from_bytes(run))
        joined = "".join(out)
        return joined[1:] if self._dummy(ids) else joined


def _from_bytes(run: bytearray) -> str:
    """UTF-8 text of byte pieces; each byte that begins no whole character gives U+FFFD."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at, raw = [], 0, bytes(run)
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at: at + n].decode("utf-8"))
                break
            except UnicodeDecodeError:
                n = 0
        else:
            out.append("�")
            n = 1
        at += n or 1
    return "".join(out)


def encode_pieces(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text",
                  check: bool = True) -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` of every whole text.

    Null and empty texts give the end id alone and an empty decoded text. Rows are coded one by
    one, so null ids, ties and repeated rows need no care. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache("piece codecs")
        if (model, check) not in held:
            held[model, check] = PieceCodec(model, check)
        codec = held[model, check]
        for batch in batches:
            for rows, texts in text_groups(batch, "text", _CHARS):
                ids, sizes = codec.pack(texts)
                ids = ids.astype(np.int32)
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(ends, pa.array(ids)), codec.texts(ids, sizes)],
                                                 ["doc_id", "ids", "decoded"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
