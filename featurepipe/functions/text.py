"""Text expressions: accent stripping (B3), Python-compatible strip/split (B13, B14), digit
flags (B15). All run inside the JVM; no Python worker is involved.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, i.e. what str.strip() and
# str.split() treat as whitespace: tab, LF, VT, FF, CR, the four information separators
# U+001C..U+001F, space, U+0085, U+00A0, U+1680, U+2000..U+200A, U+2028, U+2029, U+202F,
# U+205F and U+3000.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}]"
)
PY_WHITESPACE = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
                 + "\u2028\u2029\u202f\u205f\u3000")
# Python's \d on str is Unicode category Nd; Java needs (?U) for the same class.
UNICODE_DIGIT = r"(?U)\d"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated one time a row, however often the body names it: the
    optimizer copies a column into all its uses, but not a lambda's variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_CODE_POINTS = (range(0x80, 0xD800), range(0xE000, 0x30000), range(0xE0000, 0xE0200))
_HANGUL = range(0xAC00, 0xD7A4)
_MARKER = "\uffff"                     # stands for a character that needs the long way; no text character


@dataclass(frozen=True)
class _Accents:
    one: str                          # characters to replace by one other
    by: str
    gone: str                         # characters to delete
    long: str                         # characters that need the long way
    latin: int                        # the first code point that is deleted or needs the long way
    several: dict[str, str]           # decompositions that keep more than one character, in full
    marks: dict[int, str]             # combining characters that are not Mn, by combining class
    combining: str                    # regex class of the characters that begin with a combining one


def _ranges(chars: list[str]) -> str:
    """Regex class of sorted characters."""
    out, at = [], 0
    while at < len(chars):
        end = at
        while end + 1 < len(chars) and ord(chars[end + 1]) == ord(chars[end]) + 1:
            end += 1
        out.append(f"\\x{{{ord(chars[at]):x}}}-\\x{{{ord(chars[end]):x}}}")
        at = end + 1
    return "".join(out)


@lru_cache(maxsize=1)
def _accents() -> _Accents:
    """From the Unicode data."""
    one, gone, several, marks, combining = {}, [], {}, {}, []
    for cp in (cp for part in _CODE_POINTS for cp in part):
        c = chr(cp)
        full = unicodedata.normalize("NFD", c)
        kept = [x for x in full if unicodedata.category(x) != "Mn"]
        if unicodedata.combining(full[0]):
            combining.append(c)
        if unicodedata.combining(c) and unicodedata.category(c) != "Mn":
            marks[unicodedata.combining(c)] = marks.get(unicodedata.combining(c), "") + c
        elif cp in _HANGUL:
            continue
        elif len(kept) > 1 or any(unicodedata.combining(x) for x in kept):
            several[c] = full
        elif not kept:
            gone.append(c)
        elif kept[0] != c:
            one[c] = kept[0]
    long = [*several, *"".join(marks.values()), *map(chr, _HANGUL)]
    latin = min(map(ord, [*gone, *long]))
    return _Accents("".join(one), "".join(one.values()), "".join(gone), "".join(long), latin, several, marks, _ranges(combining))


def _decomposed(c: Column) -> Column:
    """NFD of one character of the long way; any other stays."""
    several = _accents().several
    place = F.ascii(c) - _HANGUL.start

    def jamo(first: int, n: int, at: Column) -> Column:
        return F.substr(F.lit("".join(chr(first + i) for i in range(n))), at + 1, F.lit(1))

    # fixed values: the Unicode standard's arithmetic of Hangul syllables
    syllable = F.concat(jamo(0x1100, 19, (place / 588).cast("int")), jamo(0x1161, 21, (place % 588 / 28).cast("int")),
                        F.when(place % 28 > 0, jamo(0x11A7, 28, place % 28)).otherwise(""))
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    return F.when((place >= 0) & (place < len(_HANGUL)), syllable).otherwise(F.coalesce(F.try_element_at(table, c), c))


def _ordered(text: Column) -> Column:
    """Runs of combining characters with those that are not Mn in order of combining class, the others
    (which go anyway) left out."""
    acc = _accents()
    held = "".join(acc.marks.values())

    def segment(s: Column) -> Column:
        marks = [F.regexp_replace(s, f"[^{m}]", "") for _, m in sorted(acc.marks.items())]
        return F.when(F.length(s) - F.length(F.translate(s, held, "")) > 1,
                      F.concat(F.regexp_replace(s, f"[{acc.combining}]", ""), *marks)).otherwise(s)

    parts = F.regexp_extract_all(text, F.lit(f"(?s)[^{acc.combining}]?[{acc.combining}]*"), F.lit(0))
    return F.when(F.length(text) - F.length(F.translate(text, held, "")) > 1,
                  F.array_join(F.transform(parts, segment), "")).otherwise(text)


def strip_accents(c: str | Column) -> Column:
    """Unicode NFD, then delete every code point of category Mn; stays decomposed; NULL passes.

    A deterministic expression of one ``translate`` over tables made from the Unicode data, so filters
    pass through it and it may stand in a join condition. ASCII text is returned as it is, and text of
    code points before the first combining one takes a table of these only: Spark compares the
    tables' texts again for every row. Only a text with a character that decomposes into several, a Hangul syllable or a combining character
    that is not Mn (NFD sorts adjacent ones by combining class) goes character by character.
    """
    col = _col(c).cast("string")
    acc = _accents()

    def long_way(text: Column) -> Column:
        full = F.array_join(F.transform(F.split(text, ""), _decomposed), "")
        return F.translate(once(full, _ordered), acc.one + acc.gone, acc.by)

    def chosen(plain: Column) -> Column:
        return F.when(F.contains(plain, F.lit(_MARKER)), long_way(col)).otherwise(plain)

    near = [c for c in acc.one if ord(c) < acc.latin]
    short = F.translate(col, "".join(near), acc.by[:len(near)])          # ``one`` is in code-point order
    return F.when(F.length(col) == F.octet_length(col), col).when(~col.rlike(f"[^\\x{{0}}-\\x{{{acc.latin - 1:x}}}]"), short).otherwise(
        once(F.translate(col, acc.one + acc.long + acc.gone, acc.by + _MARKER * len(acc.long)), chosen))


def py_strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading and trailing Python whitespace."""
    return F.btrim(_col(c).cast("string"), F.lit(PY_WHITESPACE))


def word_count(c: str | Column) -> Column:
    """``len(str.split())``: whitespace-separated tokens; '' -> 0, NULL -> NULL."""
    parts = F.split(F.translate(_col(c).cast("string"), PY_WHITESPACE, " " * len(PY_WHITESPACE)), " ")
    return F.array_size(F.array_remove(parts, ""))


def has_match(c: str | Column, pattern: str = UNICODE_DIGIT) -> Column:
    """1 when the pattern occurs in the text, else 0; NULL text gives 0."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False)).cast("int")
