"""Leaf blocks of HTML pages: the text between block-level tags, with the tags around it."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

# fixed values: names from the HTML standard
RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp"
HIDDEN = frozenset("head template svg math object canvas audio video select datalist button map".split())
SECTIONS = frozenset("html body article main section aside nav header footer form table div fieldset details dialog".split())
BLOCKS = SECTIONS | HIDDEN | frozenset(
    "address blockquote caption center dd dir dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li menu ol option "
    "p pre search summary tbody td tfoot th thead tr ul".split())
_VOID = frozenset(["hr"])
#: an opening tag that ends an open element of these names, up to the nearest of the others
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select", "datalist"})}

_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(rf"""<!--.*?(?:--!?>|\Z)|<({RAW})\b{_QUOTED}>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*+)({_QUOTED})>"""
                    rf"""|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

PATH_SLOTS, WORD_SLOTS = 512, 1024


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[tuple[str, frozenset], ...]          # (tag, words of class, id, role and itemprop) from the outside in
    linked: int                                      # characters inside links


_ATTRIBUTE_BOUND = 1 << 16
_named: dict[str, frozenset] = {}


def _names(attributes: str) -> frozenset:
    found = _named.get(attributes)
    if found is None:
        if len(_named) > _ATTRIBUTE_BOUND:
            _named.clear()
        values = (" ".join(m[1:]) for m in _ATTRIBUTE.findall(attributes))
        found = _named[attributes[:200]] = frozenset(w.lower() for v in values for w in _WORD.findall(v))
    return found


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page, in order. Comments, scripts, styles, titles and hidden elements have none;
    character references are decoded, white space runs become one space, and blocks are trimmed."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []
    parts: list[str] = []
    at = links = linked = 0
    page = page or ""

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not any(tag in HIDDEN for tag, _ in stack):
                out.append(Block(text, tuple(stack), linked))
            parts.clear()
        linked = 0

    def end(name: str) -> None:
        section = name in SECTIONS
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                del stack[k:]
                return
            if not section and stack[k][0] in SECTIONS:
                return

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at: m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        name, ends, rest = name.lower(), m[2] or m[5], m[4] or m[7] or ""
        if name == "a":
            links = max(0, links - 1) if ends else links + 1
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            close()
            if ends:
                end(name)
                continue
            if stack and stack[-1][0] == "p":
                stack.pop()
            if name in _ENDS:
                same, until = _ENDS[name]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in until:
                        break
                    if stack[k][0] in same:
                        del stack[k:]
            if name not in _VOID:
                stack.append((name, _names(rest) if "=" in rest else frozenset()))
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


class Slots(dict):
    """Token -> slot of a hashed vector, remembered up to a bound."""

    BOUND = 1 << 18

    def __init__(self, first: int, slots: int):
        super().__init__()
        self.first, self.slots = first, slots

    def __missing__(self, token: str) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        slot = self.first + zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.slots
        if len(token) <= 64:
            self[token] = slot
        return slot


def path_tokens(path: tuple[tuple[str, frozenset], ...]) -> list[str]:
    """Tokens of the tags around a block: every tag and name, and once more those of the innermost one."""
    out = []
    for tag, names in path:
        out.append(f"<{tag}")
        out.extend(names)
    if path:
        out.append(f"<{path[-1][0]}>")
        out.extend(f"{w}>" for w in path[-1][1])
    return out
