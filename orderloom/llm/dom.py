"""Leaf blocks of a page: runs of text between block-level tags, with their ancestors.

Reading takes time linear in the page, damaged or not. Bounds that shape only what a block is
known by, never its text: of an element's names the first 12 count, of a path of ancestors the 8
outermost and 24 innermost, and elements deeper than 512 stand beside one another. Where more than
``BROKEN`` tags have quotes that leave them without an end, quotes in later tags are not honoured.
Character references are decoded in each run of text by itself, never across a tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

# Elements whose content is no text of the page.
HIDDEN = frozenset(
    "script style noscript template svg iframe object textarea select title button audio video canvas".split()
)
# Their content is no markup; it runs to the end tag or, without one, to the end of the page.
RAW = {t: re.compile(rf"(?i)</{t}(?=[\s/>])[^>]*+>") for t in ("script", "style", "textarea", "title")}
# Inside these "/>" closes an element, down to those that hold ordinary elements again.
FOREIGN = frozenset(["svg", "math"])
ORDINARY = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
# Ordinary elements that end an open svg or math.
LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# Ends implied by an opened element reach out of no open one of these.
SCOPES = frozenset("button iframe noscript object select template".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# An opened element closes the open ones on the right, as far up as the first of the last group.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
CELLS = frozenset(["table", "td", "th"])
# Elements nested deeper stand beside one another; of a long path both ends are kept.
DEEPEST = 512
OUTER, INNER = 8, 24

BROKEN = 16
_QUOTED = r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|"
_OTHERS = (
    r"<!--.*?(?:--!?>|\Z)|{}"
    r"<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|(?P<text>[^<]++|<)"
)
_TOKEN = re.compile(_OTHERS.format(_QUOTED), re.S | re.I)
_UNQUOTED = re.compile(_OTHERS.format(r"(?!)(?P<end>)(?P<tag>)(?P<attrs>)|"), re.S | re.I)
# Behind the last ">" there is no tag.
_REST = re.compile(r"<!--.*|(?P<text>(?:[^<]|<(?!!--))++)(?P<end>(?!))?(?P<tag>(?!))?(?P<tag2>(?!))?(?P<end2>(?!))?", re.S)
_ATTR = re.compile(r"(?i)\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    path: tuple  # of the ancestors: (tag, names from class, id, role and itemprop)


def names_of(attrs: str) -> tuple[str, ...]:
    """Lower-case words of the attributes that name an element's part in the page."""
    if not attrs or "=" not in attrs:
        return ()
    values = " ".join(a or b or c for _, a, b, c in _ATTR.findall(attrs))
    return tuple(dict.fromkeys(w.lower() for w in _WORD.findall(values)))[:12]


def _close(stack: list[tuple], tags: tuple[str, ...], until) -> None:
    """Close the outermost open element of ``tags`` inside the nearest one of ``until``."""
    cut = None
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in until or stack[i][0] in SCOPES:
            break
        if stack[i][0] in tags:
            cut = i
    if cut is not None:
        del stack[cut:]


def _foreign(stack: list[tuple]) -> int | None:
    """Place of the svg or math whose rules hold for the next element."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] in FOREIGN:
            return i
        if stack[i][0] in ORDINARY:
            return None
    return None


def _tokens(html: str, after: list[int]) -> Iterator[re.Match]:
    """Tokens in page order, the next one from the place in ``after`` if there is one."""
    at, last, broken = 0, html.rfind(">"), 0
    while at < len(html):
        pattern = _REST if at > last else _TOKEN if broken < BROKEN else _UNQUOTED
        m = pattern.match(html, at)
        broken += pattern is _TOKEN and m["tag2"] is not None
        at = m.end()
        yield m
        if after:
            at = after.pop()


def blocks_of(html: str | None) -> list[Block]:
    """Blocks in page order, none of them empty; missing end tags are implied.

    A hidden element without an end tag ends with the element around it.
    """
    html = html or ""
    stack: list[tuple] = []
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    path: tuple | None = None
    links = hidden = foreign = 0
    after: list[int] = []

    def flush() -> None:
        nonlocal linked, path
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, path or ()))
            parts.clear()
        linked, path = 0, None

    def recount() -> None:
        nonlocal links, hidden, foreign
        links = sum(s[0] == "a" for s in stack)
        if hidden:
            hidden = sum(s[0] in HIDDEN for s in stack)
        if foreign:
            foreign = sum(s[0] in FOREIGN for s in stack)

    for m in _tokens(html, after):
        text = m["text"]
        if text is not None:
            if hidden:
                continue
            parts.append(unescape(text))
            if path is None and not text.isspace():
                path = tuple(stack if len(stack) <= OUTER + INNER else stack[:OUTER] + stack[-INNER:])
            if links:
                linked += len(text)
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if tag == "br":
                if not hidden:
                    parts.append(" ")
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in CELLS and tag not in CELLS and tag not in ("tr", "tbody", "thead", "tfoot"):
                    break
            if tag == "a" or hidden or foreign:
                recount()
            if tag in BLOCK and not hidden:
                flush()
            continue
        inside = _foreign(stack) if foreign else None
        if inside is not None and tag in LEAVES:
            del stack[inside:]
            recount()
            inside = None
        if tag in VOID:
            if tag == "hr" and not hidden:
                flush()
            elif tag == "br" and not hidden:
                parts.append(" ")
            continue
        if tag in RAW and inside is None:
            end = RAW[tag].search(html, m.end())
            after.append(end.end() if end else len(html))
            continue
        if (inside is not None or tag in FOREIGN) and m[0].endswith("/>"):
            continue
        if tag in BLOCK:
            if tag in CLOSES:
                _close(stack, *CLOSES[tag])
            _close(stack, ("p",), ("table", "td", "th", "li", "dd", "blockquote", "div", "section", "article"))
            recount()
            if not hidden:
                flush()
        elif tag in ("button", "select"):
            # One of these holds no other of its kind.
            open_one = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in SCOPES), None)
            if open_one is not None and stack[open_one][0] == tag:
                del stack[open_one:]
                recount()
        if len(stack) == DEEPEST:
            if stack[-1][0] in HIDDEN:
                continue
            stack.pop()
            recount()
        stack.append((tag, names_of(m["attrs"] or m["attrs2"])))
        links += tag == "a"
        hidden += tag in HIDDEN
        foreign += tag in FOREIGN
    flush()
    return out
