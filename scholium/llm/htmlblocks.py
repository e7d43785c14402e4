"""HTML as a sequence of leaf blocks: a text between block boundaries, with the elements around it."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes svg math xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")  # not the end of an address without quotes
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Element:
    """An open element: its tag, its class, id and role, and the element around it. Paths share what they have in common, at any depth."""

    __slots__ = ("tag", "marks", "parent", "around", "key", "state")

    def __init__(self, tag: str, marks: str, parent: "Element | None") -> None:
        self.tag, self.marks, self.parent = tag, marks, parent
        #: Itself, or the next one outwards, that isn't a mere inline element.
        self.around: Element = self if parent is None or tag not in INLINE or marks else parent.around
        outer = parent.around if parent is not None else None
        #: Equal for equal paths.
        self.key = hash((outer.key if outer is not None else 0, tag, marks)) if self.around is self else self.around.key
        self.state = None  # what others remember of the path


@dataclass
class Block:
    text: str
    element: Element  # what it is in, inline elements without marks left out
    linked: int  # characters inside links


def blocks(page: str) -> list[Block]:
    """The blocks with a text, in page order."""
    root = Element("", "", None)
    stack: list[Element] = [root]
    opened: Counter = Counter()
    out: list[Block] = []
    parts: list[str] = []
    element: Element | None = None
    linked = links = 0

    def flush() -> None:
        nonlocal element, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, element or root, min(linked, len(text))))
            parts.clear()
        element, linked = None, 0

    def cut(i: int) -> None:
        opened.subtract(e.tag for e in stack[i:])
        del stack[i:]

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            text = html.unescape(text)
            if element is None and not text.isspace():
                element = stack[-1].around
            if links:
                linked += len(text.strip())
            parts.append(text)
            continue
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name not in INLINE:
                flush()
            if name == "a":
                links = 0
            for i in range(len(stack) - 1, 0, -1) if opened[name] else ():
                if stack[i].tag == name:
                    cut(i)
                    break
                if name in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            if name not in ("noscript", "svg", "math"):
                flush()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in ENDS_P:
            for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                if stack[i].tag == "p":
                    cut(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        if name in CLOSED_BY:
            for i in range(len(stack) - 1, 0, -1) if any(opened[x] for x in CLOSED_BY[name]) else ():
                if stack[i].tag in CLOSED_BY[name]:
                    cut(i)
                    break
                if stack[i].tag in SCOPES[name]:
                    break
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in VOID or name not in ENDS_P and CLOSED.search(attrs):
            continue
        marks = []
        for a in ATTRIBUTE.finditer(attrs):
            value = (a[2] or a[3] or a[4] or "").lower()
            kind = a[1].lower()
            if kind == "style":
                marks += ["hidden-element"] if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) else []
            elif kind == "hidden" or kind == "aria-hidden" and value == "true":
                marks.append("hidden-element")
            else:
                marks.append(f"role-{value}" if kind == "role" else value)
        if name == "a":
            links = 1
        stack.append(Element(name, " ".join(marks), stack[-1]))
        opened[name] += 1
    flush()
    return out
