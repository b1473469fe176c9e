"""Pages as trees of block elements and text blocks."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by what a page's text flow does with them.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html label legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp svg math".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEEPS_PARAGRAPH = frozenset("button label option optgroup select".split())
# An element of the first kind ends open ones of the second, up to one of the third.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
}
ENDS |= {n: (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), frozenset(["table"])) for n in ("tbody", "thead", "tfoot")}
WALLS = frozenset("td th caption button html".split())

TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:-->|--!>|\Z))"""
    r"""|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*+)>"""
    r"""|<(?P<start2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"""
    r"""|(?P<text>[^<]+|<)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass
class Page:
    """Nodes in page order. A node is a block element, or a text block (``text`` is not None)."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    attrs: list[str] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of a text block that stand in links

    def add(self, parent: int, tag: str, attrs: str, text: str | None, linked: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def attributes(attrs: str) -> dict[str, str]:
    """The first value of each attribute, by lower-case name."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(source: str) -> Page:
    """The tree of a page, however it is malformed.

    Block elements open and close text blocks; a line break is white space; other
    elements leave the text flow alone. Open paragraphs, list items and cells end where
    HTML lets their end tags be left out; end tags without a start are passed over; what
    is open at the end of the page ends there. Comments, scripts, styles and other raw
    elements have no text. An unknown element with a hyphen in its name is a block.
    """
    page = Page()
    stack: list[tuple[str, int]] = [("", page.add(-1, "page", "", None, 0))]
    run: list[str] = []
    links, linked = 0, 0
    in_head = False

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.add(stack[-1][1], "text", "", text, min(linked, len(text)))
            run.clear()
        linked = 0

    def close(names: frozenset[str], walls: frozenset[str]) -> None:
        """End the outermost open element of ``names`` above the innermost of ``walls``."""
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in walls:
                break
            if stack[i][0] in names:
                cut = i
        if cut is not None:
            flush()
            del stack[cut:]

    at, end = 0, len(source)
    token = TOKEN.match
    while at < end:
        found = token(source, at)
        at = found.end()
        kind = found.lastgroup
        if kind == "text":
            if not in_head:
                piece = found.group()
                if "&" in piece:
                    piece = html.unescape(piece)
                run.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        if kind in ("attrs", "attrs2", "start", "start2"):
            name = (found["start"] or found["start2"]).lower()
            attrs = found["attrs"] if found["start"] else found["attrs2"]
            if in_head and name not in HEAD_ONLY and name != "head":
                in_head = False
            if name in RAW:
                if not attrs.endswith("/") or name not in ("svg", "math"):
                    closing = RAW_END[name].search(source, at)
                    at = closing.end() if closing else end
            elif name == "br" or name == "hr":
                if name == "hr":
                    flush()
                run.append(" ")
            elif name == "a":
                links = 1
            elif name == "head":
                in_head = True
            elif name in ("html", "body") and any(n == name for n, _ in stack):
                pass
            elif name in BLOCKS or ("-" in name and name not in VOID):
                if name in ENDS:
                    close(*ENDS[name])
                if name in HEADINGS and stack[-1][0] in HEADINGS:
                    flush()
                    stack.pop()
                if name not in KEEPS_PARAGRAPH:
                    close(P, WALLS)
                flush()
                if not (attrs.endswith("/") and "-" in name):
                    stack.append((name, page.add(stack[-1][1], name, attrs.strip(), None, 0)))
        elif kind == "end":
            name = found["end"].lower()
            if name == "a":
                links = 0
            elif name == "head":
                in_head = False
            elif name not in ("html", "body") and (name in BLOCKS or "-" in name):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        flush()
                        del stack[i:]
                        break
                    if stack[i][0] in ("td", "th") and name not in ("tr", "table", "tbody", "thead", "tfoot"):
                        break
    flush()
    return page


P = frozenset(["p"])
