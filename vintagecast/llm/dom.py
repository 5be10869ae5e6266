"""A lenient reading of HTML into a flat element tree and its text.

Elements are numbered in page order.  Tags left open are closed where HTML
says so (a paragraph by any block, a list item by the next, a cell by the
next, ...); end tags that close nothing are passed over.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARK = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"']?+)|[\"'])*+)>|(?:[!?]|/(?=[^a-zA-Z]))[^>]*>)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noembed noframes xmp iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img picture".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: A start tag closes an open element of these names, up to the given borders.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "body": ({"head"}, set()),
}
P_BORDERS = frozenset("button td th caption table object template".split())


@dataclass
class Page:
    """Per element: parent, tag, words of class and role (a role's begin with @),
    its id, and whether its attributes hide it; ``text``: (element, decoded text) in page order;
    ``breaks``: places in ``text`` at which a block begins or ends."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    words: list[str] = field(default_factory=lambda: [""])
    ids: list[str] = field(default_factory=lambda: [""])
    hidden: list[bool] = field(default_factory=lambda: [False])
    lang: str = ""
    text: list[tuple[int, str]] = field(default_factory=list)
    breaks: set[int] = field(default_factory=set)


def _attributes(raw: str) -> tuple[str, str, bool, str]:
    words, own_id, hidden, lang = [], "", False, ""
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "class":
            words.append(value)
        elif name == "role":
            words += [f"@{w}" for w in value.split()]
        elif name == "id":
            own_id = value
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
        elif name == "lang":
            lang = value
    return " ".join(words), own_id, hidden, lang


class Open:
    """The open elements, from the page down, and where those of a name stand: what
    a tag closes is found without climbing, however deep a page is."""

    def __init__(self, tag_of: list[str]):
        self.tag_of, self.stack, self.places, self.solid = tag_of, [0], {}, []

    def push(self, element: int) -> None:
        tag = self.tag_of[element]
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.solid.append(len(self.stack))
        self.stack.append(element)

    def cut(self, place: int) -> None:
        """Closes the element at this place and all below it."""
        for element in self.stack[place:]:
            tag = self.tag_of[element]
            self.places[tag].pop()
            if tag not in INLINE:
                self.solid.pop()
        del self.stack[place:]

    def nearest(self, names) -> int:
        return max([self.places[x][-1] for x in names if self.places.get(x)], default=0)

    def shut(self, names, borders) -> None:
        """Closes the nearest open element of these names, if no border is nearer."""
        place = self.nearest(names)
        if place and place >= self.nearest(borders):
            self.cut(place)

    def end(self, tag: str) -> None:
        """An end tag; an inline one doesn't close beyond the block it stands in."""
        place = self.nearest((tag,))
        if place and not (tag in INLINE and self.solid and self.solid[-1] > place):
            self.cut(place)


def read_page(source: str) -> Page:
    page, at = Page(), 0
    parent, tag_of, words_of, ids_of, hidden_of, text, breaks = page.parent, page.tag, page.words, page.ids, page.hidden, page.text, page.breaks
    open_ = Open(tag_of)
    stack, last = open_.stack, source.rfind(">")

    def say(raw: str) -> None:
        if raw:
            text.append((stack[-1], html.unescape(raw) if "&" in raw else raw))

    n = len(source)
    while at < n:
        if at > last:  # no tag ends any more; a comment may be left open
            comment = source.find("<!--", at)
            say(source[at : comment if comment >= 0 else n])
            break
        m = _MARK.search(source, at)
        if m is None:
            say(source[at:])
            break
        say(source[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        inline = tag in INLINE
        if m["end"]:
            open_.end(tag)
            if not inline:
                breaks.add(len(text))
            continue
        if tag in CLOSES_P:
            open_.shut(("p",), P_BORDERS)
        if tag in CLOSED_BY:
            open_.shut(*CLOSED_BY[tag])
        if tag == "br":
            text.append((stack[-1], " "))
            continue
        words, own_id, hidden, lang = _attributes(m["attrs"]) if m["attrs"] else ("", "", False, "")
        if tag == "html" and lang:
            page.lang = lang
        if not inline:
            breaks.add(len(text))
        if tag in VOID:
            continue
        parent.append(stack[-1])
        tag_of.append(tag)
        words_of.append(words)
        ids_of.append(own_id)
        hidden_of.append(hidden)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*/?>", re.I).search(source, at)
            text.append((len(tag_of) - 1, source[at : end.start() if end else n]))
            at = end.end() if end else n
            breaks.add(len(text))
        elif not m["attrs"].rstrip().endswith("/") or inline or tag not in ("svg", "path"):
            open_.push(len(tag_of) - 1)
    return page


def blocks(page: Page, keep: list[bool]) -> list[str]:
    """Texts of the kept elements' blocks, white space made single blanks."""
    out, run = [], []
    for i, (element, raw) in enumerate(page.text):
        if i in page.breaks and run:
            out.append("".join(run))
            run = []
        if keep[element]:
            run.append(raw)
    out.append("".join(run))
    return [t for t in (" ".join(b.split()) for b in out) if t]
