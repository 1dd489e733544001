"""HTML as browsers read it, for use within a task: one pass over the text, elements as ranges.

A page becomes a list of elements in document order and a list of its pieces of
text. Each element knows which stretch of either is its own, so that its text and
what lies below it are slices, and nothing here walks a tree or calls itself. Time
is in proportion to the page, however deep or broken it is; no page is an error.

Tokens, implied end tags and scopes follow the HTML standard. Head and body are
there whether they are written or not. What is not followed: formatting elements
are not taken up again behind a block that they overlap, stray text in tables stays
where it stands, and scripts are not run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Classes of elements in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("title textarea".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p plaintext pre listing search section summary table ul xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("applet caption html marquee object table td template th".split())
SPECIAL = SCOPE | CLOSES_P | HEAD | VOID | frozenset("body button colgroup frame frameset head iframe keygen optgroup option select tbody textarea tfoot thead tr".split()) - {"dialog", "wbr"}
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
SKIPPED = frozenset("script style noscript svg template".split())
#: What an open element of a table, up to the nearest table, is closed by.
TABLE = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), **dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup"), ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"))}

_NAME = re.compile(r"[^\t\n\f\r />]+")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|((?!["'])[^\s>]+)|(?=>)))?""")
_QUOTE = re.compile(r"\s*=\s*[\"']")
_TAG_END = re.compile(r"[\s/]*>")
_REFERENCE = re.compile(r"&#?[a-zA-Z0-9]+;|&#?[a-zA-Z0-9]+(?![=a-zA-Z0-9])")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Element:
    tag: str
    attrs: dict[str, str]
    at: int  # its own place among the elements
    first: int  # its first piece of text
    end: int = 0  # behind the last element below it
    last: int = 0  # behind its last piece of text


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    data: list[str] = field(default_factory=list)  # of scripts of structured data

    def all(self, *tags: str, within: Element | None = None) -> list[Element]:
        low, high = (0, len(self.elements)) if within is None else (within.at + 1, within.end)
        return [x for x in self.elements[low:high] if x.tag in tags]

    def first(self, *tags: str, within: Element | None = None, having: str | None = None) -> Element | None:
        low, high = (0, len(self.elements)) if within is None else (within.at + 1, within.end)
        return next((x for x in (self.elements[k] for k in range(low, high)) if x.tag in tags and (having is None or having in x.attrs)), None)

    def text(self, element: Element, by: str = "") -> str:
        return by.join(self.pieces[element.first : element.last])


def _attributes(html: str, at: int) -> tuple[dict[str, str], int, bool]:
    """(attributes, the place behind the tag or -1 where it never ends, whether it closes itself)."""
    found: dict[str, str] = {}
    while True:
        end = _TAG_END.match(html, at)
        if end:
            return found, end.end(), "/" in end[0]
        m = _ATTRIBUTE.match(html, at)
        if not m or m.end() >= len(html):
            return found, -1, False
        rest = html[m.end() : m.end() + 1]
        if m[2] is None and m[3] is None and m[4] is None and (rest == "=" or rest in "\t\n\f\r ") and _QUOTE.match(html, m.end()):
            return found, -1, False  # a quote that nothing closes
        value = next((x for x in m.groups()[1:] if x is not None), "")
        found.setdefault(m[1].lower(), _REFERENCE.sub(lambda r: unescape(r[0]), value) if "&" in value else value)
        at = m.end()


def _raw_end(html: str, at: int, tag: str) -> tuple[int, int]:
    """Where the text of a raw element ends, and the place behind its end tag."""
    m = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
    if not m:
        return len(html), len(html)
    behind = _attributes(html, m.end())[1]
    return m.start(), len(html) if behind < 0 else behind


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        self.open: list[Element] = []
        self.depths: dict[str, list[int]] = {}  # of open elements, by tag
        self.special: list[int] = []  # depths of open special elements
        self.hard: list[int] = []  # and of those that end a list item's reach
        self.in_body = False
        self.skipping, self.skipped = "", 0
        self.push("html", {})

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        x = Element(tag, attrs, len(self.page.elements), len(self.page.pieces))
        self.page.elements.append(x)
        depth = len(self.open)
        self.depths.setdefault(tag, []).append(depth)
        if tag in SPECIAL:
            self.special.append(depth)
            if tag not in ("address", "div", "p", "li", "dd", "dt"):
                self.hard.append(depth)
        self.open.append(x)

    def pop(self) -> None:
        x = self.open.pop()
        depth = len(self.open)
        self.depths[x.tag].pop()
        for kept in (self.special, self.hard):
            if kept and kept[-1] == depth:
                kept.pop()
        x.end, x.last = len(self.page.elements), len(self.page.pieces)

    def pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.pop()

    def depth(self, *tags: str) -> int:
        """The depth of the innermost open element of these tags; -1 if none is."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=-1)

    def in_scope(self, tag: str, *more: str) -> int:
        """The depth of an open element that nothing shuts off; 0 if there is none."""
        at = self.depth(tag)
        return at if at > self.depth(*(SCOPE - {tag}), *more) else 0

    def body(self, attrs: dict[str, str] | None = None) -> None:
        if not self.in_body:
            self.pop_to(1)
            self.push("body", attrs or {})
            self.in_body = True

    def text(self, data: str) -> None:
        shown = data.strip()
        if self.skipping or not shown:
            return
        if not self.in_body and not self.depths.get("title"):
            self.body()
        self.page.pieces.append(shown)

    def close_p(self) -> None:
        if at := self.in_scope("p", "button"):
            self.pop_to(at)

    def start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        if self.skipping:
            if not (self.skipping == "svg" and tag in BREAKS_OUT):
                self.skipped += tag == self.skipping and not closed
                return
            self.skipping = ""
        if tag in ("html", "head"):
            return
        if tag == "body":
            self.body(attrs)
            return
        if tag in SKIPPED:
            if tag not in RAW and not (tag == "svg" and closed):
                self.skipping, self.skipped = tag, 1
            return
        if not self.in_body and tag not in HEAD:
            self.body()
        if tag in CLOSES_P:
            if tag == "li" and (at := self.depth("li")) > (self.hard[-1] if self.hard else -1):
                self.pop_to(at)
            if tag in ("dd", "dt") and (at := self.depth("dd", "dt")) > (self.hard[-1] if self.hard else -1):
                self.pop_to(at)
            self.close_p()
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop()
        if tag in ("option", "optgroup") and self.open[-1].tag == "option":
            self.pop()
        if tag == "optgroup" and self.open[-1].tag == "optgroup":
            self.pop()
        if tag in ("a", "nobr", "button") and (at := self.in_scope(tag)) and (tag == "button" or at > (self.special[-1] if self.special else -1)):
            self.pop_to(at)
        if tag in TABLE:
            shut = self.depth("table", "template", "html")
            outer = [self.depths[t][-1] for t in TABLE[tag] if self.depths.get(t) and self.depths[t][-1] > shut]
            if outer:  # at most one of a kind is open within a table
                self.pop_to(min(outer))
        self.push(tag, attrs)
        if tag in VOID:
            self.pop()

    def finish(self, tag: str) -> None:
        if self.skipping:
            if tag == self.skipping:
                self.skipped -= 1
                if not self.skipped:
                    self.skipping = ""
            return
        if tag in ("html", "head", "body") or not self.depths.get(tag) and tag not in HEADINGS:
            return
        if tag in HEADINGS:
            at = max(self.in_scope(h) for h in HEADINGS)
        elif tag == "p":
            at = self.in_scope("p", "button")
        elif tag == "li":
            at = self.in_scope("li", "ol", "ul")
        elif tag in SPECIAL:
            at = self.in_scope(tag) if tag not in SCOPE | TABLE.keys() else self.depth(tag) if self.depth(tag) > self.depth(*({"table", "template", "html"} - {tag})) else 0
        else:
            at = self.depth(tag)
            at = at if at > (self.special[-1] if self.special else -1) else 0
        if at > 0:
            self.pop_to(at)


def read(html: str) -> Page:
    """The elements and texts of a page, without what no reader sees."""
    b = _Builder()
    at, size = 0, len(html)
    while at < size:
        tag = html.find("<", at)
        while tag >= 0 and not (html[tag + 1 : tag + 2] in ("/", "!", "?") or html[tag + 1 : tag + 2].isalpha() and html[tag + 1 : tag + 2].isascii()):
            tag = html.find("<", tag + 1)
        upto = size if tag < 0 else tag
        if upto > at:
            text = html[at:upto]
            b.text(unescape(text) if "&" in text else text)
        if tag < 0:
            break
        ahead = html[tag + 1]
        if html.startswith("<!--", tag):
            if html.startswith((">", "->"), tag + 4):
                end = html.find(">", tag + 4) + 1
            else:
                m = re.compile("--!?>").search(html, tag + 4)
                end = m.end() if m else size
            at = end
        elif ahead in "!?" or ahead == "/" and not (html[tag + 2 : tag + 3].isalpha() and html[tag + 2 : tag + 3].isascii()):
            end = html.find(">", tag + 1)
            at = size if end < 0 else end + 1
        elif ahead == "/":
            name = _NAME.match(html, tag + 2)
            at = _attributes(html, name.end())[1]
            if at < 0:
                break
            b.finish(name[0].lower())
        else:
            name = _NAME.match(html, tag + 1)
            attrs, at, closed = _attributes(html, name.end())
            if at < 0:
                break
            kind = name[0].lower()
            if kind == "plaintext":
                b.start(kind, attrs, closed)
                b.text(html[at:])
                break
            b.start(kind, attrs, closed)
            if kind in RAW or kind in ESCAPABLE:
                end, behind = _raw_end(html, at, kind)
                content = html[at:end]
                if kind == "script" and attrs.get("type") == "application/ld+json":
                    b.page.data.append(content.strip())
                if kind not in SKIPPED and not b.skipping:
                    b.text(unescape(content) if kind in ESCAPABLE else content)
                    b.finish(kind)
                at = behind
    b.body()
    b.pop_to(0)
    return b.page


def collapsed(text: str) -> str:
    return _SPACE.sub(" ", text)
