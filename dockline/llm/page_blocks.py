"""The text blocks of a web page, in page order, each with the elements around it.

One pass over the page; the work is linear in its length whatever its nesting.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from zlib import crc32

PATH_TERMS = 1024
# --- fixed values: elements of HTML ---------------------------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
NO_BREAK = INLINE | RAW | {"br", "wbr", "img"}
# An element of these kinds ends an open one of the kinds beside it, up to the next element that holds both.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "body": {"head"}}
HOLDS = {"ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "select", "html"}
# --------------------------------------------------------------------------
OPENING = re.compile(r"<(?:!--|/?[a-zA-Z]|[!?])")
TAG = re.compile(r"""<(?P<end>/)?+(?P<name>[a-zA-Z!?][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
BLUNT_TAG = re.compile(r"<(?P<end>/)?+(?P<name>[a-zA-Z!?][^\s/>]*+)(?P<rest>[^>]*+)>")  # quotes mean nothing
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def path_term(kind: str, word: str) -> int:
    """The number of a tag name (kind t) or a word of class, id or role (kind c)."""
    return crc32(f"{kind}:{word}".encode()) % PATH_TERMS


def own_terms(name: str, attributes: str) -> list[str]:
    """The tag name and the words of class, id and role."""
    words = [f"t:{name}"]
    if attributes:
        for _, *value in NAMED.findall(attributes):
            words += [f"c:{w.lower()}" for w in PART.findall("".join(value))]
    return words


@dataclass
class Page:
    """Elements (parent, own terms) in the order of their start, and blocks (element, text, characters in links)."""

    parents: list[int] = field(default_factory=list)
    terms: list[list[str]] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, element: int) -> list[list[str]]:
        out = []
        while element >= 0:
            out.append(self.terms[element])
            element = self.parents[element]
        return out[::-1]


class _Reader:
    def __init__(self):
        self.page, self.names, self.ids = Page(), [], []
        self.open: dict[str, int] = {}
        self.text: list[str] = []
        self.at, self.linked, self.links = -1, 0, 0

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.page.blocks.append((self.at, text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def say(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        if text.strip():
            if not self.text:
                self.at = self.ids[-1] if self.ids else -1
            if self.links:
                self.linked += len(text)
        if self.text or text.strip():
            self.text.append(text)

    def pop(self, size: int) -> None:
        while len(self.names) > size:
            name = self.names.pop()
            self.ids.pop()
            self.open[name] -= 1
            self.links -= name == "a"

    def start(self, name: str, rest: str) -> None:
        if name not in NO_BREAK:
            self.flush()
            if self.open.get("p") and name not in HOLDS - {"table", "ul", "ol", "dl"}:
                at = len(self.names) - 1
                while at >= 0 and self.names[at] in INLINE:
                    at -= 1
                if at >= 0 and self.names[at] == "p":
                    self.pop(at)
            if name in ENDS and any(self.open.get(n) for n in ENDS[name]):
                at, found = len(self.names) - 1, None
                while at >= 0 and self.names[at] not in HOLDS:
                    if self.names[at] in ENDS[name]:
                        found = at
                        break
                    at -= 1
                if found is not None:
                    self.pop(found)
        elif name == "br" and self.text:
            self.text.append(" ")
        if name in VOID or rest.endswith("/") and name not in INLINE and name not in RAW and name != "p" and name != "div":
            return
        self.page.parents.append(self.ids[-1] if self.ids else -1)
        self.page.terms.append(own_terms(name, rest))
        self.names.append(name)
        self.ids.append(len(self.page.parents) - 1)
        self.open[name] = self.open.get(name, 0) + 1
        self.links += name == "a"

    def end(self, name: str) -> None:
        if name not in NO_BREAK:
            self.flush()
        if not self.open.get(name):
            return
        at = len(self.names) - 1
        if name in INLINE:  # a stray end of an inline element must not end the block around it
            while at >= 0 and self.names[at] in INLINE and self.names[at] != name:
                at -= 1
            if at < 0 or self.names[at] != name:
                return
        else:
            while self.names[at] != name:
                at -= 1
        self.pop(at)


def read_page(html: str | None) -> Page:
    """Blocks of a page: character references decoded, white space folded, no markup, scripts, styles or comments.

    A line break inside a block is white space. Null and empty pages have no block. Broken markup is read on: an
    unclosed tag, comment or script reaches to the end of the page; once a quote in a tag is never closed, quotes
    mean nothing in the rest of the page.
    """
    html, reader, at, tag = html or "", _Reader(), 0, TAG
    lower = None
    while at < len(html):
        opening = OPENING.search(html, at)
        if opening is None:
            reader.say(html[at:])
            break
        if opening.start() > at:
            reader.say(html[at:opening.start()])
        at = opening.start()
        if opening[0] == "<!--":
            close = html.find("-->", at + 4)
            at = len(html) if close < 0 else close + 3
            continue
        found = tag.match(html, at)
        if found is None:
            tag = BLUNT_TAG
            found = tag.match(html, at)
        if found is None:
            break
        at, name = found.end(), found["name"].lower()
        if name[0] in "!?":
            continue
        if found["end"]:
            reader.end(name)
            continue
        reader.start(name, found["rest"])
        if name in RAW:
            if lower is None:
                lower = html.lower()
                if len(lower) != len(html):  # a letter whose lower case is longer
                    lower = "".join(c.lower() if c < "\x80" else c for c in html)
            close = lower.find(f"</{name}", at)
            at = len(html) if close < 0 else close
    reader.flush()
    return reader.page
