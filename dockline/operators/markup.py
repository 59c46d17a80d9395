"""One page of HTML to text parts: the only per-row Python of the library outside the training-data part.

The page is converted while it is read, into one flat list: a start tag notes where its part begins, an end tag
writes its marks around it. Nothing is copied from element to element, so the work is linear in the page however
deep it nests, and depth is bounded by the page and not by the interpreter's stack.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

# --- fixed values ---------------------------------------------------------
DROPPED = {"script", "style", "nav", "footer", "header"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HEADINGS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
WRAPPED = {"b": "**", "strong": "**", "em": "*", "i": "*", "code": "`", "kbd": "`", "samp": "`", "del": "~~", "s": "~~"}
BLOCKS = {"p", "div", "article", "section", "main", "table", "dl", "ul", "ol"}
LISTS = {"ul", "ol"}
ENDS_PARAGRAPH = BLOCKS | set(HEADINGS) | {"li", "blockquote", "pre", "hr"}
HOLDS_PARAGRAPHS = (BLOCKS - {"p"}) | {"li", "blockquote", "td", "th"}
BULLET = "- "
NO_TITLE = "Untitled"
# --------------------------------------------------------------------------

LINE, PARAGRAPH, CODE = object(), object(), object()  # a line's end, an empty line, the end of a line of code
_BLANKS = re.compile(r"\s+")


class _Open:
    """An element whose end has not been read; the slots say where its part of the page's lists begins."""

    __slots__ = ("tag", "attrs", "dropped", "literal", "at", "words", "links", "items", "number", "one_line", "head")

    def __init__(self, tag, attrs, parent, at, words, links):
        self.tag, self.attrs, self.at, self.words, self.links = tag, attrs, at, words, links
        self.dropped = parent is not None and parent.dropped
        self.literal = tag in ("pre", "code") or (parent is not None and parent.literal)
        self.items, self.number, self.head = 0, 0, False
        self.one_line = tag in HEADINGS or tag in ("td", "th") or (parent is not None and parent.one_line)


class PageReader(HTMLParser):
    """``out`` holds texts, line marks, and (prefix, first, rest) tuples or None where an indent starts or ends."""

    def __init__(self, url: str, dropped: set[str]):
        super().__init__(convert_charrefs=True)
        self.url, self.dropped = url, dropped
        self.out, self.words, self.links, self.found = [], [], [], {}
        self.open = [_Open("", {}, None, 0, 0, 0)]
        self.open_tags = Counter()

    def updatepos(self, i, j):
        """Line numbers are not needed; counting them costs a tenth of the time."""
        return j

    def _imply_end(self, tag, inside):
        """Ends an open ``tag`` that the element now starting can't stand in, unless one of ``inside`` is nearer."""
        if self.open_tags[tag]:
            for element in reversed(self.open):
                if element.tag in inside:
                    return
                if element.tag == tag:
                    self.handle_endtag(tag)
                    return

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            self._imply_end("li", LISTS)
        if tag in ENDS_PARAGRAPH:
            self._imply_end("p", HOLDS_PARAGRAPHS)
        parent = self.open[-1]
        element = _Open(tag, {k: v or "" for k, v in attrs}, parent, len(self.out), len(self.words), len(self.links))
        element.dropped |= tag in self.dropped
        if tag == "li":
            parent.items += 1
            element.number = parent.items if parent.tag == "ol" else 0
        self.open.append(element)
        self.open_tags[tag] += 1
        if element.dropped:
            pass
        elif tag == "a" and "href" in element.attrs:
            self.links.append(urljoin(self.url, element.attrs["href"]))
        self.out.append("")  # the place of the opening mark
        if tag in VOID:
            self._finish()

    def handle_endtag(self, tag):
        if self.open_tags[tag]:
            while self.open[-1].tag != tag:
                self._finish()
            self._finish()

    def handle_data(self, data):
        element = self.open[-1]
        if element.dropped:
            return
        if data.strip():
            self.words.append(data.strip())
        if element.literal:
            first, *rest = data.split("\n")
            self.out.append(first)
            for line in rest:
                self.out += [CODE, line]
        else:
            self.out.append(_BLANKS.sub(" ", data).replace("*", r"\*").replace("_", r"\_"))

    def finish(self) -> None:
        self.close()
        while len(self.open) > 1:
            self._finish()

    def _finish(self):
        """Closes the innermost element: its marks go to the place of its start and to the end of the list."""
        element, out = self.open.pop(), self.out
        self.open_tags[element.tag] -= 1
        tag, attrs, at = element.tag, element.attrs, element.at
        empty = len(self.words) == element.words
        if element.dropped or (tag == "p" and empty):
            del out[at:], self.words[element.words:]
            if element.dropped or tag == "p":
                del self.links[element.links:]
            return
        if tag == "title" and "title" not in self.found:
            self.found["title"] = "".join(self.words[element.words:])
        elif tag in ("h1", "h2") and "main_heading" not in self.found:
            self.found["main_heading"] = "".join(self.words[element.words:])
        elif tag == "meta" and attrs.get("name") == "description":
            self.found.setdefault("description", attrs.get("content", ""))
        elif tag in ("main", "body"):
            self.found.setdefault(tag, (at, len(out) + 1))
        if tag == "th" and len(self.open) > 1:
            self.open[-1].head = True
        one_line = self.open[-1].one_line
        if tag in HEADINGS and not empty:
            self._wrap(at, PARAGRAPH, "#" * HEADINGS[tag] + " ", PARAGRAPH)
        elif tag in WRAPPED and not empty and not (element.literal and self.open[-1].literal):
            self._mark(at, WRAPPED[tag], WRAPPED[tag])
        elif tag == "a" and attrs.get("href") and not empty:
            plain = len(self.words) == element.words + 1 and self.words[-1] == attrs["href"]
            self._mark(at, "<" if plain else "[", ">" if plain else f"]({attrs['href']})", attrs["href"] if plain else None)
        elif tag == "img":
            out.append(f"![{attrs.get('alt', '')}]({attrs.get('src', '')})")
        elif tag == "br":
            out.append(" " if one_line else "  ")
            if not one_line:
                out.append(LINE)
        elif tag == "hr":
            out += [PARAGRAPH, "---", PARAGRAPH]
        elif tag == "pre":
            out[at] = [PARAGRAPH, "```", LINE]
            out += [LINE, "```", PARAGRAPH]
        elif tag == "blockquote":
            out[at] = [PARAGRAPH, ("> ", "> ")]
            out += [None, PARAGRAPH]
        elif tag == "li":
            mark = f"{element.number}. " if element.number else BULLET
            out[at] = [LINE, (mark, " " * len(mark))]
            out += [None, LINE]
        elif tag in ("td", "th"):
            out[at] = " "
            out.append(" |")
            self.open[-1].items += 1
        elif tag == "tr":
            out[at] = [LINE, "|"]
            out.append(LINE)
            if element.head:
                out += ["|" + " --- |" * element.items, LINE]
        elif tag in BLOCKS and not one_line:
            out[at] = PARAGRAPH
            out.append(PARAGRAPH)
        elif tag in BLOCKS:
            out[at] = " "

    def _wrap(self, at, before, mark, after):
        self.out[at] = [before, mark]
        self.out.append(after)

    def _mark(self, at, before, after, text=None):
        """Marks stand next to the first and the last letter, blanks outside of them."""
        out = self.out
        first = next((i for i in range(at + 1, len(out)) if isinstance(out[i], str) and out[i].strip()), None)
        if first is None:
            return
        last = next(i for i in range(len(out) - 1, at, -1) if isinstance(out[i], str) and out[i].strip())
        if text is not None:
            del out[first + 1:last]
            lead, last = out[first][: len(out[first]) - len(out[first].lstrip())], first
            out[first] = f"{lead}{before}{text}{after}"
            return
        lead = len(out[first]) - len(out[first].lstrip())
        out[first] = out[first][:lead] + before + out[first][lead:]
        tail = len(out[last].rstrip())
        out[last] = out[last][:tail] + after + out[last][tail:]


def _flat(parts):
    for part in parts:
        if isinstance(part, list):
            yield from part
        else:
            yield part


def lay_out(parts) -> str:
    """Lines from texts and marks: one pass, empty lines never doubled, indents in front of every line."""
    lines, line, indents, fresh, gap, fenced = [], [], [], [], False, [False]

    def end(code=False):
        nonlocal line, gap
        text = "".join(line)
        line = []
        if not text.strip() and not code:
            return
        prefix = "".join(f if new else r for (f, r), new in zip(indents, fresh))
        if gap and lines:
            lines.append("".join(r for _, r in indents).rstrip() if any(r.strip() for _, r in indents) else "")
        fresh[:] = [False] * len(fresh)
        lines.append(prefix + (text if code or fenced[0] else text.lstrip()))
        if text == "```":
            fenced[0] = not fenced[0]
        gap = False

    for part in _flat(parts):
        if part is LINE or part is CODE:
            end(part is CODE)
        elif part is PARAGRAPH:
            end()
            gap = True
        elif part is None:
            end()
            indents.pop()
            fresh.pop()
        elif isinstance(part, tuple):
            end()
            indents.append(part)
            fresh.append(True)
        else:
            line.append(part)
    end()
    return "\n".join(lines).strip()


def read_page(url: str, html: str, clean: bool = True) -> dict:
    """Metadata, Markdown body and absolute links of one page, cleaned first unless told not to."""
    reader = PageReader(url, DROPPED if clean else set())
    reader.feed(html)
    reader.finish()
    found = reader.found
    begin, end = found.get("main", found.get("body", (0, len(reader.out))))
    return {
        "title": found.get("title", NO_TITLE),
        "description": found.get("description", ""),
        "main_heading": found.get("main_heading", ""),
        "body": lay_out(reader.out[begin:end]),
        "links": list(dict.fromkeys(reader.links)),
    }
