"""The structure of Markdown as rows: headings, list items with their depth, links and images.

Lines are read once, with a stack of the lists and quotations that are open; every line of a page that
``markup.lay_out`` wrote carries the indents of all of them.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OPENER = re.compile(r"(> ?)|(?:[-*+]|(\d{1,9})\.) ")
_HEADING = re.compile(r"(#{1,6}) +(.*)")
_LINK = re.compile(r"(!?)\[((?:\\.|[^\[\]\\])*)\]\(((?:[^()]|\([^()]*\))*)\)|<([a-zA-Z][a-zA-Z0-9+.-]*:[^<>\s]+)>")
_MARKS = re.compile(r"(?<!\\)(?:\*+|~~|`)")
_CODE = re.compile(r"`[^`]*`")
_FENCE = "```"

MARKS = "url string, place int, place_of_kind int, kind string, level int, number int, text string, target string"


def _plain(text: str) -> str:
    """Text without its marks; links count with their words."""
    text = _LINK.sub(lambda m: m[2] or m[4] or "", text)
    return _MARKS.sub("", text).replace(r"\*", "*").replace(r"\_", "_").strip()


def marks(body: str) -> list[tuple]:
    """(kind, level, number, text, target) in the order of the page.

    ``heading`` has its level from 1 to 6, ``item`` its depth from 1 and the number where it is counted, ``link`` and
    ``image`` the depth of the list around them (0 outside) and their target. Lines of fenced code hold no marks.
    """
    found, widths, fenced = [], [], False  # a width per open list item, None for a quotation
    for line in body.split("\n"):
        at, kept = 0, 0
        for width in widths:
            if width is None:
                if not line.startswith(">", at):
                    break
                at += 2 if line.startswith("> ", at) else 1
            elif line[at:at + width].strip():
                break
            else:
                at += width
            kept += 1
        rest = line[at:]
        if fenced or not rest.strip():
            fenced = fenced and rest.strip() != _FENCE
            continue
        del widths[kept:]
        item = None
        while opener := _OPENER.match(rest):
            rest = rest[opener.end():]
            widths.append(None if opener[1] else opener.end())
            if not opener[1]:
                item = len(found)
                depth = sum(w is not None for w in widths)
                found.append(("item", depth, int(opener[2]) if opener[2] else None, "", None))
        if rest.strip() == _FENCE:
            fenced = True
            continue
        heading = _HEADING.fullmatch(rest)
        if item is not None:
            found[item] = (*found[item][:3], _plain(rest), None)
        if heading:
            found.append(("heading", len(heading[1]), None, _plain(heading[2]), None))
        depth = sum(w is not None for w in widths)
        for link in _LINK.finditer(_CODE.sub("", rest)):
            found.append(("image" if link[1] else "link", depth, None, _plain(link[2] or ""), link[4] or link[3]))
    return found


def _read_marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for url, body in zip(batch["url"], batch["body"]):
            seen = Counter()
            for place, mark in enumerate(marks(body), 1):
                seen[mark[0]] += 1
                rows.append((url, place, seen[mark[0]], *mark))
        found = pd.DataFrame(rows, columns=["url", "place", "place_of_kind", "kind", "level", "number", "text", "target"])
        yield found.astype({"number": "Int32"})


def markdown_marks(parsed: DataFrame) -> DataFrame:
    """One row per mark of every page of ``parse_pages``; place counts a page's marks from 1, place_of_kind those of one kind.

    Pages with an error and pages without text have no rows; the header that ``parse_pages`` puts before a page is not read.
    """
    body = F.regexp_extract("content", r"(?s)^.*?\n---\n\n(.*)$", 1)
    return parsed.where("status = 'success'").select("url", body.alias("body")).mapInPandas(_read_marks, MARKS)
