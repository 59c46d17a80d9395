"""Chat formatting with a template taken as a black box.

Successive prefixes of the turns are rendered and consecutive outputs compared: what a turn adds is its span.
A template whose longer output does not begin with the shorter one rewrites history; its conversations are
flagged, and their spans are not used. Inside a turn's span its text is found in the form in which the
template writes it. The loss mask covers the texts of assistant turns.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
# A "<|" in a text gets a backslash in between, one more where there are some already, so that no text can
# hold a control string and every text can be read back.
_PLAIN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + "\n", re.S)

Template = Callable[[list[tuple[str, str]]], str]


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def turn_markers(turns: list[tuple[str, str]]) -> str:
    """The default template: every turn between its markers, control strings in texts escaped."""
    return "".join(f"{OPEN}{escape_role(role)}\n{escape(text)}{CLOSE}\n" for role, text in turns)


def locate(turns: list[tuple[str, str]], template: Template) -> tuple[str, list[tuple[int, int]], bool]:
    """The whole output, the span of every turn in it, and whether the template rewrites history."""
    before, spans, rewrites = template([]), [], False
    for k in range(1, len(turns) + 1):
        after = template(turns[:k])
        rewrites |= not after.startswith(before)
        spans.append((len(before), len(after)))
        before = after
    return before, spans, rewrites


def loss_spans(text: str, turns: list[tuple[str, str]], spans: list[tuple[int, int]], written=escape) -> list[tuple[int, int]]:
    """Where the assistant texts stand, as the template writes them; found from the end of the turn's span."""
    out = []
    for (role, said), (begin, end) in zip(turns, spans):
        if role == ASSISTANT:
            form = written(said)
            at = text.rfind(form, begin, end)
            if at < 0:
                raise ValueError("the template does not hold the text of a turn")
            out.append((at, at + len(form)))
    return out


def format_conversations(conversations: DataFrame, template: Template = turn_markers, written=escape) -> DataFrame:
    """One row per conversation: conv_id, formatted, turn_begins, turn_ends, loss_begins, loss_ends (in code
    points) and rewrites_history, in which case the spans are empty.

    * Turns stand in the order of turn (null first), role, text; repeated rows are turns like any other.
    * Null texts and roles count as empty. Rows with a null conv_id are one conversation.
    * A conversation is one training example and therefore one row; its turns meet in one task. Rendering all
      prefixes costs its length times its turns. Extra columns are not read; empty in, empty out.
    """
    turns = conversations.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")) \
        .select("conv_id", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))

    def run(batches):
        for batch in slices(batches):
            rows = []
            for roles, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                said = list(zip(roles, texts))
                text, spans, rewrites = locate(said, template)
                loss = [] if rewrites else loss_spans(text, said, spans, written)
                rows.append((text, [] if rewrites else spans, loss, rewrites))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r[0] for r in rows]),
                *(pa.array([[s[k] for s in r[which]] for r in rows], pa.list_(pa.int64())) for which in (1, 2) for k in (0, 1)),
                pa.array([r[3] for r in rows]),
            ], ["conv_id", "formatted", "turn_begins", "turn_ends", "loss_begins", "loss_ends", "rewrites_history"])

    return gathered.mapInArrow(run, "conv_id bigint, formatted string, turn_begins array<bigint>, turn_ends array<bigint>, "
                                    "loss_begins array<bigint>, loss_ends array<bigint>, rewrites_history boolean")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of an output of ``turn_markers``."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError("text between the turns")
        turns.append((unescape_role(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("text after the turns")
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """From written outputs of ``turn_markers``: conv_id, n_turns, said (role, line feed, text, line feed per turn),
    loss (all text under the mask, unescaped) and formatted_chars."""
    def run(batches):
        for batch in slices(batches):
            texts = batch.column("formatted").to_pylist()
            turns = [read_turns(t) for t in texts]
            loss = ["".join(unescape(t[a:b]) for a, b in zip(begins, ends)) for t, begins, ends in
                    zip(texts, batch.column("loss_begins").to_pylist(), batch.column("loss_ends").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id"), pa.array(np.array([len(t) for t in turns], np.int64)),
                pa.array(["".join(f"{role}\n{said}\n" for role, said in t) for t in turns], pa.string()),
                pa.array(loss, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64)),
            ], ["conv_id", "n_turns", "said", "loss", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_begins", "loss_ends").mapInArrow(
        run, "conv_id bigint, n_turns bigint, said string, loss string, formatted_chars bigint")


def chat_digests(back: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of ``read_back``."""
    return back.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
