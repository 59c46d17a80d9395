"""Byte-level BPE ids of whole texts, by way of the parts between spaces.

The split pattern of these tokenizers starts a new piece at every space that stands before a visible
character, so the parts between such spaces are split on their own, and equal parts only once. Their pieces go
to the library's model, equal ones once as well. Arrow cuts a batch of texts and numbers its distinct parts, so
that Python sees a part once a batch, however often it stands there; the numbers put the ids together.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from dockline.llm.transducer import byte_signs

UNSAFE = re.compile(r" [\s\x1c-\x1f\x85]")
# The same, or a space at the end of a text, for Arrow.
LOOSE = " (?:[" + "".join(filter(str.isspace, map(chr, range(0x3001)))) + "]|\\z)"
# The split pattern of byte-level BPE, white space spelled out by its Unicode property.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


STOPS = frozenset(".,;:!?")  # none of them begins a piece that letters end
LATIN_END = "\u0250"         # letters below are letters in every version of Unicode


class _Memo(dict):
    """Values in two generations: when the young one is full it becomes the old one, and what is used again
    comes back from there."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class PartEncoder:
    """Texts to ids, exactly as the library's ``encode(text, add_special_tokens=False)``.

    ``most`` bounds each of the two generations of parts, and of pieces, that are kept. Tokenizers of another
    kind than byte-level BPE without normaliser, and texts with special strings, go to the library whole.
    """

    def __init__(self, content: bytes, most: int = 300_000):
        plan = json.loads(content)
        self.tokenizer = Tokenizer.from_buffer(content)
        pre = plan.get("pre_tokenizer") or {}
        self.by_part = (plan.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space"))
        self.special = [t["content"] for t in plan.get("added_tokens", [])]
        self.size = self.tokenizer.get_vocab_size()
        signs = {chr(byte): sign for sign, byte in byte_signs().items()}
        tokenize, spelled = self.tokenizer.model.tokenize, str.maketrans(signs)

        def piece(text: str) -> bytes:
            plain = text.isascii() and text.isprintable()  # of these, the space alone is spelled by another sign
            spelling = text.replace(" ", signs[" "]) if plain else text.encode().decode("latin-1").translate(spelled)
            return array("I", [t.id for t in tokenize(spelling)]).tobytes()

        self.pieces = _Memo(piece, most)
        get = self.pieces.__getitem__

        def maker(lead: str, again: _Memo):
            """Ids of ``lead`` and a part. Latin letters are one piece; a stop behind them and a line break between two
            visible signs are pieces of their own, so what stands on either side is looked up by itself."""
            def make(part: str) -> bytes:
                if part.isalpha() and (part.isascii() or max(part) < LATIN_END):
                    return piece(lead + part)
                if part[-1:] in STOPS and part[:-1].isalpha():
                    return again[part[:-1]] + get(part[-1])
                left, line, right = part.partition("\n")
                if line and left and right and not left[-1].isspace() and not right[0].isspace():
                    return again[left] + get(line) + self.bare[right]
                return b"".join(map(get, PIECE.findall(lead + part)))

            return make

        self.rest, self.bare = _Memo(None, most), _Memo(None, most)
        self.rest.make, self.bare.make = maker(" ", self.rest), maker("", self.bare)

    def _parts(self, text: str) -> list[str] | None:
        """The text cut before spaces, those spaces left out; None where the library has to see it whole."""
        if not self.by_part or any(s in text for s in self.special):
            return None
        parts = text.split(" ")
        if text.endswith(" ") or UNSAFE.search(text):
            joined = parts[:1]
            for part in parts[1:]:
                if part and not UNSAFE.match(" " + part[0]):
                    joined.append(part)
                else:
                    joined[-1] += " " + part
            parts = joined
        for memo in (self.rest, self.bare, self.pieces):
            memo.turn()
        return parts

    def raw(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        parts = self._parts(text)
        if parts is None:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(parts[0]))) + b"".join(map(self.rest.__getitem__, parts[1:]))

    def batch(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string array, ``end`` behind each text, and how many each text has then."""
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = pc.match_substring_regex(texts, LOOSE) if self.by_part else pa.array(np.ones(n, bool))
        for special in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        border, parts = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        raw = list(map(self.rest.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False)))
        # First parts have no space before them, and texts that cannot be cut here stand in their place.
        place = parts.indices.to_numpy().copy()
        place[border[:-1]] = len(raw) + np.arange(n)
        first = list(map(self.bare.__getitem__, cut.values.take(pa.array(border[:-1])).to_pylist()))
        for memo in (self.rest, self.bare, self.pieces):
            memo.turn()
        for i in np.flatnonzero(whole).tolist():
            first[i] = self.raw(texts[i].as_py())
        raw += [*first, end]
        place = np.insert(place, border[1:], len(raw) - 1)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        each = size[place]
        ends = np.cumsum(each)
        at = np.repeat((np.cumsum(size) - size)[place] - ends + each, each)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(raw), np.uint32)[at], np.diff(ends[border[1:] + np.arange(n)], prepend=0)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), np.uint32)
