"""SentencePiece ids of whole texts with the original bytes behind every piece, and decoding.

The normaliser of the model is run here: at every place the longest prefix that the compiled character map
knows is replaced, and each byte of the result remembers the bytes it came from. The pieces spell the
normalised text one after the other, so their lengths cut it, and the alignment turns the cuts into byte spans
of the original text. Ids are the library's.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import list_column, process_cache, slices, text_bytes

SPACE = "▁"
SCHEMA = "ids array<int>, begins array<int>, ends array<int>, covered boolean, decoded binary"


def fields(message: bytes):
    """(number, value) of every field of a protocol-buffer message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, message[at:at + size]
            at += size


class CharacterMap:
    """The compiled map of a normaliser: a double-array tree over UTF-8 and the replacement strings.

    Layout: the tree's size in bytes, its 32-bit units, then strings that each end with a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = struct.unpack("<I", compiled[:4])[0] if compiled else 0
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.strings = compiled[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest known prefix of ``text[at:]``."""
        if not self.units:
            return None
        unit, node, found = self.units[0], 0, None
        node ^= self._offset(unit)
        for i in range(at, len(text)):
            byte = text[i]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = (self.strings[value:self.strings.index(b"\0", value)], i + 1 - at)
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


class Normaliser:
    """Normalised text of the model with, for each of its bytes, the original bytes begin and end."""

    def __init__(self, model: bytes):
        spec = next((v for k, v in fields(model) if k == 3), b"")
        trainer = next((v for k, v in fields(model) if k == 2), b"")
        values = dict(fields(spec))
        self.map = CharacterMap(values.get(2, b""))
        self.prefix = bool(values.get(3, 1))
        self.squeeze = bool(values.get(4, 1))
        self.escape = bool(values.get(5, 1))
        self.suffix = bool(dict(fields(trainer)).get(24, 0))
        self.plain = not self.map.units and not self.squeeze and self.prefix and self.escape and not self.suffix

    def run(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        pieces, begins, ends, at = [], [], [], 0
        while at < len(text):
            found = self.map.longest(text, at)
            if found is None:
                lead = text[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = (text[at:at + size], size)
            new, size = found
            pieces.append((new, at, at + size))
            at += size
        if self.squeeze:
            while pieces and pieces[0][0] in (b" ", b""):
                pieces.pop(0)
            while pieces and pieces[-1][0] in (b" ", b""):
                pieces.pop()
        mark = SPACE.encode() if self.escape else b" "
        out, blank = [], self.squeeze
        if self.prefix and not self.suffix and pieces:
            out.append(mark)
            begins += [pieces[0][1]] * len(mark)
            ends += [pieces[0][1]] * len(mark)
        for new, begin, end in pieces:
            for byte in _characters(new):
                if byte == b" ":
                    if self.squeeze and blank:
                        continue
                    byte, blank = mark, True
                else:
                    blank = False
                out.append(byte)
                begins += [begin] * len(byte)
                ends += [end] * len(byte)
        if self.prefix and self.suffix and pieces:
            out.append(mark)
            begins += [pieces[-1][2]] * len(mark)
            ends += [pieces[-1][2]] * len(mark)
        return b"".join(out), np.array(begins, np.int64), np.array(ends, np.int64)


def _characters(text: bytes) -> list[bytes]:
    return [c.encode("utf-8", "surrogateescape") for c in text.decode("utf-8", "surrogateescape")]


class PieceEncoder:
    """Ids and byte spans of texts.

    With a plain normaliser (no map; every space becomes a space sign, one more in front) the alignment is the
    same for all texts without a space sign of their own, and spans are running sums of what each piece takes
    from the original. All other texts are normalised byte by byte.
    """

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(model)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        self.is_byte = np.array([self.library.is_byte(i) for i in range(size)])
        self.is_unknown = np.array([self.library.is_unknown(i) for i in range(size)])
        signs = np.array([n.count(SPACE) for n in names])
        # A space takes one byte in the original, a byte piece stands for one.
        self.source_bytes = np.where(self.is_byte, 1, np.array([len(n.encode()) for n in names]) - 2 * signs)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece begins and ends in the UTF-8 bytes of the text."""
        if not self.normaliser.plain or SPACE in text:
            return self._whole(text)
        ids = np.array(self.library.encode(text, return_type="numpy"), np.int32)
        if self.is_unknown[ids].any():
            return self._whole(text)
        ends = np.cumsum(self.source_bytes[ids]) - 1  # the space before the text is not in it
        return ids, np.append(0, ends)[:len(ids)].astype(np.int32), ends.astype(np.int32)

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        normal, begin, end = self.normaliser.run(text.encode())
        got = self.library.encode(text, return_type="proto").pieces
        ids = np.array([p.id for p in got], np.int32)
        size = np.array([1 if self.is_byte[p.id] else len(p.piece.encode()) for p in got], np.int64)
        if size.sum() != len(normal):
            raise ValueError("the pieces do not spell the normalised text")
        last = np.cumsum(size)
        if not len(ids):
            return ids, ids, ids
        begins = begin[last - size]
        ends = end[last - 1]
        # A byte piece stands for one byte of a character that the map left as it was.
        byte = self.is_byte[ids]
        if byte.any():
            at = last - size
            run = np.concatenate([[True], (begin[at][1:] != begin[at][:-1]) | ~byte[:-1]]) | ~byte
            head = np.maximum.accumulate(np.where(run, np.arange(len(ids)), 0))
            inside = np.arange(len(ids)) - head
            whole = end[at] - begin[at]
            begins = np.where(byte, begins + np.minimum(inside, whole), begins)
            ends = np.where(byte, np.minimum(begins + 1, ends), ends)
        return ids, begins.astype(np.int32), ends.astype(np.int32)

    @staticmethod
    def covers(begins: np.ndarray, ends: np.ndarray, size: int) -> bool:
        """Whether spans, in the order of their pieces, leave no byte of a text of ``size`` bytes out."""
        if not len(begins):
            return size == 0
        return bool(begins[0] == 0 and ends[-1] == size and (begins[1:] <= ends[:-1]).all() and (begins <= ends).all())

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def encode_pieces(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, begins, ends (byte span of every piece in the text), covered and decoded (UTF-8 of decode(ids)).

    ``covered`` says whether the spans leave no byte of the text out. A normaliser that trims blanks does leave some out.

    * A null text counts as empty; an empty text has no pieces and decodes to nothing.
    * A null doc_id stays null; repeated rows come out as often as they go in.
    * Long texts are encoded whole. Extra columns are not read. An empty table gives an empty result.
    * The space that the model puts before a text belongs to no byte of it: its span is empty or, with a
      word behind it in one piece, that of the word.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches):
        encoder = process_cache(f"pieces-{hash(shipped.value)}", lambda: PieceEncoder(shipped.value))
        for batch in slices(batches):
            texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            got = [encoder.encode(t) for t in texts]
            n = np.array([len(g[0]) for g in got], np.int64)
            columns = [list_column(n, np.concatenate([g[k] for g in got]), pa.int32()) for k in range(3)]
            decoded = pa.array([encoder.decode(g[0]).encode() for g in got], pa.binary())
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            covered = pa.array([encoder.covers(g[1], g[2], size) for g, size in zip(got, sizes)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, covered, decoded],
                                             ["doc_id", "ids", "begins", "ends", "covered", "decoded"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(encode, "doc_id bigint, " + SCHEMA)


def _listed(column: str):
    """SHA-256 of a list's decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.col(column).cast("array<string>"), ",").cast("binary"), 256)


def piece_digests(encoded: DataFrame) -> DataFrame:
    """What ``encode_pieces`` found, digested.

    doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, ends_sha256 (where each piece ends in the
    text's bytes, joined by commas) and covered.
    """
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        _listed("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        _listed("ends").alias("ends_sha256"),
        "covered",
    )
