"""Tokenizer operators against the libraries, whole texts and odd cases."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dockline.llm.bytepair import PartEncoder
from dockline.llm.huffman import LIMIT, Codebook, code_lengths
from dockline.llm.pieces import CharacterMap, PieceEncoder, encode_pieces, fields, piece_digests
from dockline.llm.token_files import _from_planes, _planes, read_token_files, token_file_round_trip, write_token_files
from dockline.llm.transducer import Borders, TokenCounter, _border_step
from dockline.llm.transducer_counts import token_counts

JSON = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
TEXTS = ["", " ", "  ", "a", " a ", "a\n\n b", "don't we'll they've 're ''s", "x" * 5000, "one two  three\t four five",
         "<|endoftext|> a <|endoftext|>", "𝄞é中١", "\0", "▁ a▁b", "</s><0x41>", "The end. " * 40]
SCHEMA = "doc_id bigint, text string, ids string"


def random_texts(count, seed=1):
    pick = random.Random(seed)
    signs = " \n\t'sdtrelvm.aé \x1c\x85 1١中!𝄞\0x▁<|endoftext|>"
    return ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_buffer(JSON)


@pytest.fixture(scope="module")
def given(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, "a", "clash"), (None, "no id", None), (99, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def plain_ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_parts_give_the_library_ids(library):
    encoder = PartEncoder(JSON)
    for text in TEXTS + random_texts(1500):
        assert encoder.ids(text).tolist() == plain_ids(library, text), repr(text)


def test_letters_and_stops_give_the_library_ids(library):
    encoder = PartEncoder(JSON)
    for text in ("word", " word", "Hello, world! it's don't. I'm; we'll: they've? x.y a., 'tis .", "Stra\u00dfe, \u00e9t\u00e9.", "a b c", "zqxjkv, QZQ!",
                 "end.\n next", "tab\tstop, ", "internationalization."):
        assert encoder.ids(text).tolist() == plain_ids(library, text)


def test_part_memory_is_bounded(library):
    encoder = PartEncoder(JSON, most=5)
    text = " ".join(f"w{i}" for i in range(50))
    assert encoder.ids(text).tolist() == encoder.ids(text).tolist() == plain_ids(library, text)


def test_batches_give_the_library_ids(library):
    for encoder in (PartEncoder(JSON), PartEncoder(JSON, most=5)):
        for texts in (TEXTS + random_texts(1500, 4), ["a b a b"], [""], []):
            ids, n = encoder.batch(pa.array(texts, pa.string()), np.uint32(7).tobytes())
            want = [plain_ids(library, t) + [7] for t in texts]
            assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_a_batch_looks_up_equal_parts_once(monkeypatch):
    encoder, asked = PartEncoder(JSON), []
    monkeypatch.setattr(type(encoder.rest), "__getitem__", lambda memo, key: asked.append(key) or dict.get(memo, key, b""))
    encoder.batch(pa.array(["one two two"] * 500))
    assert asked.count("two") == 1 and len(asked) < 600


@pytest.mark.parametrize("top, width", [(100, 2), (1 << 16, 2), (70_000, 4)])
def test_ids_take_two_bytes_where_that_is_enough(top, width):
    ids, n = np.append(np.random.default_rng(0).integers(0, top, 999), top - 1).astype(np.uint32), np.array([3, 0, 997])
    stored = _planes(ids, n)
    assert [len(s) for s in stored] == (width * n + 1).tolist()
    assert np.concatenate([_from_planes(s) for s in stored]).tolist() == ids.tolist()


def test_transducer_counts_equal_the_library(library):
    counter = TokenCounter(JSON)
    texts = TEXTS + random_texts(1500, 2)
    assert counter.count(texts).tolist() == [len(plain_ids(library, t)) for t in texts]
    counter.counter.most = 10  # states are dropped and made anew
    assert counter.count(texts).tolist() == [len(plain_ids(library, t)) for t in texts]


def test_border_scan_equals_reading_symbol_by_symbol():
    borders, pick = Borders(), np.random.default_rng(0)
    for n in (1, 7, 127, 128, 129, 1000):
        kinds = pick.integers(0, 12, n).astype(np.uint8)
        state, begins = 0, np.zeros(n + 1, bool)
        for i, kind in enumerate([*kinds.tolist(), 0]):
            state, mark = _border_step(state, kind)
            begins[i] |= bool(mark & 1)
            if mark & 2:
                begins[i - 1] = True
        assert borders.starts(kinds).tolist() == np.flatnonzero(begins[:n]).tolist()


def test_token_counts_table(spark, given, library):
    docs, rows = given
    got = sorted(map(tuple, token_counts(docs, JSON, 30).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(plain_ids(library, t or "")), len(plain_ids(library, t or "")) > 30)
                   for i, t, _ in rows), key=str)
    assert got == want
    assert token_counts(docs.limit(0), JSON).count() == 0


def test_code_lengths_are_the_best_within_the_limit():
    import heapq
    counts = np.random.default_rng(1).integers(1, 1000, 300)
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((code_lengths(counts).astype(int) * counts).sum()) == cost
    steep = np.array([2 ** min(i, 60) for i in range(64)], float)
    tight = code_lengths(steep)
    assert tight.max() <= LIMIT and (0.5 ** tight.astype(float)).sum() <= 1
    assert code_lengths(np.array([5])).tolist() == [1] and len(code_lengths(np.zeros(0))) == 0


@pytest.mark.parametrize("seed", range(4))
def test_packed_ids_come_back(seed):
    pick = np.random.default_rng(seed)
    counts = pick.integers(1, 10 ** pick.integers(1, 8), pick.integers(1, 3000))
    ids = np.sort(pick.choice(60_000, len(counts), replace=False))
    book = Codebook(ids, code_lengths(counts))
    per_text = pick.integers(0, 700, 30)
    sent = ids[pick.integers(0, len(ids), per_text.sum())]
    content, size, marks = book.pack(sent, per_text)
    assert (book.unpack(content, np.cumsum(size) - size, per_text, marks) == sent).all()


def test_token_files_round_trip(spark, given, library, tmp_path):
    docs, rows = given
    ids = {}
    for i, t, _ in rows:
        ids.setdefault(i, []).append(plain_ids(library, t or "") + [0])
    got = token_file_round_trip(docs, JSON).collect()
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        assert r["ids_crc32"] in [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[r["doc_id"]]]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    write_token_files(docs, str(tmp_path / "files"), JSON)
    for r in read_token_files(spark, str(tmp_path / "files")).collect():
        assert r["ids"] in ids[r["doc_id"]]
    assert token_file_round_trip(docs.limit(0), JSON).count() == 0


def test_pieces_equal_the_library_and_spans_spell_the_text():
    encoder = PieceEncoder(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for text in TEXTS + random_texts(800, 3):
        ids, begins, ends = encoder.encode(text)
        assert ids.tolist() == library.encode(text), repr(text)
        raw = text.encode()
        assert b"".join(raw[b:e] for b, e in zip(begins, ends)) == raw, repr(text)
        for k, piece in enumerate(library.encode(text, return_type="proto").pieces):
            if not encoder.is_byte[piece.id]:
                assert (begins[k], ends[k]) == (piece.begin, piece.end), repr(text)


def compiled(entries):
    """A character map made by hand: the tree is laid out with one free 256-unit block per node."""
    strings, tree = b"", {}
    for source, target in entries.items():
        node = tree
        for byte in source:
            node = node.setdefault(byte, {})
        node[None] = len(strings)
        strings += target + b"\0"
    units, blocks = {}, [0]

    def place(node, at, label):
        blocks[0] += 1
        base = 256 * blocks[0]
        offset = at ^ base
        units[at] = (offset << 10 if offset < 1 << 21 else (offset >> 8) << 10 | 1 << 9) | (None in node) << 8 | label
        if None in node:
            units[base] = node[None] | 1 << 31
        for byte, child in node.items():
            if byte is not None:
                place(child, base ^ byte, byte)

    place(tree, 0, 0)
    import struct
    body = b"".join(struct.pack("<I", units.get(i, 0)) for i in range(max(units) + 256))
    return struct.pack("<I", len(body)) + body + strings


def test_longest_prefix_of_a_character_map():
    known = CharacterMap(compiled({b"a": b"x", b"ab": b"yy", b"abcd": b"", "é".encode(): b"e"}))
    text = "abcabcdaé".encode()
    assert known.longest(text, 0) == (b"yy", 2)
    assert known.longest(text, 2) is None
    assert known.longest(text, 3) == (b"", 4)
    assert known.longest(text, 7) == (b"x", 1)
    assert known.longest(text, 8) == (b"e", 2)


def test_alignment_through_a_character_map():
    encoder = PieceEncoder(MODEL)
    encoder.normaliser.map = CharacterMap(compiled({"ﬁ".encode(): b"fi", "…".encode(): b"..."}))
    normal, begin, end = encoder.normaliser.run("a ﬁ…".encode())
    assert normal.decode() == "▁a▁fi..."
    assert [(int(b), int(e)) for b, e in zip(begin, end)][3:] == [(0, 1), (1, 2), (1, 2), (1, 2), (2, 5), (2, 5), (5, 8), (5, 8), (5, 8)]


def plain_ends(library, text):
    """Where the library's own pieces end in the text's bytes; byte pieces of one character take a byte each."""
    ends, at = [], 0
    for piece in library.encode(text, return_type="proto").pieces:
        at = at + 1 if library.is_byte(piece.id) else piece.end
        ends.append(at)
    return ends


def test_spans_that_cover():
    covers = lambda spans, size: PieceEncoder.covers(*(np.array(x, np.int32) for x in zip(*spans)), size)
    none = np.zeros(0, np.int32)
    assert PieceEncoder.covers(none, none, 0) and not PieceEncoder.covers(none, none, 1)
    assert covers([(0, 0), (0, 3), (3, 5)], 5) and covers([(0, 3), (0, 3), (3, 5)], 5)
    assert not covers([(0, 2), (3, 5)], 5) and not covers([(1, 5)], 5) and not covers([(0, 4)], 5)


def filled(entries):
    """The test model with another character map and a trimming normaliser: the field of the normaliser is written anew."""
    def number(n):
        return bytes([n & 127 | 128]) + number(n >> 7) if n > 127 else bytes([n])

    def field(key, value):
        return number(key << 3) + number(value) if isinstance(value, int) else number(key << 3 | 2) + number(len(value)) + value

    spec = next(v for k, v in fields(MODEL) if k == 3)
    old = {k: v for k, v in fields(spec)}
    new = b"".join(field(k, v) for k, v in sorted({**old, 2: compiled(entries), 4: 1}.items()))
    at = MODEL.index(field(3, spec))
    return MODEL[:at] + field(3, new) + MODEL[at + len(field(3, spec)):]


def test_model_with_a_filled_character_map():
    """Ids and spans of a model whose map replaces, widens and deletes, and that squeezes blanks."""
    model = filled({"\ufb01".encode(): b"fi", "\u2026".encode(): b"...", "\u00a0".encode(): b" ", "\u00ad".encode(): b"", b"Q": b"q"})
    encoder, library = PieceEncoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    assert not encoder.normaliser.plain
    for text in ["", "  ", "the \ufb01sh\u2026  end ", "so\u00adft\u00a0 hy\u00adphen", "Queue \ufb01\ufb01 \u2026\u2026", "\U0001f9ff Q"]:
        ids, begins, ends = encoder.encode(text)
        assert ids.tolist() == library.encode(text), repr(text)
        raw = text.encode()
        if not encoder.is_byte[ids].any():
            assert encoder.normaliser.run(raw)[0].decode() == "".join(library.id_to_piece(i) for i in ids.tolist()), repr(text)
        assert (begins <= ends).all() and (ends[1:] >= ends[:-1]).all() and (not len(ends) or ends[-1] <= len(raw)), repr(text)
    ids, begins, ends = encoder.encode("x\ufb01")
    assert begins[0] == 0 and ends[-1] == 4 and encoder.covers(begins, ends, 4)


def test_piece_table(spark, given):
    docs, rows = given
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    got = sorted(map(tuple, piece_digests(encode_pieces(docs, MODEL)).collect()), key=str)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = sorted(((i, len(library.encode(t or "")), digest(",".join(map(str, library.encode(t or "")))),
                    digest(library.decode(library.encode(t or ""))), digest(",".join(map(str, plain_ends(library, t or "")))), True)
                   for i, t, _ in rows), key=str)
    assert got == want
    assert encode_pieces(docs.limit(0), MODEL).count() == 0
