"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic transducers. ``Borders`` reads character classes and marks where the split pattern starts a
piece. ``CountTransducer`` reads the bytes of a piece; every transition carries the number of tokens that the
longer prefix has more (or fewer) than the shorter one, so the sum along a path is the token count. Its states
come from a weighted subset construction, made as far as texts need it.

A batch of texts is one stream of symbols, cut into chunks of equal length that are read side by side. The
border states at the chunk starts come from the state map of every chunk, composed by a parallel prefix scan.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

# Character classes. ENDS are the letters that close a contraction on their own.
STOP, SPACE, WHITE, LETTER, DIGIT, OTHER, QUOTE, ENDS, R, V, L, E = range(12)
# States: nothing read, a run of white space (one or more; last is a space or not), runs of letters, digits and
# others, an apostrophe that starts a piece, a finished contraction, a contraction that lacks one letter.
(START, SPACE1, WHITE1, SPACES, WHITES, LETTERS, DIGITS, OTHERS, APOSTROPHE, DONE, NEED_R, NEED_V, NEED_L) = range(13)
HERE, BACK = 1, 2  # a piece starts at this symbol, at the one before
CHUNK, PROBE = 128, 8

# The characters with the White_Space property.
WHITE_SPACE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000]


def character_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = DIGIT
    table[WHITE_SPACE] = WHITE
    for signs, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", ENDS), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(s) for s in signs]] = kind
    return table


def _border_step(state: int, kind: int) -> tuple[int, int]:
    """Next state and marks of the split pattern: contractions, optional space and a run, white space."""
    letter = kind in (LETTER, ENDS, R, V, L, E)
    fresh = LETTERS if letter else {DIGIT: DIGITS, OTHER: OTHERS, QUOTE: APOSTROPHE}.get(kind)
    glued = OTHERS if kind == QUOTE else fresh
    waiting = {NEED_R: E, NEED_V: E, NEED_L: L}
    white = state in (SPACE1, WHITE1, SPACES, WHITES)
    if kind == STOP:
        return START, HERE | (BACK if state in waiting else 0)
    if kind in (SPACE, WHITE):
        if white:
            return (SPACES if kind == SPACE else WHITES), 0
        return (SPACE1 if kind == SPACE else WHITE1), HERE | (BACK if state in waiting else 0)
    if state in (SPACE1, SPACES):
        return glued, BACK if state == SPACES else 0
    if state in (WHITE1, WHITES):
        return fresh, HERE | (BACK if state == WHITES else 0)
    if state == APOSTROPHE:
        if kind in (ENDS, R, V, L):
            return {ENDS: DONE, R: NEED_R, V: NEED_V, L: NEED_L}[kind], 0
        return (OTHERS, 0) if kind in (OTHER, QUOTE) else (fresh, HERE)
    if state in waiting:
        if kind == waiting[state]:
            return DONE, 0
        return (LETTERS, BACK) if letter else (fresh, HERE | BACK)
    if (state, fresh) in ((LETTERS, LETTERS), (DIGITS, DIGITS), (OTHERS, OTHERS)):
        return state, 0
    if state == OTHERS and kind == QUOTE:
        return OTHERS, 0
    return fresh, HERE


class Borders:
    states, kinds = 13, 12

    def __init__(self):
        steps = [_border_step(s, k) for s in range(self.states) for k in range(self.kinds)]
        self.next = np.array([s for s, _ in steps], np.uint8)
        self.marks = np.array([m for _, m in steps], np.uint8)

    def _read(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """``symbols`` row by row; ``state`` may hold one column or one for every start state."""
        for row in symbols:
            state = self.next[state * np.uint8(self.kinds) + (row if state.ndim == 1 else row[:, None])]
        return state

    def chunk_maps(self, symbols: np.ndarray) -> np.ndarray:
        """For every chunk (a column of ``symbols``) the end state of each start state.

        After a few symbols most chunks are in one state whatever the start; these go on with that one.
        """
        n = symbols.shape[1]
        maps = self._read(np.broadcast_to(np.arange(self.states, dtype=np.uint8), (n, self.states)), symbols[:PROBE])
        one = (maps == maps[:, :1]).all(1)
        maps[one] = self._read(maps[one, 0], symbols[PROBE:, one])[:, None]
        maps[~one] = self._read(maps[~one], symbols[PROBE:, ~one])
        return maps

    @staticmethod
    def scan(maps: np.ndarray) -> np.ndarray:
        """Composition of every map with all before it, in log2(n) rounds."""
        done, reach = maps.copy(), 1
        while reach < len(done):
            done[reach:] = np.take_along_axis(done[reach:], done[:-reach].astype(np.intp), 1)
            reach *= 2
        return done

    def starts(self, kinds: np.ndarray) -> np.ndarray:
        """Positions where pieces start; a STOP counts as a piece of its own."""
        n = len(kinds)
        padded = np.full(-(-(n + 1) // CHUNK) * CHUNK, STOP, np.uint8)
        padded[:n] = kinds
        symbols = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
        entry = np.full(symbols.shape[1], START, np.uint8)
        entry[1:] = self.scan(self.chunk_maps(symbols))[:-1, START]
        marks, state = np.empty_like(symbols), entry
        for row, out in zip(symbols, marks):
            key = state * np.uint8(self.kinds) + row
            out[:] = self.marks[key]
            state = self.next[key]
        flat = np.ascontiguousarray(marks.T).reshape(-1)
        begins = flat & HERE > 0
        begins[:-1] |= flat[1:] & BACK > 0
        return np.flatnonzero(begins[:n])


class CountTransducer:
    """Bytes of a piece to its number of tokens.

    A state is a set of (last token, node of the vocabulary tree, tokens so far less those of the whole prefix):
    one entry for every place where the next token may have begun. A prefix has exactly one tokenization, and a
    token sequence is one exactly when every two neighbours are, so a step keeps what still spells a token and
    finds the one token that now ends. ``most`` bounds the states that are kept between batches.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]], most: int = 110_000):
        self.most = most
        self.word = {i: b for b, i in vocabulary.items()}
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.child: dict[tuple[int, int], int] = {}
        self.token = [-1]
        self.leaf = [True]
        for word, ident in vocabulary.items():
            node = 0
            for byte in word:
                key = (node, byte)
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.leaf.append(True)
                    self.leaf[node] = False
                node = self.child[key]
            self.token[node] = ident
        self.valid: dict[tuple[int, int], bool] = {}
        self._empty()

    def _empty(self) -> None:
        self.number = {((-1, 0, 0),): 0}
        self.state = list(self.number)
        self.next = np.full((1024, 256), -1, np.int32)
        self.count = np.zeros((1024, 256), np.int8)

    def _merged(self, parts: list[bytes]) -> list[bytes]:
        while len(parts) > 1:
            ranks = [self.rank.get(pair, 1 << 30) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _neighbours(self, last: int, token: int) -> bool:
        key = (last, token)
        if key not in self.valid:
            words = [self.word[token]] if last < 0 else [self.word[last], self.word[token]]
            self.valid[key] = self._merged([bytes([b]) for b in b"".join(words)]) == words
        return self.valid[key]

    def _add(self, key: int) -> None:
        """The transition of one state and byte."""
        state, byte = divmod(key, 256)
        kept, ended = [], None
        for last, node, less in self.state[state]:
            child = self.child.get((node, byte))
            if child is None:
                continue
            if not self.leaf[child]:
                kept.append((last, child, less))
            if self.token[child] >= 0 and ended is None and self._neighbours(last, self.token[child]):
                ended = (self.token[child], less + 1)
        if ended is None:
            raise ValueError("bytes without a token")
        token, step = ended
        entry = tuple(sorted([(last, node, less - step) for last, node, less in kept] + [(token, 0, 0)]))
        if entry not in self.number:
            self.number[entry] = len(self.state)
            self.state.append(entry)
            if len(self.state) > len(self.next):
                more = len(self.next) // 2
                self.next = np.concatenate([self.next, np.full((more, 256), -1, np.int32)])
                self.count = np.concatenate([self.count, np.zeros((more, 256), np.int8)])
        self.next[state, byte], self.count[state, byte] = self.number[entry], step

    def counts(self, content: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of the pieces ``content[start : start + length]``, read side by side."""
        if len(self.state) > self.most:
            self._empty()
        order = np.argsort(-length.astype(np.int32), kind="stable")
        at, left = start[order], length[order]
        alive = len(left) - np.searchsorted(left[::-1], np.arange(int(left[0]) if len(left) else 0), side="right")
        state, total = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        for k, n in enumerate(alive.tolist()):
            key = state[:n] * 256 + content[at[:n] + k]
            following = self.next.reshape(-1)[key]
            if following.min() < 0:
                for missing in np.unique(key[following < 0]).tolist():
                    self._add(missing)
                following = self.next.reshape(-1)[key]
            total[:n] += self.count.reshape(-1)[key]
            state[:n] = following
        out = np.empty_like(total)
        out[order] = total
        return out


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Counts as ``encode(text, add_special_tokens=False)`` gives them, special strings taken as special."""

    def __init__(self, content: bytes):
        plan = json.loads(content)
        pre, model = plan.get("pre_tokenizer") or {}, plan["model"]
        if (plan.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model["type"] != "BPE" or model.get("ignore_merges")):
            raise ValueError("only byte-level BPE without normaliser can be compiled")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in plan["added_tokens"]):
            raise ValueError("added tokens that look at their neighbours can't be compiled")
        self.special = [t["content"] for t in plan["added_tokens"]]
        sign = byte_signs()
        spell = lambda text: bytes(sign[c] for c in text)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        merges = [(spell(a), spell(b)) for a, b in pairs]
        added = set(self.special)
        self.counter = CountTransducer({spell(t): i for t, i in model["vocab"].items() if t not in added}, merges)
        self.borders, self.kinds = Borders(), character_classes()

    def count(self, texts: list[str]) -> np.ndarray:
        pieces, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            cut = [text]
            for special in self.special:
                if special in text:
                    cut = [x for part in cut for x in part.split(special)]
            total[i] = len(cut) - 1
            pieces += cut
            owner += [i] * len(cut)
        joined = "\0".join(pieces)
        if not joined:
            return total
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[codes]
        stops = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)[:-1] - 1
        kinds[stops] = STOP
        starts = self.borders.starts(kinds)
        size = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF), out=size[1:])
        ends = np.append(starts[1:], len(codes))
        real = kinds[starts] != STOP
        starts, ends = starts[real], ends[real]
        content = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        tokens = self.counter.counts(content, size[starts], size[ends] - size[starts])
        piece = np.searchsorted(stops, starts, side="right")
        np.add.at(total, np.array(owner, np.int64)[piece], tokens)
        return total
