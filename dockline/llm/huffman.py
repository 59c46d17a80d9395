"""Canonical length-limited Huffman codes over token ids: lengths, packing and table-driven unpacking."""

from __future__ import annotations

import numpy as np

from dockline.llm.common import ragged

LIMIT = 18  # longest code in bits; the decoding table has 2**LIMIT entries
STRIDE = 128  # ids between two bit-offset checkpoints


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the best prefix code with no code over ``limit`` bits, by package-merge; counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    coins = np.asarray(counts, np.float64)[order]
    levels, packages = [], coins[:0]
    for _ in range(limit):
        merged = np.concatenate([coins, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_coin in reversed(levels):
        used = int(is_coin[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.zeros(n, np.uint8)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes: shorter first, then by id; only ids and lengths have to be stored."""

    def __init__(self, ids, lengths, limit: int = LIMIT):
        ids, lengths = np.asarray(ids, np.int64), np.asarray(lengths, np.int64)
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        top = int(ids.max()) + 1 if len(ids) else 1
        # The code of a symbol is the sum of the widths of all before it, read at its own length.
        width = np.left_shift(1, limit - lengths)
        start = np.cumsum(width) - width
        self.limit = limit
        self.length = np.zeros(top, np.uint8)
        self.left = np.zeros(top, np.uint64)  # the code, at the upper end of 64 bits
        self.length[ids] = lengths
        self.left[ids] = start.astype(np.uint64) << np.uint64(64 - limit)
        self.entry = np.zeros(1 << limit, np.uint32)
        self.entry[:int(width.sum())] = np.repeat((ids << 5 | lengths).astype(np.uint32), width)

    def pack(self, ids: np.ndarray, per_text: np.ndarray):
        """Bytes of every text, one after the other, each on a byte border.

        Returns the bytes, the number of bytes of every text, and the bit offset inside its text of every
        STRIDE-th id.
        """
        length = self.length[ids]
        if len(length) and not length.all():
            raise ValueError("an id without a code")
        before = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=before[1:])
        first = np.cumsum(per_text) - per_text
        base = before[first]
        size = (before[first + per_text] - base + 7) // 8
        shift = 8 * (np.cumsum(size) - size) - base
        stretches = (per_text + STRIDE - 1) // STRIDE
        marks = before[np.repeat(first, stretches) + STRIDE * ragged(stretches)] - np.repeat(base, stretches)
        at = before[:-1] + np.repeat(shift, per_text)
        total = int(size.sum())
        words = np.zeros(total // 4 + 3, np.uint64)
        if len(ids):
            # A code touches one or two 32-bit words; the bits are disjoint, so that sums carry nothing over.
            wide = self.left[ids] >> (at & 31).view(np.uint64)
            word = at >> 5
            starts = np.flatnonzero(word[1:] != word[:-1]) + 1
            starts = np.concatenate([[0], starts])
            sums = np.add.reduceat(wide >> np.uint64(32), starts), np.add.reduceat(wide & np.uint64(0xFFFFFFFF), starts)
            words[word[starts]] += sums[0]
            words[word[starts] + 1] += sums[1]
        return words.astype(">u4").tobytes()[:total], size, marks

    def unpack(self, content: bytes, byte_start: np.ndarray, per_text: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """All ids of the texts; the stretches between checkpoints are read side by side."""
        stretches = (per_text + STRIDE - 1) // STRIDE
        text = np.repeat(np.arange(len(per_text)), stretches)
        left = np.minimum(STRIDE, per_text[text] - STRIDE * ragged(stretches))
        out = np.zeros(int(per_text.sum()), np.uint32)
        write = np.cumsum(left) - left
        at = marks + 8 * byte_start[text]
        raw = np.frombuffer(content + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        order = np.argsort(-left, kind="stable")
        at, write, left = at[order], write[order], left[order]
        down, mask = 32 - self.limit, (1 << self.limit) - 1
        for k in range(int(left[0]) if len(left) else 0):
            alive = int(np.searchsorted(-left, -k, side="left"))
            at, write = at[:alive], write[:alive]
            found = self.entry[window[at >> 3] >> (down - (at & 7)).astype(np.uint32) & mask]
            out[write] = found >> 5
            at = at + (found & 31)
            write = write + 1
        return out

