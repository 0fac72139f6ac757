"""Canonical Huffman codes of bounded length for numbers, encoded and decoded by whole-array steps."""

from __future__ import annotations

import numpy as np

# A code of this many bits at most can be read from any bit of a 32-bit window.
LIMIT, WIDEST = 18, 25
# Numbers between two checkpoints, each of which is a place where decoding can start.
STRIDE = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol's code, 0 where it does not occur: the cheapest prefix code without longer ones (package-merge).

    A level's packages are the pairs, in order of weight, of the level below put among the single symbols. The 2n - 2 lightest
    of the last level are taken; a symbol's length is the number of levels at which it was taken. With n symbols the limit grows
    to the bits that n needs.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    if limit > WIDEST:
        raise ValueError(f"{len(used)} symbols need codes of more than {WIDEST} bits")
    order = used[np.lexsort((used, counts[used]))]
    single = counts[order].astype(np.float64)  # sums stay exact below 2 ** 53
    row, levels = single, []
    for _ in range(limit - 1):
        pairs = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.argsort(np.concatenate((single, pairs)), kind="stable")
        levels.append(merged < len(single))
        row = np.concatenate((single, pairs))[merged]
    take, depth = 2 * len(single) - 2, np.zeros(len(single), np.int64)
    for is_single in reversed(levels):
        mine = int(np.count_nonzero(is_single[:take]))
        depth[:mine] += 1
        take = 2 * (take - mine)
    depth[:take] += 1
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: in order of length and then number, each the one before plus one, widened to its length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint32)
    if len(order):
        top = int(lengths[order[-1]])
        steps = np.left_shift(1, top - lengths[order])
        codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order])
    return codes


class Codec:
    """Encodes blocks and decodes them through one table from the next bits to a symbol and its length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        self.codes = canonical(self.lengths)
        self.width = int(self.lengths.max(initial=1))
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        if self._table is None:
            known = np.flatnonzero(self.lengths)
            order = known[np.lexsort((known, self.lengths[known]))]
            times = np.left_shift(1, self.width - self.lengths[order])
            symbol = np.zeros(1 << self.width, np.uint32)
            size = np.full(1 << self.width, self.width, np.int64)  # bits that no code starts with are not met
            filled = int(times.sum())
            symbol[:filled], size[:filled] = np.repeat(order, times), np.repeat(self.lengths[order], times)
            self._table = symbol, size
        return self._table

    def encode(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of several texts, the byte behind each, and the bit, counted in its text, at which every STRIDE-th symbol starts.

        ``ends`` has the number of symbols up to the end of each text, of one symbol at least. Texts start on whole bytes.
        """
        size = self.lengths[symbols]
        bit = np.cumsum(size)
        first = np.concatenate(([0], ends[:-1]))
        before = bit[first] - size[first]
        stop = np.cumsum((bit[ends - 1] - before + 7) >> 3)
        text = np.repeat(np.arange(len(ends)), ends - first)
        own = bit - size - before[text]
        start = own + 8 * np.concatenate(([0], stop[:-1]))[text]
        out = np.zeros(int(stop[-1]) + 4, np.float64)
        # a code lies in four bytes from its first; bits of different codes differ, so bytes may be added
        word = self.codes[symbols].astype(np.uint64) << (32 - size - (start & 7)).astype(np.uint64)
        for k in range(4):
            out += np.bincount((start >> 3) + k, ((word >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64), len(out))
        return out[:-4].astype(np.uint8), stop, own[(np.arange(len(symbols)) - first[text]) % STRIDE == 0]

    def decode(self, data: bytes, checkpoints: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The symbols behind each checkpoint (a bit of ``data``), ``counts`` of them; all are read side by side, one at a time."""
        symbol, size = self.table()
        raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        at, place, left = checkpoints[order], (np.cumsum(counts) - counts)[order], counts[order]
        out, shift, mask = np.zeros(int(counts.sum()), np.uint32), 32 - self.width, np.uint32((1 << self.width) - 1)
        for k in range(int(left[0]) if len(left) else 0):
            if left[-1] <= k:  # the shorter ones are done
                lanes = int(np.searchsorted(-left, -k, "left"))
                at, place, left = at[:lanes], place[:lanes], left[:lanes]
            here = (window[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[place + k] = symbol[here]
            at = at + size[here]
        return out


def lanes(counts: np.ndarray) -> np.ndarray:
    """Symbols behind each checkpoint of texts of so many symbols."""
    n = -(-counts // STRIDE)
    sizes = np.full(int(n.sum()), STRIDE, np.int64)
    sizes[np.cumsum(n) - 1] = counts - (n - 1) * STRIDE
    return sizes
