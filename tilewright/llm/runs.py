"""Periodic runs of words, found by internal pattern matching: where dyadic blocks occur again close by."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import small_batches

# A run has at least this many words and repeats its period at least EXPONENT times; the search below relies on four or more.
LEAST, EXPONENT = 6, 4
# Texts are put together up to this many words, each closed by a symbol of its own, so that array steps are long.
BATCH_WORDS = 1 << 16


class WaveletTree:
    """Order statistics of any stretch of a permutation, by one bit of its values a level (zeros first, each half in order)."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(1, int(len(values)).bit_length()))):
            one = (values >> bit & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(len(one) // 64 + 2, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1].astype(np.int32)
            zeros = int(len(one) - np.count_nonzero(one))
            self.levels.append((bit, words, before, zeros))
            values = np.concatenate((values[~one], values[one]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones ahead of each place."""
        word = at >> 6
        rest = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[word] + np.bitwise_count(rest)

    def smaller(self, lo: np.ndarray, hi: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are smaller than each number."""
        lo, hi, n = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            one = (than >> bit & 1).astype(bool)
            n += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return n

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k, from 0, in [lo, hi)."""
        lo, hi, k, value = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            here = (hi - b) - (lo - a)
            one = k >= here
            value |= one.astype(np.int64) << bit
            k -= np.where(one, here, 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return value


def _refined(rank: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First place in the suffix array, and number, of the factors of twice ``width`` symbols that equal the one at each position.

    ``rank`` and ``size`` tell this of factors of ``width`` symbols. Factors that occur once stay as they are.
    """
    at = np.flatnonzero(size > 1)
    second = np.full(len(at), -1, np.int64)
    inside = at + width < len(rank)
    second[inside] = rank[at[inside] + width]
    first = rank[at].astype(np.int64)
    order = np.argsort(first * (len(rank) + 1) + second + 1, kind="stable")
    first, second, at = first[order], second[order], at[order]
    new_first = np.concatenate(([True], first[1:] != first[:-1]))
    new = new_first | np.concatenate(([True], second[1:] != second[:-1]))
    begin = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    group_first = np.flatnonzero(new_first)[np.cumsum(new_first) - 1]
    rank, size = rank.copy(), size.copy()
    rank[at] = first + begin[group] - group_first
    size[at] = np.diff(np.append(begin, len(at)))[group]
    return rank, size


def _shared(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many symbols agree from a and b (a < b) on, or before them, by factors of halving width."""
    n, total = len(ranks[0]), np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        width = 1 << k
        todo = np.arange(len(a))
        while len(todo):  # more than once at the largest width only
            i, j = (a[todo] + total[todo], b[todo] + total[todo]) if forward else (a[todo] - total[todo] - width, b[todo] - total[todo] - width)
            fits = (j < n) if forward else (i >= 0)
            todo, i, j = todo[fits], i[fits], j[fits]
            same = ranks[k][i] == ranks[k][j]
            todo = todo[same]
            total[todo] += width
            if k + 1 < len(ranks):
                break
    return total


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows, in order."""
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in columns], axis=0))) if len(order) else np.zeros(0, bool)
    return tuple(c[new] for c in columns)


def find_runs(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in a text of numbers, by start and then period; ``longest`` bounds their length.

    Let 2 ** k lie in [q, 2q) for a run of smallest period q. The run, of 4q symbols or more, holds a block of the grid of width
    2 ** k, with q symbols of the run left over before or behind it; so the block occurs again at a distance of q. Its occurrences
    in a window of its own width form a progression, and by the periodicity lemma the nearest one there is at distance q
    exactly. So each block asks for the next and the last occurrence of itself: the range successor and predecessor of its
    position among the positions in its stretch of the suffix array, whose order need not go beyond the widest block.
    """
    _, first, inverse, size = np.unique(symbols, return_index=True, return_inverse=True, return_counts=True)
    rank, size = (np.cumsum(size) - size)[inverse].astype(np.int32), size[inverse].astype(np.int32)
    ranks, blocks, width = [], [], 1
    while width <= max(1, longest // 2) and (size > 1).any():
        at = np.arange(0, len(symbols), width)
        at = at[size[at] > 1]
        ranks.append(rank)
        blocks.append((at, rank[at].astype(np.int64), size[at].astype(np.int64), width))
        rank, size = _refined(rank, size, width)
        width *= 2
    none = np.zeros(0, np.int64)
    if not ranks:
        return none, none, none
    tree = WaveletTree(np.argsort(rank, kind="stable"))
    at, lo, n, width = (np.concatenate([np.broadcast_to(b[c], len(b[0])) for b in blocks]).astype(np.int64) for c in range(4))
    mine = tree.smaller(lo, lo + n, at)
    ahead, behind = mine + 1 < n, mine > 0
    after = tree.kth(lo[ahead], (lo + n)[ahead], mine[ahead] + 1)
    before = tree.kth(lo[behind], (lo + n)[behind], mine[behind] - 1)
    left = np.concatenate((at[ahead], before))
    period = np.concatenate((after - at[ahead], at[behind] - before))
    near = period <= np.concatenate((width[ahead], width[behind]))
    left, period = _distinct(left[near], period[near])
    start = left - _shared(ranks, left, left + period, False)
    length = left + period + _shared(ranks, left, left + period, True) - start
    whole = (length >= LEAST) & (length >= EXPONENT * period)
    start, length, period = _distinct(start[whole], length[whole], period[whole])
    # a multiple of the period gives the same stretch again
    smallest = np.concatenate(([True], (start[1:] != start[:-1]) | (length[1:] != length[:-1]))) if len(start) else np.zeros(0, bool)
    start, length, period = start[smallest], length[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, or for one id in ten (by CRC-32 of its digits; not for null ids) with a tail that repeats its first p words."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _most(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of greatest length / period, compared in whole numbers; the first of equal ones."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _answers(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], str]]:
    """Runs and collapsed text of each list of words, searched as one text."""
    number: dict[bytes, int] = {}
    symbols, begins, at = np.empty(sum(map(len, texts)) + len(texts), np.int64), [], 0
    for k, words in enumerate(texts):
        begins.append(at)
        symbols[at:at + len(words)] = [number.setdefault(w, len(number)) for w in words]
        at += len(words) + 1
        symbols[at - 1] = -k - 1
    start, length, period = find_runs(symbols, max(map(len, texts), default=0))
    whose = np.searchsorted(begins, start, "right") - 1
    bounds = np.searchsorted(whose, np.arange(len(texts) + 1))
    for k, words in enumerate(texts):
        own = slice(bounds[k], bounds[k + 1])
        runs = list(zip((start[own] - begins[k]).tolist(), length[own].tolist(), period[own].tolist()))
        if runs:
            step = np.zeros(len(words) + 1, np.int64)
            np.add.at(step, [s + q for s, _, q in runs], 1)
            np.add.at(step, [s + n for s, n, _ in runs], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]
        yield runs, b" ".join(words).decode("utf-8", "surrogatepass")


def periodic_runs(documents: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed for each row of (doc_id, text).

    ``runs`` are all stretches of words with smallest period q, of 6 and of 4q words or more, that neither neighbour extends, by start
    and period; start, length, period and exponent_milli are those of the greatest exact exponent, the first of equal ones.
    ``collapsed`` leaves out every word that some run holds behind its first period. ``change`` may give other words to search.

    A task works on texts of about BATCH_WORDS words at once. A longer text is searched alone; each word takes some 200 bytes
    and 4 for each width of block. Null and blank texts: no runs, nulls, an empty text. Rows are independent, so ties, null and
    repeated ids and other columns have no effect. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, words = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                ids.append(doc_id)
                texts.append(change(doc_id, found) if change else found)
                words += len(found)
                if words >= BATCH_WORDS or len(ids) >= 4096:
                    yield give(ids, texts)
                    ids, texts, words = [], [], 0
        if ids:
            yield give(ids, texts)
        pa.default_memory_pool().release_unused()

    def give(ids: list, texts: list) -> pa.RecordBatch:
        answers = list(_answers(texts))
        best = [_most(runs) if runs else (None, None, None) for runs, _ in answers]
        columns = [ids, [len(runs) for runs, _ in answers], *zip(*best), [n and 1000 * n // q for _, n, q in best],
                   [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _ in answers], [text for _, text in answers]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], names=arrow.names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs array<struct<start:long,length:long,period:long>>, collapsed string")
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, schema)
