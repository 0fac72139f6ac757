"""Ranked lexical search without an index: one automaton of all query terms is run over every text."""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.common import cut, small_batches

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of distinct terms in one automaton, about 100 MB of nodes; more items take several scans, one after the other.
GROUP_BYTES = 1_000_000
SHARDS = 64
_LETTERS = bytes(range(97, 123))
# Term bytes as they are, A-Z in lower case, all else a blank.
_FOLD = bytes(c if c >= 128 or 48 <= c < 58 or c in _LETTERS else c + 32 if c + 32 in _LETTERS and 65 <= c < 91 else 32 for c in range(256))
_automata: dict[bytes, ahocorasick.Automaton] = {}


def folded(text: str | None) -> bytes:
    """Terms of a text in UTF-8 between single or repeated blanks; every code point beyond ASCII belongs to a term."""
    return b" " + (text or "").encode("utf-8", "surrogatepass").translate(_FOLD) + b" "


def _automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Reports a term's number where it stands between blanks; one automaton a worker is kept."""
    mark = hashlib.sha1(b" ".join(terms)).digest()
    if mark not in _automata:
        _automata.clear()
        a = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            a.add_word(f" {term.decode('latin-1')} ", k)
        a.make_automaton()
        _automata[mark] = a
    return _automata[mark]


def _counted(automaton: ahocorasick.Automaton, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text; the numbers of known terms in it and how often each occurs."""
    data = folded(text)
    blank = np.frombuffer(data, np.uint8) == 32
    n = int(np.count_nonzero(blank[:-1] & ~blank[1:]))
    seen = Counter(k for _, k in automaton.iter(data.decode("latin-1"))) if n and len(automaton) else {}
    return n, np.fromiter(seen.keys(), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen))


def _per_partition(docs: DataFrame, work: Callable[[Iterator[tuple]], Iterator[list[tuple]]], schema: str) -> DataFrame:
    """``work`` on the (doc_id, text) of each partition; it gives lists of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def values() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())

        for rows in work(values()):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names, types = arrow.names, arrow.types
    return docs.mapInArrow(run, schema)


def _statistics(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term. A partition hands on one row a term it holds, summed before the driver sees one a term."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(terms))

    def work(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        known = pickle.loads(sent.value)
        automaton, df, docs_n, terms_n = _automaton(known), np.zeros(len(known), np.int64), 0, 0
        for _, text in rows:
            n, found, _ = _counted(automaton, text)
            df[found] += 1
            docs_n += n > 0
            terms_n += n
        yield [(-1, docs_n), (-2, terms_n), *((int(k), int(df[k])) for k in np.flatnonzero(df))]

    sums = dict(_per_partition(docs, work, "k long, n long").groupBy("k").agg(F.sum("n")).collect())
    df = np.zeros(len(terms), np.int64)
    for k, n in sums.items():
        if k >= 0:
            df[k] = n
    return sums.get(-1, 0), sums.get(-2, 0), df


def _best(docs: DataFrame, terms: list[bytes], weights: np.ndarray, of_term: list[list[tuple[int, int]]], items: int, top: int,
          n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score) of the ``top`` documents of each item in each partition; ``of_term`` lists a term's (item, times)."""
    first = np.concatenate(([0], np.cumsum([len(p) for p in of_term]))).astype(np.int64)
    whose = np.array([i for p in of_term for i, _ in p], np.int64)
    times = np.array([m for p in of_term for _, m in p], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps((terms, weights, first, whose, times)))

    def work(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        known, weight, first, whose, times = pickle.loads(sent.value)
        automaton = _automaton(known)
        best, low = [[] for _ in range(items)], np.zeros(items, np.int64)  # heaps whose first is the worst
        for doc_id, text in rows:
            n, found, tf = _counted(automaton, text)
            if not len(found):
                continue
            gain = weight[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * (25 + 75 * n * n_docs // n_terms)))
            size = first[found + 1] - first[found]
            at = np.repeat(first[found] - np.cumsum(size) + size, size) + np.arange(size.sum())
            total = np.zeros(items, np.int64)
            np.add.at(total, whose[at], np.repeat(gain, size) * times[at])
            for item in np.flatnonzero((total > 0) & (total >= low)).tolist():
                entry, heap = (int(total[item]), doc_id is not None, -(doc_id or 0)), best[item]
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
                if len(heap) == top:
                    low[item] = heap[0][0]
        yield [(item, -i if known_id else None, s) for item, heap in enumerate(best) for s, known_id, i in heap]

    return _per_partition(docs, work, "item long, doc_id long, score long")


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of all items, terms as UTF-8; rows of one item_id are one item."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(f"({TERM})"), 1)).alias("term"))
    return words.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def rank_documents(documents: DataFrame, items: DataFrame, top: int = 10, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of (doc_id, text) for each item of (item_id, text) by a BM25-like score.

    Items are dealt by a hash into groups whose terms come to about ``group_bytes``; a group's terms make one automaton that each worker
    builds. A text is folded to terms between blanks, and a term counts where the automaton finds it with a blank on both sides.
    A first scan sums N, L and df; a second scores every document and hands on the best of its partition, so nothing of a
    document but ids and scores is shuffled. The last ranks are taken in SHARDS groups an item first.

    Null and empty texts have no term: such items get no rows and such documents are not counted. Rows of one item_id are one item; a
    null item_id is an item too. Rows that repeat a doc_id are documents of their own; a null doc_id comes last among equal
    scores. Without documents or items there are no rows. Other columns are ignored. A single item is not divided, so the longest item
    bounds the automaton from below.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = cut(_item_terms(items))
    size = terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    groups = -(-size // group_bytes)
    found = None
    for g in range(groups):
        rows = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).select("item_id", F.encode("term", "UTF-8").alias("term"), "times").collect()
        if not rows:
            continue
        ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i or 0))
        number, known = {i: k for k, i in enumerate(ids)}, sorted({bytes(r.term) for r in rows})
        place = {t: k for k, t in enumerate(known)}
        of_term: list[list[tuple[int, int]]] = [[] for _ in known]
        for r in rows:
            of_term[place[bytes(r.term)]].append((number[r.item_id], r.times))
        n_docs, n_terms, df = _statistics(docs, known)
        if not n_docs:
            break
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        best = _best(docs, known, weights, of_term, len(ids), top, n_docs, n_terms)
        listed = spark.createDataFrame([(k, i) for i, k in number.items()], "item long, item_id long")  # no longer than the group's terms
        best = best.join(F.broadcast(listed), "item").select("item_id", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    shard = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SHARDS))
    some = found.withColumn("shard", shard).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "shard").orderBy(*order))).where(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
            .where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score"))
