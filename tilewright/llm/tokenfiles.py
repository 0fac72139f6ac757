"""Token ids of documents in files of Huffman-coded blocks, written in order of doc_id and read back block by block.

A folder holds three tables. ``codes`` has the code length of every id that occurs; lengths alone give the canonical codes. ``blocks``
has one row a block: the part it lies in, the number of its first id there, the doc_ids and token counts of its documents, its
bits, and as checkpoints the bit at which every 256th id of a document starts, its first included. A block needs no other block, and
any checkpoint is a place to start. ``parts`` has the number of ids in all parts before each one, parts being ranges of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.llm.common import small_batches
from tilewright.llm.huffman import LIMIT, STRIDE, Codec, code_lengths, lanes
from tilewright.llm.packing import token_ids, vocabulary_path

BLOCK_IDS = 1 << 16
# Ids a part should have; it bounds how long one task writes.
PART_IDS = 1 << 25
_BLOCK = ("part int, first_id long, n_ids long, doc_ids array<long>, doc_tokens array<long>, checkpoints array<long>, bits binary")
_READ = "part int, first_id long, doc_id long, n_tokens long, ids binary"
_codecs: dict[bytes, Codec] = {}


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _codec(lengths: bytes) -> Codec:
    """One codec a worker is kept."""
    if lengths not in _codecs:
        _codecs.clear()
        _codecs[lengths] = Codec(np.frombuffer(lengths, np.uint8))
    return _codecs[lengths]


def _tokens(documents: DataFrame, end_id: int, json_path: str, ranks_path: str | None) -> DataFrame:
    """doc_id, n and ids (little-endian 32 bits) of each document, its end id included; a task's last row, with a null n, has the
    ids it has ``seen`` and how many ``times``."""
    arrow = _arrow(schema := "doc_id long, n long, ids binary, seen array<long>, times array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [token_ids(text, json_path, ranks_path) for text in part.column("text").to_pylist()]
                for ids in found:
                    ids[-1] = end_id
                counts = np.bincount(np.concatenate(found))
                if len(counts) > len(total):
                    total = np.concatenate((total, np.zeros(len(counts) - len(total), np.int64)))
                total[:len(counts)] += counts
                none = [None] * len(found)
                rows = [part.column("doc_id"), [len(ids) for ids in found], [ids.tobytes() for ids in found], none, none]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, arrow.types)], names=arrow.names)
        known = np.flatnonzero(total)
        rows = [[None], [None], [None], [known], [total[known]]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, arrow.types)], names=arrow.names)

    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, schema)


def _encoded(rows: DataFrame, lengths: bytes) -> DataFrame:
    """doc_id, n, bits and checkpoints of each document."""
    arrow = _arrow(schema := "doc_id long, n long, bits binary, checkpoints array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(lengths)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                counts = part.column("n").to_numpy()
                ids = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in part.column("ids")])
                data, stops, checkpoints = codec.encode(ids, np.cumsum(counts))
                own = np.split(checkpoints, np.cumsum(-(-counts // STRIDE))[:-1])
                bits = [data[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops)]
                rows = [part.column("doc_id"), counts, bits, own]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, arrow.types)], names=arrow.names)

    return rows.select("doc_id", "n", "ids").mapInArrow(run, schema)


def _blocks(parts: DataFrame, block_ids: int) -> DataFrame:
    """Blocks of encoded documents that are already dealt to parts and sorted."""
    arrow, columns = _arrow(_BLOCK), ["part", "doc_id", "n", "bits", "checkpoints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, docs, held = 0, [], 0
        number = None

        def give() -> pa.RecordBatch:
            base = 8 * np.cumsum([0, *(len(d[2]) for d in docs[:-1])])
            checkpoints = np.concatenate([b + np.array(d[3], np.int64) for b, d in zip(base, docs)])
            row = (number, first, held, [d[0] for d in docs], [d[1] for d in docs], checkpoints, b"".join(d[2] for d in docs))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, arrow.types)], names=arrow.names)

        for batch in batches:
            for at in range(0, batch.num_rows, 16):  # few documents are Python objects at once
                for number, *doc in zip(*(batch.slice(at, 16).column(c).to_pylist() for c in columns)):
                    docs.append(doc)
                    held += doc[1]
                    if held >= block_ids:
                        yield give()
                        first, docs, held = first + held, [], 0
        if docs:
            yield give()

    return parts.select(*columns).mapInArrow(run, _BLOCK)


def _delete(spark: SparkSession, folder: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_token_files(documents: DataFrame, path: str, end_id: int = 2, json_path: str | None = None, ranks_path: str | None = None,
                      limit: int = LIMIT, block_ids: int = BLOCK_IDS, part_ids: int = PART_IDS) -> None:
    """Encode every text of (doc_id, text), ``end_id`` behind it, and write the ids to ``path`` in ascending order of doc_id, nulls last.

    Texts are tokenised once, into a table beside the blocks that goes again when its documents are encoded; only encoded documents
    are shuffled. Counts of ids over all documents give the code; the driver sees no more than one count an id of the vocabulary. Ranges
    of (doc_id, row) make the parts, so rows of one id may be divided. Rows that repeat an id are documents of their own, in any
    order if they differ.

    Null and empty texts are the end id alone. A document is not divided between blocks, so the longest one bounds a block. An empty table
    gives empty tables. Other columns are ignored.
    """
    spark, path = documents.sparkSession, path.rstrip("/")
    json_path = json_path or vocabulary_path("byte_bpe_50k.json")
    ranks_path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    _tokens(documents, end_id, json_path, ranks_path).write.option("compression", "zstd").parquet(f"{path}/tokens")
    rows = spark.read.parquet(f"{path}/tokens")
    seen = rows.where("n IS NULL").select(F.explode(F.arrays_zip("seen", "times")).alias("s")).groupBy("s.seen").agg(F.sum("s.times").alias("n")).collect()
    counts = np.zeros(max((r.seen for r in seen), default=0) + 1, np.int64)
    for i, n in seen:
        counts[i] = n
    lengths = code_lengths(counts, limit)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int").coalesce(1) \
        .write.parquet(f"{path}/codes")
    _encoded(rows.where("n IS NOT NULL"), lengths.astype(np.uint8).tobytes()).withColumn("row", F.monotonically_increasing_id()) \
        .write.option("compression", "uncompressed").parquet(f"{path}/encoded")
    _delete(spark, f"{path}/tokens")
    n_parts = max(1, -(-int(counts.sum()) // part_ids), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")]
    parts = spark.read.parquet(f"{path}/encoded").repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    _blocks(parts.withColumn("part", F.spark_partition_id()), block_ids).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    _delete(spark, f"{path}/encoded")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))  # as many rows as parts
    sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).coalesce(1).write.parquet(f"{path}/parts")


def _lengths(spark: SparkSession, path: str) -> bytes:
    codes = spark.read.parquet(f"{path.rstrip('/')}/codes").collect()  # no longer than the vocabulary
    table = np.zeros(max((i for i, _ in codes), default=0) + 1, np.uint8)
    for i, n in codes:
        table[i] = n
    return table.tobytes()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32 bits) of each document in the files, every block decoded on its own.

    ``start`` is the number of ids of all documents before it.
    """
    path, arrow, lengths = path.rstrip("/"), _arrow(_READ), _lengths(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(lengths)
        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.slice(at, 1).to_pylist()[0]
                sizes = np.array(block["doc_tokens"], np.int64)
                ids = codec.decode(block["bits"], np.array(block["checkpoints"], np.int64), lanes(sizes)).astype("<u4")
                ends = np.cumsum(sizes)
                columns = [[block["part"]] * len(sizes), (block["first_id"] + ends - sizes), block["doc_ids"], sizes,
                           [ids[e - n:e].tobytes() for e, n in zip(ends, sizes)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], names=arrow.names)

    small_batches(spark)
    found = spark.read.parquet(f"{path}/blocks").mapInArrow(run, _READ)
    return found.join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part") \
        .select("doc_id", (F.col("before") + F.col("first_id")).alias("start"), "n_tokens", "ids")


def read_id_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(position, ids) of the ids from place ``start`` up to ``stop`` among all ids of the files, a row a block, in any order.

    Only blocks that hold some of them are read, and of each only stretches behind checkpoints that do.
    """
    path, arrow, lengths = path.rstrip("/"), _arrow(schema := "position long, ids binary"), _lengths(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(lengths)
        for batch in batches:
            for block in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                sizes = lanes(np.array(block["doc_tokens"], np.int64))
                ends = block["first_id"] + np.cumsum(sizes)
                wanted = np.flatnonzero((ends > start) & (ends - sizes < stop))
                first = int(ends[wanted[0]] - sizes[wanted[0]])
                ids = codec.decode(block["bits"], np.array(block["checkpoints"], np.int64)[wanted], sizes[wanted]).astype("<u4")
                part = slice(max(0, start - first), stop - first)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([first + part.start], [ids[part].tobytes()]), arrow.types)], names=arrow.names)

    placed = spark.read.parquet(f"{path}/blocks").join(F.broadcast(spark.read.parquet(f"{path}/parts")), "part").withColumn("first_id", F.col("before") + F.col("first_id"))
    held = placed.where((F.col("first_id") < stop) & (F.col("first_id") + F.col("n_ids") > start) & (F.lit(start) < stop))
    return held.select("first_id", "doc_tokens", "checkpoints", "bits").mapInArrow(run, schema)


def with_crc32(read: DataFrame, column: str = "ids") -> DataFrame:
    """``read`` with ``ids_crc32`` in place of the ids."""
    return read.withColumn("ids_crc32", F.crc32(column)).drop(column)
