"""Packing token pieces of documents into sequences of fixed size, as a cutting-stock problem over lengths."""

from __future__ import annotations

import base64
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.common import cut, per_row
from tilewright.llm.cutting import plan

SHARDS = 256
_encoders: dict[str, object] = {}
# Longer texts go to the reference encoder, whose time does not depend on how long a run without spaces is.
_LONG = 1_000_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _ranked(path: str):
    """The encoder of the rank file; ranks are the ids of the JSON vocabulary, and its one special token follows them."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={"<|endoftext|>": len(ranks)})
    return _encoders[path]


def _reference(path: str):
    if path not in _encoders:
        from tokenizers import Tokenizer

        _encoders[path] = Tokenizer.from_file(path)
    return _encoders[path]


def token_ids(text: str | None, json_path: str, ranks_path: str | None) -> np.ndarray:
    """Ids of a text, then id 0. With ``ranks_path`` the same ids come from the faster encoder of the same vocabulary."""
    text = text or ""
    if ranks_path and len(text) <= _LONG:
        ids = _ranked(ranks_path).encode_to_numpy(text, allowed_special="all")
    else:
        ids = _reference(json_path).encode(text, add_special_tokens=False).ids
    return np.append(np.asarray(ids, dtype="<u4"), np.uint32(0)).astype("<u4")


def cuts(n: int, size: int, grain: int) -> list[int]:
    """Where the pieces of n tokens start: whole sequences, a multiple of ``grain``, and what remains."""
    rest = n - n % size
    return [*range(0, rest, size), *([rest] if n - rest >= grain else []), *([n - n % size % grain] if n % size % grain else [])]


def pieces(documents: DataFrame, size: int, grain: int, json_path: str, ranks_path: str | None, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of each piece."""
    def split(doc_id, text):
        ids = token_ids(text, json_path, ranks_path)
        starts = cuts(len(ids), size, grain)
        for start, end in zip(starts, [*starts[1:], len(ids)]):
            part = ids[start:end]
            row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
            yield row + (part.tolist(),) if with_ids else row

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<long>" if with_ids else "")
    return per_row(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), split, schema, ["doc_id", "text"])


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with a rank from 0 within each length, in order of shard, document and start.

    A length that a third of all pieces has (copies) is numbered in SHARDS groups, whose first ranks come from their counts.
    """
    sharded = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SHARDS)))
    counts = sharded.groupBy("length", "shard").count()
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "shard").orderBy("doc_id", "start", "ids_crc32")
    # at most size x SHARDS rows, so this side may be broadcast
    return (sharded.withColumn("n", F.row_number().over(within) - 1).join(F.broadcast(first), ["length", "shard"])
            .withColumn("rank", F.col("first") + F.col("n")).drop("shard", "n", "first"))


def pack(documents: DataFrame, size: int = 1024, json_path: str | None = None, ranks_path: str | None = None,
         grain: int = 32, rounds: int = 2000, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; no sequence exceeds ``size``, and pieces lie in it without gaps.

    The histogram of piece lengths (at most ``size`` numbers) goes to the driver, which solves the linear program over
    patterns; its plan of a few thousand ranges is joined to the ranked pieces. Cutting tails at a multiple of ``grain``
    leaves so few different lengths that the program is solved to its end, and small pieces to fill every sequence with.

    Null and empty texts give one piece with id 0 alone. Rows that repeat a doc_id, or lack it, are packed as they are.
    An empty table gives no rows.
    """
    json_path = json_path or vocabulary_path("byte_bpe_50k.json")
    ranks_path = ranks_path or vocabulary_path("byte_bpe_50k.tiktoken")
    parts = cut(pieces(documents, size, grain, json_path, ranks_path, with_ids))
    demand = np.zeros(size + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():
        demand[length] = n
    spark = documents.sparkSession
    ranges = spark.createDataFrame(plan(demand, size, rounds),
                                   "length long, lo long, hi long, share long, first_sequence long, first_offset long")
    at = F.col("rank") - F.col("lo")
    placed = ranked(parts).alias("p").join(F.broadcast(ranges.alias("r")), "length").where("rank >= lo and rank < hi")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("first_sequence") + F.floor(at / F.col("share"))).alias("sequence_id"),
                         (F.col("first_offset") + at % F.col("share") * F.col("length")).alias("offset"),
                         *(["ids"] if with_ids else []))
