"""The training-data pipeline: STAGES in order, each on all rows its predecessor kept.

All stages but the last return the columns they got. Decisions are made and applied by row, so null and repeated doc_ids hide nothing. An
empty table gives no rows in any stage.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tilewright
from tilewright.llm.common import cut, small, table
from tilewright.llm.mixing import take
from tilewright.llm.neardup import near_duplicates
from tilewright.llm.packing import pack
from tilewright.llm.secrets import redact_secrets
from tilewright.llm.toxicity import score_toxicity
from tilewright.session import ship


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _without(docs: DataFrame, keys: DataFrame, by: str) -> DataFrame:
    """``docs`` but for these keys, whose list is broadcast only if a count shows it to be short."""
    return docs.join(small(cut(keys.select(by).distinct())), by, "left_anti")


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a key ``__row`` of doc_id and text, and the checkpointed (__row, doc_id) of each row.

    The key is a hash, so it is the same in every pass and texts need no copy; its seed is the first that gives no two different
    (doc_id, text) one key, as full digests show. Rows that are alike in both share a key.
    """
    doc_id, seed = F.col("doc_id").cast("long"), 0
    while True:
        keyed = docs.withColumn("__row", F.xxhash64(F.lit(seed), doc_id, doc_id.isNull(), "text", F.col("text").isNull()))
        ids = cut(keyed.select("__row", doc_id.alias("doc_id"), F.struct(doc_id, F.col("text").isNull(), _digest(F.col("text"))).alias("all")))
        if ids.groupBy("__row").agg((F.min("all") != F.max("all")).alias("clash")).where("clash").isEmpty():
            return keyed, ids.drop("all")
        seed += 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go. Its score is one of the text alone, so the digest of the text is the key."""
    keyed = docs.withColumn("__text", _digest(F.col("text")))
    scored = score_toxicity(keyed, table(spark, sf_dir, "labels"), keep=("__text",))
    return _without(keyed, scored.where("predicted = 1"), "__text").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, that of the smallest doc_id, nulls last. Texts without words are in no group and stay."""
    keyed, ids = _keyed(docs)
    placed = near_duplicates(keyed.select(F.col("__row").alias("doc_id"), "text")).where("n_shingles > 0")
    rows = cut(placed.groupBy(F.col("doc_id").alias("__row"), "component_id").agg(F.count("*").alias("copies")).join(ids.distinct(), "__row"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    stay = cut(rows.groupBy("component_id").agg(F.min_by(F.struct("__row", "copies"), order).alias("s")).select("s.*"))
    # of rows alike in doc_id and text one is chosen by the other columns; only their texts are shuffled
    twins = cut(stay.where("copies > 1").select("__row"))
    out = _without(keyed, rows.select("__row").join(stay.where("copies = 1"), "__row", "left_anti"), "__row").select(*docs.columns)
    if twins.isEmpty():
        return out
    others = F.to_json(F.struct(*(c for c in docs.columns if c != "text")))
    one = keyed.join(small(twins), "__row", "left_semi").groupBy("__row").agg(F.min_by(F.struct(*docs.columns), others).alias("d"))
    return out.unionByName(one.select("d.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, null texts and repeated rows too; what is found in a text is replaced by a mark."""
    return redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that each source's words come to its target. Rows without words stay once; rows that are
    alike, or lack an id, are taken one after the other."""
    return take(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in sequences of 1024. A null or empty text is one piece; repeated rows are packed each."""
    return pack(docs)


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark, str(Path(tilewright.__file__).resolve().parent))
        return stage(spark, docs, sf_dir)

    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES = [(name, _shipped(stage)) for name, stage in (("toxicity", drop_toxic), ("near-duplicates", drop_near_duplicates), ("secrets", mask_secrets),
                                                      ("mixing", mix_sources), ("packing", pack_tokens))]
# Trees and token ids have no SQL form; tests/llm holds run() against plain stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the checkpointed rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs if name == STAGES[0][0] else cut(docs), sf_dir)
    return docs
