"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.common import BLANK, WORD, cut, small

SEED = "mix-1"
WEIGHTS = (3, 1, 2)
# Rows a group within a source should have; it decides how many leading hexadecimal digits of the order make a group.
GROUP_ROWS = 500_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _placed(sources: DataFrame) -> DataFrame:
    """``sources`` with their place by code point, nulls last, from 0: counted within ranges, which start from the counts before."""
    dealt = cut(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    first = dealt.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return dealt.withColumn("n", F.row_number().over(within) - 1).join(F.broadcast(first), "range").withColumn("place", F.col("first") + F.col("n")).drop("range", "first", "n")


def source_targets(sizes: DataFrame, share: float, epochs: int, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target for each source of (source, size) rows.

    All targets sum to ``share`` of all sizes (less where even ``epochs`` times every size is less). Each round gives a source
    its weight's part of what is left, clamps those whose cap that reaches, and shares their excess among the rest; it ends when
    no further source is clamped. The driver sees two sums a round, and rounds are at most as many as sources, in practice few.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1).cast("double")
    sources = cut(_placed(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(epochs))))
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        reached = F.col("cap") <= F.lit(level) * F.col("weight")
        n, held, open_weight = sources.agg(F.sum(reached.cast("int")), F.sum(F.when(reached, F.col("cap")).otherwise(0.0)),
                                           F.sum(F.when(reached, 0.0).otherwise(F.col("weight")))).first()
        if n in (None, clamped) or not open_weight:
            break
        level, clamped = (total - held) / open_weight, n
    return sources.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _order(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _tie(documents: DataFrame) -> Column:
    """A hash of the whole row, the order of rows of one doc_id and size; rows that share it are alike."""
    return F.xxhash64("text", F.to_json(F.struct(*(c for c in documents.columns if c != "text"))))


def _amounts(documents: DataFrame, share: float, epochs: int, seed: str) -> DataFrame:
    """doc_id, source, size, source_size, target, order, tie, whole (repetitions) and some (words of the fractional one)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), _order(seed).alias("order"),
                            _tie(documents).alias("tie"))
    rows = cut(rows)
    total, digits = rows.count(), 1
    while total > GROUP_ROWS * 16 ** digits:  # a source may have most of them
        digits += 1
    rows = rows.withColumn("part", F.substring("order", 1, digits))
    targets = source_targets(rows.select("source", "size"), share, epochs)
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
    offsets = parts.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))) \
        .select(F.col("p.source").alias("s"), F.col("part").alias("p"), "first", "source_size", "target")
    within = Window.partitionBy("source", "part").orderBy("order", F.col("doc_id").asc_nulls_first(), "size", "tie") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # a row a group; with many sources the join shuffles instead
    joined = rows.join(small(cut(offsets)), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target")).cast("long") - whole * F.col("source_size")
    some = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("first") - F.col("inside")))
    return joined.select("doc_id", "source", "size", "source_size", "target", "order", "tie", whole.alias("whole"), some.alias("some"))


def mix(documents: DataFrame, share: float = 1.5, epochs: int = 2, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of (doc_id, text, source).

    With r = target / source_size every document is taken floor(r) times whole. The fractional repetition goes through a
    source in the order of the MD5 of seed and doc_id until its words are reached; the last document is taken in part. Running
    sums are made within groups of equal leading digits and start from sums of the groups before, so that no source is one
    task's work. The same input gives the same rows.

    A null text has size 0, a null source is a source of its own, last in order. Null doc_ids come first in the order; rows that
    repeat a doc_id are taken one after the other, smaller sizes first and then by a hash of the row. Sources without words have target 0.
    An empty table gives no rows; other columns only tell rows of one id apart.
    """
    amounts = _amounts(documents, share, epochs, seed)
    return amounts.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("some")).cast("long").alias("taken"))


def take(documents: DataFrame, share: float = 1.5, epochs: int = 2, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of ``documents``, each as often as it is taken whole, and once cut to its first words for the rest.

    All a row needs is its source's number of whole repetitions and the place in the order where the fractional one ends, one
    row a source; so texts are not shuffled. ``n_chars``, where there is one, counts a cut text anew. Documents not taken go;
    those without words stay once, as nothing of them can be taken. Rows alike in all columns share a place: where a source
    ends among some, one of them is repeated as often as their words reach, and cut once for the rest.
    """
    amounts = cut(_amounts(documents, share, epochs, seed))
    place = F.struct("order", "size", "tie")
    ends = amounts.groupBy("source").agg(F.first("whole").cast("int").alias("__whole"), F.min(F.when(F.col("some") < F.col("size"), place)).alias("__end"))
    ends = ends.withColumnRenamed("source", "__source")
    here = amounts.join(small(cut(ends.select("__source", "__end"))), F.col("source").eqNullSafe(F.col("__source")) & (place == F.col("__end")))
    here = here.groupBy("__source").agg(F.sum("some").alias("__some"), F.count("*").alias("__alike")).withColumnRenamed("__source", "__at")
    ends = cut(ends.join(here, F.col("__source").eqNullSafe(F.col("__at")), "left").drop("__at"))
    shared = not ends.where("__alike > 1").isEmpty()
    rows = documents.join(small(ends), F.col("source").eqNullSafe(F.col("__source")))
    words = F.filter(F.split("text", f"[{BLANK}]+"), lambda w: w != "")
    at, size, tie = _order(seed), word_count(F.col("text")), _tie(documents)
    # only rows of the doc_id at which the source ends need more than its hash
    same = (at == F.col("__end.order")) & (size == F.col("__end.size"))
    full = F.col("__end").isNull() | (at < F.col("__end.order")) | ((at == F.col("__end.order")) & (
        (size < F.col("__end.size")) | ((size == F.col("__end.size")) & (tie < F.col("__end.tie")))))
    ending = same & (tie == F.col("__end.tie"))
    part = F.when(ending & (F.col("__alike") == 1), F.col("__some").cast("int")).otherwise(0)
    copies = F.when(size == 0, F.array(F.lit(0))).otherwise(F.concat(
        F.array_repeat(F.lit(0), F.col("__whole") + F.coalesce(full, F.lit(False)).cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>"))))
    if shared:
        one = rows.where(ending & (F.col("__alike") > 1)).groupBy("__source").agg(
            F.first(F.struct(*documents.columns)).alias("d"), F.first("__some").alias("__some"), F.first("__end.size").alias("__size"))
        one = one.select("d.*", F.concat(F.array_repeat(F.lit(0), F.floor(F.col("__some") / F.col("__size")).cast("int")), F.when(
            F.col("__some") % F.col("__size") > 0, F.array((F.col("__some") % F.col("__size")).cast("int"))).otherwise(F.array().cast("array<int>"))).alias("__copies"))
    rows = rows.select(*documents.columns, copies.alias("__copies"))
    rows = rows.unionByName(one) if shared else rows
    rows = rows.withColumn("__cut", F.explode("__copies"))
    some = F.col("__cut") > 0
    out = rows.withColumn("text", F.when(some, F.array_join(F.slice(words, 1, F.col("__cut")), " ")).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast(dict(documents.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
