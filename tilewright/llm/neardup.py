"""Near-duplicate texts by MinHash: banded minima, signature verification, exact confirmation, connected components."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, per_row, release, small
from tilewright.llm.components import components
from tilewright.llm.shingles import mix, shingle_set

BANDS, ROWS = 32, 4
_U = np.uint64
_RNG = np.random.default_rng(75)
_A = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=_U) | _U(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=_U)
_ROW = (_RNG.integers(1, 2**63, ROWS, dtype=_U) | _U(1))
_BAND = _RNG.integers(1, 2**63, BANDS, dtype=_U)
# Two sets at the threshold agree in 96 of 128 minima on average; 70 is five and a half standard deviations below.
AGREE = 70


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of 128 universal hashes a * x + b over a set."""
    low = np.full(BANDS * ROWS, ~_U(0), _U)
    for at in range(0, len(shingles), 256):
        values = shingles[at:at + 256, None] * _A
        values += _B
        np.minimum(low, values.min(axis=0), out=low)
    return low


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One bucket key a band; two sets of similarity s share a given one with probability s ** 4, any with 1 - (1 - s ** 4) ** 32."""
    return mix((mix(minima).reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=_U) + _BAND)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _describe(doc_id, text):
    s = shingle_set(text)
    if not len(s):
        return [(doc_id, 0, None, None, None)]
    low = signature(s)
    return [(doc_id, len(s), _fingerprint(s), (low >> _U(48)).astype(np.uint16).view(np.int16).tolist(), band_keys(low).view(np.int64).tolist())]


def _same_set(id_, fp, text):
    s = shingle_set(text)
    return [(id_, s.view(np.int64).tolist())] if _fingerprint(s) == bytes(fp) else []


def _sets(docs: DataFrame, ids: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, shingles) of these classes; only texts of the document that stands for a class are read into Python."""
    wanted = cut(ids.distinct().join(classes.select("id", "first", "fp"), "id"))
    found = per_row(docs.join(small(wanted), docs["doc_id"] == wanted["first"]), _same_set, "id long, shingles array<long>", ["id", "fp", "text"])
    sets = cut(found.groupBy("id").agg(F.first("shingles").alias("shingles")))  # a document may be there twice
    release(wanted)
    return sets


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) that are linked: their signatures may reach the threshold, and their full sets do.

    Each side joins by its own id; a hub's pairs are rows of a few kilobytes that adaptive execution splits.
    """
    sig = classes.select("id", "sig")
    agree = F.aggregate(F.zip_with("s", "t", lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda a, b: a + b)
    likely = cut(pairs.join(sig.select(F.col("id").alias("v"), F.col("sig").alias("t")), "v")
                 .join(sig.select(F.col("id").alias("u"), F.col("sig").alias("s")), "u").where(agree >= AGREE).select("u", "v"))
    sets = _sets(docs, likely.select(F.explode(F.array("u", "v")).alias("id")), classes)
    met = (likely.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
           .join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u"))
    same, total = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    links = cut(met.where(100 * same >= 75 * (total - same)).select("u", "v"))
    release(likely, sets)
    return links


def _prefixes(sets: DataFrame) -> DataFrame:
    """(id, n, at, s): the n // 4 + 1 rarest shingles of each set, at 1, 2, ... in order; those no other set has are left out."""
    each = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("df"))
    order = F.array_sort(F.collect_list(F.struct("df", "s")))
    rarest = each.join(often, "s").groupBy("id", "n").agg(order.alias("o"))  # a set, as long as its text
    return (rarest.select("id", "n", F.posexplode(F.slice("o", 1, F.floor(F.col("n") / 4).cast("int") + 1)).alias("at", "o"))
            .where("o.df > 1").select("id", "n", (F.col("at") + 1).alias("at"), F.col("o.s").alias("s")))


def _open_pairs(members: DataFrame, comps: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that may be linked, of members of buckets whose members are not all connected yet.

    Only pairs that share a rare shingle meet. A link of sets of n <= m shingles needs 3 (n + m) / 7 in common, so at least 6 n / 7 and
    3 m / 4. In one order of all shingles, rarest first, two such sets share one of the n // 7 + 1 first of the smaller and the
    m // 4 + 1 first of the larger; and from the first shared one on there must be enough left of both.
    """
    placed = cut(members.join(comps.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root")))
    keys = cut(placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key"))
    ids = cut(placed.join(keys, "key", "left_semi").select("id", "root").distinct())
    release(placed, keys)
    if ids.isEmpty():
        return cut(ids.select(F.col("id").alias("u"), F.col("id").alias("v")))
    sets = _sets(docs, ids.select("id"), classes)
    first = cut(_prefixes(sets).join(ids, "id"))
    release(sets, ids)
    other = first.select("s", *(F.col(c).alias(f"{c}_y") for c in ("id", "n", "at", "root")))
    met = first.where("at <= floor(n / 7) + 1").join(other, "s").where(
        "(n < n_y or n = n_y and id < id_y) and 4 * n >= 3 * n_y and root != root_y and 7 * (1 + least(n - at, n_y - at_y)) >= 3 * (n + n_y)")
    pairs = cut(met.select(F.least("id", "id_y").alias("u"), F.greatest("id", "id_y").alias("v")).distinct())
    release(first)
    return pairs


def _connected(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, root) of all classes that a link reaches."""
    bands = classes.select("id", F.explode("bands").alias("key"))
    # tables of one row a key are cut before they meet the members, so that adaptive execution may split a hot key's members
    keys = cut(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    shared = cut(bands.join(keys, "key"))
    # the member that meets most others leads: in a group of edited copies this is the text closest to all
    meets = shared.groupBy("id").agg(F.sum("n").alias("meets"))
    leaders = cut(shared.join(meets, "id").groupBy("key").agg(F.min_by("id", F.struct(-F.col("meets"), F.col("id"))).alias("leader")))
    members = cut(shared.join(leaders, "key").where("id != leader").select("key", "leader", "id"))
    release(keys, shared, leaders)
    links = _linked(members.select(F.col("leader").alias("u"), F.col("id").alias("v")).distinct(), docs, classes)
    comps = components(links)
    release(links)
    pairs = _open_pairs(members, comps, docs, classes)
    release(members)
    more = _linked(pairs, docs, classes)
    release(pairs)
    if more.isEmpty():
        return comps
    whole = components(more.unionByName(comps.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    release(comps, more)
    return whole


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of (doc_id, text).

    Equal shingle sets form a class, and classes are the nodes that are linked. In each bucket all members are compared with one
    leader; members of buckets that are not connected by that are compared where they share a rare shingle (``_open_pairs``). So a group
    of thousands of copies costs rows in proportion to its size. Pairs are confirmed on full sets of 64-bit shingle hashes.

    Null and blank texts: no shingles, not linked, kept. Rows with a null doc_id: not linked, null component, kept. A
    doc_id on several rows: each row follows its own text, and a component has the smallest id on any of its rows. Other columns
    are ignored. An empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = cut(per_row(docs, _describe, "doc_id long, n_shingles long, fp binary, sig array<short>, bands array<long>", ["doc_id", "text"]))
    rows = cut(described.select("doc_id", "n_shingles", "fp"))
    usable = described.where("doc_id is not null and n_shingles > 0")
    # equal sets have equal signatures; the number is a class's from here on, because it is stored
    classes = cut(usable.groupBy("fp").agg(F.min("doc_id").alias("first"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
                  .withColumn("id", F.monotonically_increasing_id()))
    names = cut(classes.select("id", "fp", "first"))
    release(described)
    comps = _connected(docs, classes)
    release(classes)
    place = cut(names.join(comps.withColumnRenamed("node", "id"), "id", "left").select("fp", "first", F.coalesce("root", "id").alias("root")))
    release(names, comps)
    # cut for the same reason as the leaders: a large component's members may be split
    least = cut(place.groupBy("root").agg(F.min("first").alias("component_id")))
    out = rows.join(place.join(least, "root").select("fp", "component_id"), "fp", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
