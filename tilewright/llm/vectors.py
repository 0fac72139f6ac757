"""Near-duplicate vectors through a pivot-permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, release, small_batches
from tilewright.llm.components import components

# Vectors of a block, two of which make a task; products are made TILE by TILE of them.
BLOCK, TILE = 2048, 512
MAX_PIVOTS = 4096
# Pivots of larger cosine would order vectors near both by chance.
APART = 0.5


def _unit(x: np.ndarray) -> np.ndarray:
    """The vector scaled to length 1 in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max()  # so that very large or small components neither overflow nor vanish
    return x / np.sqrt(x @ x)


def _compact(v: pa.ListScalar) -> bytes | None:
    """The components as single precision numbers if they are such, else as doubles; None where the vector can't link."""
    values = v.values
    if values is None or values.null_count or not len(values):
        return None
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(x).all() or not np.abs(x).max() > 0:
        return None
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return (single if (single == x).all() else x).tobytes()


def _expanded(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * dim else np.float64)


def _units(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, raw, and unit as a key of equal directions: null where the vector can't link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable = batch.column("usable").to_pylist()
            raws = [_compact(v) if u else None for v, u in zip(batch.column("embedding"), usable)]
            dims = [None if r is None else len(v.values) for r, v in zip(raws, batch.column("embedding"))]
            units = [None if r is None else _unit(_expanded(r, d)).tobytes() for r, d in zip(raws, dims)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(raws, pa.binary()),
                                              pa.array(units, pa.binary())], names=["vec_id", "label", "dim", "raw", "unit"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding",
                          (F.col("vec_id").isNotNull() & F.col("label").isNotNull()).alias("usable"))
    small_batches(vectors.sparkSession)
    # single precision numbers are all the shuffles below carry; the unit vector is a key of classes only, as its hash
    return rows.mapInArrow(run, "vec_id long, label string, dim int, raw binary, unit binary").withColumn("unit", F.unhex(F.sha2("unit", 256)))


def _permutations(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """Adds ``perm``: positions of the nearest pivots of the vector's own dimension, nearest first; [0] where there are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = [_unit(_expanded(r, d)) for r, d in zip(part.column("raw").to_pylist(), part.column("dim").to_pylist())]
                perm = [[0]] * len(vectors)
                for dim in {len(v) for v in vectors} & set(pivots):
                    rows = [i for i, v in enumerate(vectors) if len(v) == dim]
                    near = np.argsort(-(np.array([vectors[i] for i in rows]) @ pivots[dim].T), axis=1, kind="stable")[:, :nearest]
                    for i, p in zip(rows, near.tolist()):
                        perm[i] = p
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(perm, pa.list_(pa.int32()))], names=[*part.schema.names, "perm"])

    return classes.mapInArrow(run, "id long, label string, dim int, raw binary, copies long, perm array<int>")


def _block_links(threshold: float, shared: int):
    """Links inside one block pair of one pivot's list: what each class has, and a smaller one it reaches."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim, rank, lo, hi = int(key[1]), int(key[2]), int(key[3]), int(key[4])
        rows = rows.sort_values("block", kind="stable")
        perms = [np.asarray(p) for p in rows["ranks"]]
        columns = {r: k for k, r in enumerate(sorted({int(r) for p in perms for r in p}))}
        has = np.zeros((len(rows), len(columns)), np.float32)
        for i, p in enumerate(perms):
            has[i, [columns[int(r)] for r in p]] = 1
        units = np.array([_unit(_expanded(r, dim)) for r in rows["raw"]])
        ids, copies, block = rows["id"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        k, own = columns[rank], has.sum(1)  # a pair belongs to the list of the first pivot that both have
        links, root, pairs = np.zeros(len(rows), np.int64), ids.copy(), []
        split = int((block == lo).sum())
        second = (0, split) if lo == hi else (split, len(rows))
        for i in range(0, split, TILE):
            a = slice(i, min(i + TILE, split))
            for j in range(i if lo == hi else second[0], second[1], TILE):
                b = slice(j, min(j + TILE, second[1]))
                enough = np.minimum(shared, np.minimum(own[a][:, None], own[b][None]))
                linked = (has[a] @ has[b].T >= enough) & (units[a] @ units[b].T >= threshold) & (has[a][:, :k] @ has[b][:, :k].T == 0)
                linked &= ids[a][:, None] != ids[b][None]
                if linked.any():
                    links[a] += linked @ copies[b]
                    if i != j:
                        links[b] += linked.T @ copies[a]
                    pairs.append((a, b, np.packbits(linked)))
        far = np.iinfo(np.int64).max
        while True:
            before = root.copy()
            for a, b, bits in pairs:
                shape = (a.stop - a.start, b.stop - b.start)
                linked = np.unpackbits(bits, count=shape[0] * shape[1]).reshape(shape).astype(bool)
                root[a] = np.minimum(root[a], np.where(linked, root[b][None], far).min(axis=1, initial=far))
                root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], far).min(axis=0, initial=far))
            if (before == root).all():
                break
        keep = links > 0
        return pd.DataFrame({"id": ids[keep], "links": links[keep], "root": root[keep]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, nearest: int = 8, shared: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding, label).

    Vectors of a label that are equal up to their length form a class. Four times the square root of the number of
    classes, MAX_PIVOTS at most, serve as pivots: of twice as many taken by a hash of their id, those apart from the ones
    before. A vector is described by its ``nearest``
    pivots in order. Vectors with ``shared`` of them in common are compared; rarest pivots first, two such vectors always
    meet in one of the first ``nearest - shared + 1``, so only those lists are made. A long list is cut into blocks of about
    BLOCK vectors and each pair of blocks is one small product, so no list is one task's work. All that leaves a block is a
    count and one smaller neighbour for each of its vectors, not its pairs.

    Null, zero and non-finite vectors, null labels and null ids: no links, their own component. A vec_id on several rows:
    each row has the links and the component of its own vector, and other rows of the id count as any vector. Vectors of
    different dimension never link. Other columns are ignored. An empty table gives no rows.
    """
    units = cut(_units(vectors))
    classes = units.where("unit is not null").groupBy("label", "dim", "unit").agg(F.first("raw").alias("raw"), F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    n = classes.count()
    m = min(MAX_PIVOTS, max(64, 4 * math.isqrt(n)))
    pivots: dict[int, list] = {}
    for raw, dim in classes.orderBy(F.xxhash64("rep", "label"), "rep", "label", "unit").limit(2 * m).select("raw", "dim").collect():
        x = _unit(_expanded(raw, dim))
        chosen = pivots.setdefault(len(x), [])
        if sum(map(len, pivots.values())) < m and (not chosen or (np.array(chosen) @ x).max() <= APART):
            chosen.append(x)
    perms = cut(_permutations(classes.select("id", "label", "dim", "raw", "copies"), {d: np.array(p) for d, p in pivots.items()}, nearest))
    # the driver sees one count a pivot
    counts = {p: c for p, c in perms.select(F.explode("perm").alias("p")).groupBy("p").count().collect()}
    order = {p: r for r, p in enumerate(sorted(range(m), key=lambda p: (counts.get(p, 0), p)))}
    ranks = F.split(F.lit(",".join(str(order[p]) for p in range(m))), ",").cast("array<int>")
    ranked = perms.withColumn("ranks", F.array_sort(F.transform("perm", lambda p: F.element_at(ranks, p + 1)))).drop("perm")
    first = F.slice("ranks", 1, F.greatest(F.lit(1), F.size("ranks") - shared + 1))
    lists = cut(ranked.withColumn("rank", F.explode(first)))
    release(perms)
    blocks = lists.groupBy("label", "dim", "rank").count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    member = lists.join(blocks, ["label", "dim", "rank"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tasks = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["label", "dim", "rank", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")]
    tasks = tasks.select(*keys, "block", "id", "raw", "copies", "ranks")
    found = cut(tasks.groupBy("label", "dim", "rank", "lo", "hi").applyInPandas(_block_links(threshold, shared), "id long, links long, root long"))
    release(lists)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("id").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "id")
    known = (classes.select("id", "label", "dim", "unit", "rep", "copies").join(links, "id", "left").join(comps, "id", "left")
             .withColumn("root", F.coalesce("root", "id")))
    least = known.groupBy("root").agg(F.min("rep").alias("component"))
    known = known.join(least, "root").select("label", "unit", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = units.join(known, ["label", "unit"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                              F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
