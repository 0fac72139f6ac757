"""Near duplicates where ids repeat, and pages of one template that share buckets without being alike."""

import random

from pyspark.sql import functions as F

from test_texts import near_expected, roots, shingles
from tilewright.llm import neardup as N
from tilewright.llm.common import cut
from tilewright.llm.components import components


def test_each_text_of_a_repeated_id_keeps_its_links(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (3, a + " more"), (4, "other words entirely"), (None, a)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, 36, 1, True), (1, 36, 1, True), (2, 37, 1, False), (3, 37, 1, False), (3, 37, 1, False), (4, 1, 4, True), (None, 36, None, True)], key=str)


def template_pages(n, seed=5):
    """Pages of one frame whose own part, a fifth to a third of them, is made of a few hundred sentences."""
    rng = random.Random(seed)
    frame = [f"frame{i}" for i in range(160)]
    sentences = [[f"s{k}w{j}" for j in range(8)] for k in range(300)]
    pages = []
    for k in range(n):
        own = [w for _ in range(rng.randrange(5, 11)) for w in rng.choice(sentences)]
        pages.append((k, " ".join(frame[:80] + own + frame[80:])))
    return pages


def test_template_pages_meet_in_few_pairs(spark):
    rows = template_pages(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    described = N.per_row(docs, N._describe, "doc_id long, n_shingles long, fp binary, sig array<short>, bands array<long>", ["doc_id", "text"])
    classes = cut(described.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("first"), "fp", "sig", "bands"))
    bands = classes.select("id", F.explode("bands").alias("key"))
    leaders = bands.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = cut(bands.join(leaders, "key").where("id != leader").select("key", "leader", "id"))
    none = components(spark.createDataFrame([], "u long, v long"))
    pairs = {tuple(r) for r in N._open_pairs(members, none, docs, classes).collect()}
    every = len(rows) * (len(rows) - 1) // 2
    met = members.join(members.select("key", F.col("id").alias("other")), "key").where("id < other").select("id", "other").distinct().count()
    sets = {i: shingles(t) for i, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert met > 0.2 * every and len(pairs) < 0.05 * every
    buckets = members.groupBy("id").agg(F.collect_set("key").alias("k")).collect()
    keys = {r.id: set(r.k) for r in buckets}
    assert {(a, b) for a, b in links if a in keys and b in keys and keys[a] & keys[b]} <= pairs
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs).collect()}
    assert got == roots(links, sets) == near_expected(rows)


def test_intermediate_files_are_deleted(spark, tmp_path):
    rows = template_pages(60) + [(1000 + k, "a b c d e f g h " * 9 + f"x{k % 3}") for k in range(30)]
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        left = {p.parent.name for p in tmp_path.rglob("part-*")}
        assert out.count() == len(rows) and len(left) <= 4, left  # rows, places and least ids are read later
    finally:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "after"))
