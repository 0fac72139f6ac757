"""Paging by key, the index of text pieces, and classes counted on blocks."""

import random

import numpy as np
from pyspark.sql import functions as F

from test_tiles import blocks_of, scratch
from tilewright.functions.pixels import classify_ranges, is_valid
from tilewright.functions.text import contains_any
from tilewright.operators import blocks as B, catalog as K, pixels as P


def test_pages_by_key_equal_pages_by_offset(spark):
    rows = [(7 if k % 3 else 8, 1000 - k, 20200000000000 + (k * 37 % 40)) for k in range(150)]
    items = spark.createDataFrame(rows, "pid int, fid long, hcol long")
    for ascending in (True, False):
        last, page = None, 0
        while True:
            mine = [(r.hcol, r.fid) for r in K.item_page_after(items, 7, 17, last, ascending).collect()]
            assert mine == [(r.hcol, r.fid) for r in K.item_page(items, 7, page, 17, ascending).collect()]
            if not mine:
                break
            last, page = mine[-1], page + 1
        assert page == 6


def test_the_bound_of_a_page_reaches_the_scan(spark):
    path = scratch("items")
    spark.createDataFrame([(7, k, k) for k in range(50)], "pid int, fid long, hcol long").write.mode("overwrite").parquet(path)
    page = K.item_page_after(spark.read.parquet(path), 7, 5, (30, 2))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(hcol,30)" in plan and "TakeOrderedAndProject" in plan
    assert [r.hcol for r in page.collect()] == [30, 31, 32, 33, 34]


def test_indexed_search_equals_the_scan(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abAB é%_") for _ in range(rng.randrange(0, 14))) for _ in range(300)] + [None, "", "ab", "ABAB", "a_b%é"]
    table = spark.createDataFrame([(k, n, names[-1 - k]) for k, n in enumerate(names)], "id int, name string, other string").cache()
    index = K.text_index(table, "id", ["name", "other"]).cache()
    words = {"", "a", "é", "ab", "AB", "zzz", "%", "_b"} | {"".join(rng.choice("abAB é%_") for _ in range(n)) for n in range(1, 9) for _ in range(3)}
    words |= {n[1:5] for n in names[:12] if n}
    texts = [F.col("name"), F.col("other")]
    for word in words:
        want = sorted(r.id for r in table.where(contains_any(texts, word)).collect())
        assert sorted(r.id for r in K.search_indexed(table, index, "id", ["name", "other"], word).collect()) == want, word


def test_class_counts_equal_classified_pixels(spark):
    rng = np.random.default_rng(6)
    blocks = blocks_of(spark, {(d, 2, y, 0): rng.integers(-9, 40, (2, 4, 4)) for d in range(3) for y in range(4)}, shape=(2, 4, 4)).repartition(3)
    ranges = [(0, 5), (5, 9), (3, 20), (39, 39)]
    pixels = P.explode_pixels(B.decode_blocks(blocks)).where(is_valid(F.col("dn"), -2, 39, -9))
    want = pixels.groupBy("hcol", "band", classify_ranges(F.col("dn"), ranges).alias("class")).count()
    failed = blocks.limit(1).withColumn("data", F.lit(None).cast("binary"))
    got = B.class_counts(blocks.unionByName(failed), ranges, -2, 39, -9, ["hcol"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert B.class_counts(blocks, ranges, -2, 39, -9).agg(F.sum("n")).first()[0] == pixels.count()
    assert B.class_counts(blocks.limit(0), ranges, -2, 39, -9).count() == 0


def test_a_piece_of_every_row_is_several_tasks_work(spark, monkeypatch):
    monkeypatch.setattr(K, "INDEX_BYTES", 2000, raising=False)
    names = ["Brand#%03d" % (k % 200) for k in range(2000)]
    rows = [(k, n, None) for k, n in enumerate(names)] + [(5, names[5], "Other"), (None, names[0], "xy"), (None, names[0], None)]
    index = K.text_index(spark.createDataFrame(rows, "id long, name string, other string"), "id", ["name", "other"])
    want = {(t.lower()[i:i + 3], k) for k, *texts in rows for t in texts if t for i in range(len(t) - 2)}
    got = list(map(tuple, index.collect()))
    assert set(got) == want and len(got) == len(want)
    # texts are dealt out before their pieces arise, and no piece moves to be told apart
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString().partition("Generate")[0]
    assert index.rdd.getNumPartitions() > 5
    path = scratch("grams")
    K.write_text_index(index, f"{path}/a")
    K.write_text_index(spark.createDataFrame([("bra", k) for k in range(3000)], "gram string, id long"), f"{path}/b")
    stored = list(map(tuple, spark.read.parquet(f"{path}/a").collect()))
    assert set(stored) == want and len(stored) == len(want)
    # a piece with more rows than one range holds is in several files
    assert spark.read.parquet(f"{path}/b").select(F.input_file_name()).distinct().count() > 1
