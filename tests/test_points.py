"""Values at points: all of them, and laid down as runs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_tiles import blocks_of
from tilewright.operators import blocks as B, pixels as P

SIDE = 360.0 / 4 / 4  # degrees of a pixel at zoom 2 with 4 x 4 pixels a tile


def crowded(spark):
    """A few hundred points in shuffled order on nine pixels of two tiles, some repeated, some without a tile or a place."""
    at = [(gx, gy) for gx, gy in itertools.product((1, 3, 5), (0, 1, 2))]
    rows = [(k, at[k % 9][0] * SIDE - 180, 90 - at[k % 9][1] * SIDE) for k in range(360)] + [(7, SIDE - 180, 90.0)] * 3 + [(None, SIDE - 180, 90.0)]
    rows += [(900, 100.0, -60.0), (901, None, 0.0), (902, 0.0, None)]
    random.Random(1).shuffle(rows)
    rng = np.random.default_rng(3)
    blocks = blocks_of(spark, {(d, 2, 0, x): rng.integers(-9, 90, (2, 4, 4)) for d in (1, 2, 3) for x in (0, 1)}, shape=(2, 4, 4))
    return rows, spark.createDataFrame(rows, "id long, lon double, lat double").repartition(2), blocks


@pytest.mark.parametrize("per_row", [4096, 7])
@pytest.mark.parametrize("form", ["pixels", "blocks"])
def test_values_of_a_pixel_stand_together(spark, form, per_row):
    rows, points, blocks = crowded(spark)
    tiles = B.decode_blocks(blocks).select("hcol", "z", "y", "x", "band", "dn")
    if form == "pixels":
        got = P.lookup_points(points, tiles, 2, 4, 4, per_row=per_row).select("id", "hcol", "band", "value").collect()
    else:
        got = B.lookup_points_blocks(points, blocks, 2, 4, 4, per_row=per_row).collect()
    pixels = {(r.hcol, r.y, r.x, r.band): r.dn for r in tiles.collect()}
    want = []
    for k, lon, lat in rows:
        if lon is not None and lat is not None:
            gx, gy = int((lon + 180) / SIDE + 0.5), int((90 - lat) / SIDE + 0.5)
            want += [(k, d, b, v[gy % 4 * 4 + gx % 4]) for (d, y, x, b), v in pixels.items() if (y, x) == (gy // 4, gx // 4)]
    assert sorted(map(tuple, got), key=str) == sorted(((k, d, b, float(v) if form == "blocks" else v) for k, d, b, v in want), key=str)
    # one run a pixel, date, band and list of points; a point at a time it would be nearly as many as rows
    runs = 1 + sum(a[1:] != b[1:] for a, b in itertools.pairwise(got))
    lists = sum(-(-n // per_row) for n in [44] + [40] * 8)
    assert runs <= 3 * 2 * lists and len(got) == 364 * 6


@pytest.mark.parametrize("form", ["pixels", "blocks"])
def test_a_value_finds_one_list_and_lists_of_a_pixel_are_dealt_out(spark, form):
    _, _, blocks = crowded(spark)
    points = spark.createDataFrame([(k, SIDE - 180, 90.0) for k in range(60)], "id long, lon double, lat double")
    if form == "pixels":
        tiles = B.decode_blocks(blocks).select("hcol", "z", "y", "x", "band", "dn")
        found = P.lookup_points(points, tiles, 2, 4, 4, per_row=4).select("id", "hcol", "band", "value")
    else:
        found = B.lookup_points_blocks(points, blocks, 2, 4, 4, per_row=4)
    rows = found.select("*", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.id, r.hcol, r.band) for r in rows) == [*itertools.product(range(60), (1, 2, 3), (0, 1))]
    assert len({r.task for r in rows}) > 1  # all 360 rows are of one pixel
    # what a row of the left side finds is held at once, so values stand there and have the list's number in their key
    join = found._jdf.queryExecution().executedPlan().toString().partition("SortMergeJoin")[2]
    assert "_part" in join.split("\n")[0] and join.index("hcol") < join.index("collect_list")


def test_no_points_or_tiles_give_no_values(spark):
    _, points, blocks = crowded(spark)
    tiles = B.decode_blocks(blocks)
    assert P.lookup_points(points.limit(0), tiles, 2, 4, 4).count() == P.lookup_points(points, tiles.limit(0), 2, 4, 4).count() == 0
    assert B.lookup_points_blocks(points.limit(0), blocks, 2, 4, 4).count() == B.lookup_points_blocks(points, blocks.limit(0), 2, 4, 4).count() == 0
