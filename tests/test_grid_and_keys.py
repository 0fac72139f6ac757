"""Tile addresses at the globe's edges, row keys, extents, templates."""

import datetime

import pytest
from pyspark.sql import functions as F

from tilewright.functions import grid as G, keys as K, pixels as P, text as X
from tilewright.operators.pixels import covering_tiles


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    return row if len(cols) > 1 else row[0]


def test_three_rules_at_the_far_corner(spark):
    lon, lat = F.lit(180.0), F.lit(-90.0)
    strict, clamped, rounded = one(
        spark, a=G.tile_of_point_strict(lon, lat, F.lit(3)), b=G.tile_of_point_clamped(lon, lat, F.lit(3)),
        c=G.pixel_of_point(lon, lat, F.lit(3)))
    assert (strict.x, strict.y) == (7, 3)
    assert (clamped.x, clamped.y) == (7, 3)
    assert (rounded.x, rounded.y, rounded.col, rounded.row) == (8, 4, 0, 0)


def test_strict_is_null_off_the_globe_or_zoom(spark):
    cases = [(180.1, 0.0, 3), (0.0, -90.1, 3), (0.0, 0.0, 22), (0.0, 0.0, -1), (1e300, 0.0, 3)]
    df = spark.createDataFrame(cases, "lon double, lat double, z int")
    rows = df.select(G.tile_of_point_strict(F.col("lon"), F.col("lat"), F.col("z")).alias("t")).collect()
    assert [tuple(r.t) for r in rows] == [(None,) * 6] * 5


def test_level_zero_reaches_below_the_globe(spark):
    b = one(spark, b=G.tile_bounds(F.lit(0), F.lit(0), F.lit(0)))
    assert (b.left, b.right, b.top, b.bottom) == (-180.0, 180.0, 90.0, -270.0)
    assert one(spark, n=G.tile_rows(F.lit(0))) == 1


def test_clamped_outside(spark):
    t = one(spark, t=G.tile_of_point_clamped(F.lit(-500.0), F.lit(500.0), F.lit(4)))
    assert (t.x, t.y) == (0, 0)


@pytest.mark.parametrize("text,ok", [("1,2,3,4", True), ("1,2,3,4,,", True), ("1,2,3", False), ("", False), ("1,2,x,4", False),
                                     (",1,2,3", False)])
def test_extent_text(spark, text, ok):
    got = tuple(one(spark, e=G.parse_extent(F.lit(text))))
    assert got == ((1.0, 2.0, 3.0, 4.0) if ok else (None,) * 4)


def test_inverted_extent_has_no_tiles(spark):
    df = spark.createDataFrame([(10.0, -10.0, 5.0, 0.0), (0.0, 10.0, 10.0, 0.0)], "left double, right double, top double, bottom double")
    rows = covering_tiles(df, G.tile_range, [6]).collect()
    assert rows and all(r.left == 0.0 for r in rows)


def test_zone_areas_add_up_to_the_sphere(spark):
    rows = spark.range(64).select(F.sum(G.pixel_area_km2(F.lit(4), F.col("id"), 8)).alias("a")).first()
    import math

    assert rows.a * 128 == pytest.approx(4 * math.pi * G.EARTH_RADIUS_KM ** 2, rel=1e-12)


def test_key_lengths_and_wrap(spark):
    key = one(spark, k=K.encode_key(F.lit(200), F.lit(9), F.lit(40000), F.lit(3), 1, 2))
    assert key.hex() == "03" + "c8" + "09" + "9c40" + "0003"
    back = one(spark, k=K.decode_key(F.lit(bytes(key)), 1, 2))
    assert (back.bucket, back.pid, back.z, back.y, back.x) == (3, -56, 9, 40000 - 65536, 3)
    assert one(spark, k=K.decode_key(F.lit(b"\x00" * 8), 1, 2)) is None
    given = one(spark, k=K.encode_key(F.lit(1), F.lit(2), F.lit(3), F.lit(4), 4, 4, bucket=F.lit(9)))
    assert given.hex() == "09" + "00000001" + "02" + "00000003" + "00000004"


def test_template_covers_all_eight_days(spark):
    text = " ".join(["{{{DATE}}}"] + ["{{{DATE-%d}}}" % i for i in range(9)])
    got = one(spark, t=X.fill_template(F.lit(text), F.lit(datetime.date(2024, 3, 2)))).split(" ")
    assert got == ["20240302", "20240302", "20240301", "20240229", "20240228", "20240227", "20240226", "20240225", "20240224", "{{{DATE-8}}}"]


@pytest.mark.parametrize("text,pairs", [("a,1;b,2", [("a", 1), ("b", 2)]), ("a,1;;b,2;", [("a", 1), ("b", 2)]), ("a,1;b", None),
                                        ("a,x", None), ("", []), ("a,1,", [("a", 1)])])
def test_lineage(spark, text, pairs):
    got = one(spark, p=X.lineage_pairs(F.lit(text)))
    assert (None if got is None else [tuple(r) for r in got]) == pairs


def test_styles(spark):
    v = spark.createDataFrame([(-5.0,), (0.0,), (5.0,), (10.0,), (25.0,)], "v double")
    c = F.col("v")
    rows = v.select(P.classify_stops(c, [0, 10, 20], "linear").alias("l"), P.classify_stops(c, [0, 10, 20], "discrete").alias("d"),
                    P.classify_stops(c, [0, 10, 20], "exact").alias("e")).collect()
    assert [tuple(r) for r in rows] == [(0.0, None, None), (0.0, 0, 0), (0.5, 0, None), (1.0, 1, 1), (2.0, 2, None)]
    with pytest.raises(ValueError):
        P.classify_stops(c, [1, 0], "linear")


def test_byte_width(spark):
    df = spark.range(0, 9)
    assert [r.w for r in df.select(P.byte_width(F.col("id")).alias("w")).collect()] == [0, 1, 2, 2, 4, 4, 4, 8, 0]
