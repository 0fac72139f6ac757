"""Regions, statistics merge, blocks, tables and jobs on small hand-made tiles."""

import json
import os
import tempfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions.dates import CollectionSpec, Period
from tilewright.operators import blocks as B, collections as C, pixels as P, regions as R
from tilewright.operators.composite import check_method, composite
from tilewright.operators.regions import Regions
from tilewright.plans import orders as O, statistics as S, tiles as T
from tilewright.sinks.reports import write_csv, write_json
from tilewright.sinks.tiles import merge_cells, tile_counts, upsert_tiles, write_bucketed, write_tiles
from tilewright.sources.catalog import read_catalog_table
from tilewright.sources.directory import read_tile_files, read_tile_files_on, with_shape
from tilewright.sources.orders import SERIES_FIELDS, STATISTIC_FIELDS, TILE_FIELDS, read_order
from tilewright.sources.tiles import cell_by_row_key, newest, read_tiles, tile_cell, tiles_on_dates

FILL, LOW, HIGH = -9, 0, 100
REPO = Path(__file__).resolve().parents[1]


def scratch(name):
    return tempfile.mkdtemp(prefix=f"tilewright-{name}-")


def blocks_of(spark, cells, data_type=3, shape=(1, 4, 4), dsname="a"):
    """Blocks from {(hcol, z, y, x): array or number}."""
    dtype = {1: "<u1", 2: "<u2", 3: "<i2", 4: "<u4", 5: "<i4", 6: "<f4", 7: "<f8"}[data_type]
    rows = [(dsname, 1, h, z, y, x, shape[2], shape[1], shape[0], data_type, 0,
             bytearray(np.broadcast_to(np.asarray(v), shape).astype(dtype).tobytes())) for (h, z, y, x), v in cells.items()]
    return spark.createDataFrame(rows, "dsname string, hpid int, hcol long, z int, y int, x int, width int, height int, "
                                       "nbands int, data_type int, status int, data binary")


def segments_of(spark, rows):
    return spark.createDataFrame(rows, "roi_id string, z int, gy int, x0 int, x1 int")


def arrays(df):
    return df.sparkSession and {(r.z, r.y, r.x): np.frombuffer(r.data, {3: "<i2", 5: "<i4", 6: "<f4"}[r.data_type]).reshape(r.nbands, r.height, r.width)
                                for r in df.collect()}


# ---- regions -------------------------------------------------------------------------------------

def test_overlaps_and_neighbours_become_one_run(spark):
    seg = segments_of(spark, [("a", 2, 0, 0, 5), ("a", 2, 0, 3, 8), ("a", 2, 0, 9, 9), ("a", 2, 0, 12, 13), ("a", 2, 0, 0, 5), ("b", 2, 0, 4, 6)])
    rows = sorted((r.roi_id, r.x0, r.x1) for r in R.merged(seg).collect())
    assert rows == [("a", 0, 9), ("a", 12, 13), ("b", 4, 6)]
    covered = [p for r in R.union_of(seg).collect() for p in range(r.x0, r.x1 + 1)]
    assert sorted(covered) == [*range(10), 12, 13]
    both = [(r.x0, r.x1) for r in R.intersection_of(seg, ["a", "b", "b"]).collect()]
    assert both == [(4, 6)]


def test_cuts_stay_inside_tiles(spark):
    cuts = R.cut_to_tiles(segments_of(spark, [("a", 2, 5, 2, 9)]), 4, 4)
    assert sorted((r.y, r.x, r.row, r.c0, r.c1) for r in cuts.collect()) == [(1, 0, 1, 2, 3), (1, 1, 1, 0, 3), (1, 2, 1, 0, 1)]


def test_disjoint_regions_share_nothing(spark):
    seg = segments_of(spark, [("a", 2, 0, 0, 1), ("b", 2, 0, 6, 7)])
    assert R.intersection_of(seg, ["a", "b"]).count() == 0
    e = R.common_extent(R.region_extents(seg, 4)).first()
    assert e.left > e.right


def test_region_ids(spark):
    seg = segments_of(spark, [("sys:1", 2, 0, 0, 1), ("user:1", 2, 0, 6, 7)])
    assert [r.x0 for r in R.region_segments(seg, "user:1").collect()] == [6]
    path = scratch("roi") + "/r"
    seg.limit(1).write.parquet(path)
    assert R.region_segments(seg, path).count() == 1
    with pytest.raises(ValueError):
        R.region_segments(seg, "")


def test_window_predicates_reach_the_scan(spark):
    tiles = blocks_of(spark, {(1, 2, y, x): 1 for y in range(2) for x in range(4)})
    path = scratch("win") + "/t"
    write_tiles(tiles, path)
    seg = segments_of(spark, [("a", 2, 5, 9, 10)])
    found = R.window_of(spark.read.parquet(path), seg, 4, 4)
    assert [(r.y, r.x) for r in found.collect()] == [(1, 2)]
    plan = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(z" in plan or "PartitionFilters: [(z" in plan
    assert "GreaterThanOrEqual(y" in plan


# ---- statistics ----------------------------------------------------------------------------------

SEG = [("r", 2, g, 0, 7) for g in range(4)]


def stats_of(spark, cells, merge="reference", seg=SEG):
    regions = Regions(segments_of(spark, seg), 4, 4)
    blocks = blocks_of(spark, cells)
    a = S.zonal_stats_blocks(blocks, regions, LOW, HIGH, FILL, merge=merge).collect()
    tiles = B.decode_blocks(blocks)
    b = S.zonal_stats(tiles, regions, LOW, HIGH, FILL, merge=merge).collect()
    assert [r.asDict() for r in a] == [pytest.approx(r.asDict()) for r in b]
    return a


def test_empty_tile_is_dropped_by_the_merge(spark):
    cells = {(1, 2, 0, 0): 5, (1, 2, 0, 1): FILL}
    (r,) = stats_of(spark, cells)
    assert (r.sum, r.valid_cnt, r.all_cnt, r.fill_cnt, r.mean, r.stddev) == (80, 16, 16, 0, 5, 0)
    (r,) = stats_of(spark, cells, "all")
    assert (r.valid_cnt, r.all_cnt, r.fill_cnt) == (16, 32, 16)


def test_all_tiles_empty_takes_the_smallest_address(spark):
    (r,) = stats_of(spark, {(1, 2, 0, 1): 500, (1, 2, 0, 0): FILL})
    assert (r.valid_cnt, r.all_cnt, r.fill_cnt, r.mean, r.stddev, r.valid_min) == (0, 16, 16, 0, 0, 0)


def test_no_tile_gives_no_row(spark):
    assert stats_of(spark, {(1, 2, 1, 3): 5}) == []


def test_sum_above_the_range_is_invalid_unless_told(spark):
    tiles = B.decode_blocks(blocks_of(spark, {(1, 2, 0, 0): 60, (2, 2, 0, 0): 70}))
    dates = spark.createDataFrame([("k", 1), ("k", 2)], "key string, hcol long")
    regions = Regions(segments_of(spark, SEG), 4, 4)
    (r,) = S.series_stats(tiles, dates, regions, "sum", LOW, HIGH, FILL).collect()
    assert (r.valid_cnt, r.all_cnt) == (0, 16)
    (r,) = S.series_stats(tiles, dates, regions, "sum", LOW, HIGH, FILL, stats_range=(0, 1000)).collect()
    assert (r.valid_cnt, r.mean) == (16, 130)


def test_statistics_do_not_depend_on_partitions_or_broadcast(spark):
    rng = np.random.default_rng(1)
    cells = {(h, 2, y, x): rng.integers(-9, 120, (2, 4, 4)) for h in (1, 2, 3) for y in range(2) for x in range(4)}
    seg = segments_of(spark, [(f"r{i}", 2, int(g), int(a), int(a) + int(n)) for i in range(100)
                              for g, a, n in zip(rng.integers(0, 8, 3), rng.integers(0, 10, 3), rng.integers(0, 6, 3))])
    dates = spark.createDataFrame([("k", 1), ("k", 2), ("m", 3), ("m", 1)], "key string, hcol long")
    blocks = blocks_of(spark, cells, shape=(2, 4, 4))
    got = []
    for n in (1, 3, 17):
        for small in (True, False):
            regions = Regions(seg, 4, 4)
            regions.small = small
            for form, src in ((S.series_stats, B.decode_blocks(blocks.repartition(n))), (S.series_stats_blocks, blocks.repartition(n))):
                rows = form(src, dates, regions, "max", LOW, HIGH, FILL).collect()
                got.append(sorted((r.key, r.roi_id, r.band, r.sum, r.sq_sum, r.valid_cnt, r.valid_min, r.valid_max, r.all_cnt,
                                   r.fill_cnt, round(r.area_km2, 3)) for r in rows))
    assert len(got[0]) == 400 and all(g == got[0] for g in got)


@pytest.mark.parametrize("small", [True, False])
def test_region_joins_stay_equi_joins(spark, small):
    path = scratch("plan") + "/t"
    B.decode_blocks(blocks_of(spark, {(1, 2, 0, 0): 1})).write.parquet(path)
    segments_of(spark, SEG).write.parquet(path + "s")
    spark.createDataFrame([("k", 1)], "key string, hcol long").write.parquet(path + "d")
    regions = Regions(spark.read.parquet(path + "s"), 4, 4)
    regions.small = small
    stats = S.series_stats(spark.read.parquet(path), spark.read.parquet(path + "d"), regions, "max", LOW, HIGH, FILL)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortAggregate" not in plan
    assert "Python" not in plan and "InArrow" not in plan


def test_capped_dates_bound_each_group(spark):
    rows = [(g, d, i) for g in "ab" for d in range(1, 6) for i in range(2)] + [("c", 1, 0)]
    df = spark.createDataFrame(rows, "g string, hcol long, n int")
    got = sorted((r.g, r.hcol, r.n) for r in P.capped_dates(df, ["g"], 2, 99, cap=3).collect())
    assert got == [(g, d, i) for g in "ab" for d in (2, 3, 4) for i in range(2)]
    assert P.capped_dates(df, ["g"], 2, 99, cap=None).count() == 16


def test_unknown_method():
    with pytest.raises(ValueError):
        check_method("median")


# ---- blocks --------------------------------------------------------------------------------------

def test_block_length_is_checked():
    with pytest.raises(ValueError):
        B.pixels_of(b"\x00" * 5, 3, 1, 2, 2)
    with pytest.raises(ValueError):
        B.pixels_of(b"", 9, 1, 1, 1)


@pytest.mark.parametrize("method", ["min", "max", "ave", "sum"])
def test_composite_block_form_equals_pixel_form(spark, method, monkeypatch):
    rng = np.random.default_rng(2)
    cells = {(h, 2, y, x): rng.integers(-9, 120, (2, 4, 4)) for h in range(30) for y in range(2) for x in range(2)}
    blocks = blocks_of(spark, cells, shape=(2, 4, 4)).repartition(5)
    kind = "long" if method in ("min", "max") else "double"
    rows = composite(P.explode_pixels(B.decode_blocks(blocks)), method, LOW, HIGH, FILL)
    want = sorted((r.z, r.y, r.x, r.band, r.pos, float(r.dn)) for r in rows.collect())
    for spread in (1, 3):
        done = B.composite_blocks(blocks, method, LOW, HIGH, FILL, spread=spread)
        got = P.explode_pixels(B.decode_blocks(done, kind))
        assert sorted((r.z, r.y, r.x, r.band, r.pos, float(r.dn)) for r in got.collect()) == want
    monkeypatch.setattr(B, "HELD_BYTES", 1)  # every block is sent on at once
    done = P.explode_pixels(B.decode_blocks(B.composite_blocks(blocks, method, LOW, HIGH, FILL), kind))
    assert sorted((r.z, r.y, r.x, r.band, r.pos, float(r.dn)) for r in done.collect()) == want


@pytest.mark.parametrize("data_type,values", [(1, [0, 255]), (2, [0, 65535]), (3, [-32768, 32767]), (4, [0, 2**32 - 1]),
                                              (5, [-2**31, 2**31 - 1]), (6, [-1.5, 0.25]), (7, [-1e300, 1e-300])])
def test_every_element_type_keeps_its_extremes(spark, data_type, values):
    cells = {(1, 2, 0, 0): np.resize(np.array(values), (1, 4, 4))}
    blocks = blocks_of(spark, cells, data_type)
    kind = "double" if data_type > 5 else "long"
    tiles = B.decode_blocks(blocks, kind)
    assert tiles.first().dn[:2] == values
    again = B.encode_tiles(tiles, ["z", "y", "x"])
    assert again.first().data == blocks.first().data


def test_user_function_failures_are_rows(spark):
    def fn(address, tiles):
        if address["x"] == 1:
            raise KeyError("missing")
        return tiles[("a", 1)][0].astype("<f4") / 2

    out = B.map_tiles(blocks_of(spark, {(1, 2, 0, 0): 5, (1, 2, 0, 1): 5, (2, 2, 0, 0): 9}), fn, [("a", 1)])
    good, bad = sorted(out.collect(), key=lambda r: r.x)
    assert (good.status, good.data_type, good.nbands) == (0, 6, 1) and np.frombuffer(good.data, "<f4")[0] == 2.5
    assert (bad.status, bad.data) == (1, None) and "missing" in bad.log


@pytest.mark.parametrize("strips", [1, 2, 3, 9])
def test_stack_sees_dates_in_order_and_strips_join(spark, strips):
    def newest_minus_oldest(address, dates):
        seen = list(dates)
        assert [d for d, _ in seen] == sorted(d for d, _ in seen)
        return (seen[-1][1] - seen[0][1]).astype("<i2")

    ramp = np.arange(16).reshape(1, 4, 4)
    cells = {(h, 2, 0, x): ramp * h for h in (5, 1, 9) for x in (0, 1)}
    done = B.join_strips(B.apply_to_stack(blocks_of(spark, cells).repartition(4), newest_minus_oldest, ["z", "y", "x"], strips), ["z", "y", "x"])
    got = arrays(done)
    assert len(got) == 2 and all((a == ramp * 8).all() for a in got.values())


def test_several_inputs_meet_at_one_tile(spark):
    blocks = blocks_of(spark, {(1, 2, 0, 0): 5, (2, 2, 0, 0): 7, (1, 2, 0, 1): 1}).unionByName(
        blocks_of(spark, {(1, 2, 0, 0): 100}, dsname="b"))

    def total(address, tiles):
        return np.sum([px for px in tiles.values()], axis=0).astype("<i2")

    got = arrays(B.map_tiles(blocks, total, [("a", 1), ("a", 2), ("b", 1), ("b", 9)]))
    assert {k[2]: int(v[0, 0, 0]) for k, v in got.items()} == {0: 112, 1: 1}


def test_stack_function_may_stop_early(spark):
    def first_only(address, dates):
        return next(dates)[1]

    cells = {(h, 2, 0, 0): h for h in range(1, 600)}
    done = B.join_strips(B.apply_to_stack(blocks_of(spark, cells), first_only, ["z", "y", "x"]), ["z", "y", "x"])
    assert (arrays(done)[(2, 0, 0)] == 1).all()


def test_clip_blocks_fills_tiles_without_region(spark):
    runs = T.region_runs(segments_of(spark, [("r", 2, 1, 1, 2)]), ["r"])
    got = arrays(B.clip_blocks(blocks_of(spark, {(1, 2, 0, 0): 7, (1, 2, 1, 1): 7}), runs, FILL, 4, 4))
    assert (got[(2, 1, 1)] == FILL).all()
    want = np.full((1, 4, 4), FILL)
    want[0, 1, 1:3] = 7
    assert (got[(2, 0, 0)] == want).all()


def test_bands_must_exist(spark):
    tiles = spark.createDataFrame([(0, [1, 2])], "band int, dn array<int>")
    with pytest.raises(ValueError):
        P.select_bands(tiles, [0, 2], 2)
    blocks = blocks_of(spark, {(1, 2, 0, 0): np.stack([np.full((4, 4), b) for b in range(3)])}, shape=(3, 4, 4)).withColumn("pid", F.lit(1))
    bands = spark.createDataFrame([(1, 0, 1, 2), (1, 1, 1, 0)], "pid int, bindex int, hpid int, bsq_index int")
    keys = ["pid", "z", "y", "x"]
    assert [int(a[0, 0]) for a in arrays(B.select_block_bands(blocks, bands, keys))[(2, 0, 0)]] and \
        [int(a[0, 0]) for a in arrays(B.select_block_bands(blocks, bands, keys))[(2, 0, 0)]] == [2, 0]
    assert [int(a[0, 0]) for a in arrays(B.select_block_bands(blocks, bands, keys, [1, 0, 1]))[(2, 0, 0)]] == [0, 2, 0]
    assert B.select_block_bands(blocks, bands, keys, [0, 5]).count() == 0


# ---- tables and files ----------------------------------------------------------------------------

def test_tile_table_replaces_cells_and_leaves_others(spark):
    path = scratch("table") + "/t"
    write_tiles(blocks_of(spark, {(20200100000000, 2, 0, 0): 1, (20200100000000, 2, 0, 1): 2, (20200200000000, 2, 0, 0): 3}), path)
    upsert_tiles(blocks_of(spark, {(20200100000000, 2, 0, 1): 9, (20200100000000, 2, 1, 1): 4}), path)
    back = read_tiles(spark, path)
    got = {(r.hcol, r.y, r.x): np.frombuffer(r.data, "<i2")[0] for r in back.collect()}
    assert got == {(20200100000000, 0, 0): 1, (20200100000000, 0, 1): 9, (20200100000000, 1, 1): 4, (20200200000000, 0, 0): 3}
    assert read_tiles(spark, path, "a", 2, 20200200000000, 20200300000000).count() == 1
    assert read_tiles(spark, path, "b").count() == 0
    assert tile_cell(back, 1, 20200100000000, 2, 1, 1).count() == 1
    assert tile_cell(back, 1, 20200100000000, 2, 1, 2).count() == 0


def test_bucketed_tables_join_and_composite_without_shuffling_tiles(spark):
    tiles = blocks_of(spark, {(h, 2, y, x): h for h in (1, 2) for y in range(2) for x in range(4)})
    where = scratch("bucketed")
    write_bucketed(tiles, "bucketed_tiles", 4, where + "/t")
    table = spark.table("bucketed_tiles")
    other = table.groupBy("z", "y", "x").agg(F.max("hcol").alias("last"))
    plan = table.hint("merge").join(other, ["z", "y", "x"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE bucketed_tiles")


def test_row_keyed_cells_and_versions(spark):
    from tilewright.functions.keys import encode_key

    cells = spark.createDataFrame([(1, 2, 3, 4, 1, b"old"), (1, 2, 3, 4, 2, b"new"), (1, 2, 3, 5, 1, b"x")],
                                  "pid int, z int, y int, x int, version int, data binary")
    keyed = cells.withColumn("row_key", encode_key(*[F.col(c) for c in ("pid", "z", "y", "x")], 4, 4))
    found = newest(cell_by_row_key(keyed, 1, 2, 3, 4, 4, 4), ["row_key"], "version").collect()
    assert [bytes(r.data) for r in found] == [b"new"]


def test_directory_tiles(spark):
    import os

    root = scratch("dir")
    for d in (20200101000000, 20200102000000):
        os.makedirs(f"{root}/tab/7/{d}")
        for x in (0, 1):
            with open(f"{root}/tab/7/{d}/tile_2_0_{x}", "wb") as f:
                f.write(np.full(16, d % 10**7 // 10**6 + x, "<i2").tobytes())
    assert read_tile_files(spark, root, "tab").count() == 4
    (r,) = read_tile_files(spark, root, "tab", 7, 20200102000000, 2, 0, 1).collect()
    assert (r.hpid, r.hcol, r.z, r.y, r.x, np.frombuffer(r.data, "<i2")[0]) == (7, 20200102000000, 2, 0, 1, 3)
    assert read_tile_files(spark, root, "tab", 7, 20200103000000).count() == 0
    assert read_tile_files(spark, root, "tab", 7, []).count() == 0
    assert read_tile_files(spark, root, "tab", 7, [20200101000000, 20200102000000], 2, 0, 0).count() == 2
    span = spark.createDataFrame([(20200102000000, 20200109000000)], "a long, b long")
    days = C.candidate_dates(span, "a", "b", month=1, day=-1, hour=0, minute=0, second=0)
    some = read_tile_files_on(spark, root, "tab", days, hpid=7)
    assert some.count() == 2
    assert B.decode_blocks(with_shape(some, 4, 4, 1, 3)).count() == 2


# ---- jobs ----------------------------------------------------------------------------------------

def order_file(values):
    path = scratch("order") + "/order.json"
    with open(path, "w") as f:
        json.dump(values, f, indent=1)
    return path


@pytest.fixture(scope="module")
def world(spark):
    cells = {(20200100000000 + m * 100000000, 2, y, x): m + x for m in range(4) for y in range(2) for x in range(4)}
    info = '{"proj":"EPSG:4326","minZoom":0,"maxZoom":2,"dataType":3,"timeType":5,"hTableName":"t","tileWid":4,"tileHei":4,"styleid":1}'
    return dict(
        blocks=blocks_of(spark, cells, dsname="mod/x"),
        segments=segments_of(spark, [("sys:1", 2, g, 0, 7) for g in range(8)]),
        products=spark.createDataFrame([(1, "mod/x", 0, "hbase", info)], "pid int, name string, userid int, source string, info string"),
        items=spark.createDataFrame([(1, m, 20200100000000 + m * 100000000) for m in range(4)], "pid int, fid long, hcol long"),
        bands=spark.createDataFrame([(1, 0, BAND_INFO % (1, 0))], "pid int, bindex int, info string"))


BAND_INFO = '{"hPid":%d,"bsqIndex":%d,"bName":"b","scale":1,"offset":0,"validMin":0,"validMax":1,"noData":0}'


BASE = {"dsname": "mod/x", "jsfile": "", "roi": "sys:1", "roi_comment": "ignored", "filldata": -9, "validMinInc": 0, "validMaxInc": 100,
        "dt": 20200200000000, "sdui": "", "method": "max", "whole_start": 20200000000000, "whole_start_inc": 1,
        "whole_stop": 20210000000000, "whole_stop_inc": 1, "repeat_type": "", "repeat_start": 0, "repeat_start_inc": 1,
        "repeat_stop": 1231235959, "repeat_stop_inc": 1, "repeat_stopnextyear": 0}


def test_statistics_order(spark, world):
    order = read_order(spark, order_file(BASE), STATISTIC_FIELDS)
    (r,) = O.run_statistics(order, world["blocks"], world["segments"], world["products"], world["bands"]).collect()
    assert (r.valid_cnt, r.valid_min, r.valid_max, r.mean) == (64, 1, 2, 1.5)


def test_series_orders(spark, world):
    args = (world["blocks"], world["segments"], world["products"], world["items"], world["bands"])
    daily = O.run_series(read_order(spark, order_file(BASE), SERIES_FIELDS), *args).collect()
    assert [(r.key, r.valid_max) for r in daily] == [("20200100", 1), ("20200200", 2), ("20200300", 3), ("20200400", 4)]
    yearly = read_order(spark, order_file({**BASE, "repeat_type": "y"}), SERIES_FIELDS)
    (r,) = O.run_series(yearly, *args).collect()
    assert (r.key, r.valid_min, r.valid_max) == ("2020", 3, 4)
    out = scratch("result")
    stats = O.run_series(yearly, *args)
    write_csv(stats, out + "/csv", 1)
    write_json(stats, out + "/json")
    line = spark.read.text(out + "/csv").collect()
    assert line[0][0].startswith("key,roi_id,areakm2_b1,acnt_b1") and line[1][0].startswith("2020,sys:1,")
    doc = json.loads(spark.read.text(out + "/json").first()[0])
    assert doc["state"] == 0 and doc["data"][0]["key"] == "2020" and doc["data"][0]["data"][0]["validCnt"] == 64


def test_script_series_order(spark, world):
    def spread(address, dates):
        seen = [px for _, px in dates]
        return np.max(seen, axis=0) - np.min(seen, axis=0)

    args = (world["blocks"], world["segments"], world["products"], world["items"], {"spread": spread}, world["bands"])
    values = {**BASE, "baseddsname": "mod/x", "caller": "spread", "repeat_type": "y"}
    (r,) = O.run_script_series(read_order(spark, order_file(values), SERIES_FIELDS), *args, strips=2).collect()
    assert (r.key, r.valid_min, r.valid_max) == ("2020", 3, 3)
    days = O.run_script_series(read_order(spark, order_file({**values, "repeat_type": ""}), SERIES_FIELDS), *args).collect()
    assert [(r.key, r.valid_max) for r in days] == [(f"20200{m}00", 0) for m in (1, 2, 3, 4)]


@pytest.mark.parametrize("change", [{"dsname": "", "jsfile": ""}, {"roi": ""}, {"method": "median"}, {"dsname": "none"}, {"repeat_type": "d"}])
def test_bad_orders_are_rejected(spark, world, change):
    order = read_order(spark, order_file({**BASE, **change}), SERIES_FIELDS)
    with pytest.raises(ValueError):
        O.run_series(order, world["blocks"], world["segments"], world["products"], world["items"], world["bands"])


def test_bad_script_orders_are_rejected(spark, world):
    args = (world["blocks"], world["segments"], world["products"], world["items"], {}, world["bands"])
    for change in ({"caller": ""}, {"caller": "x", "baseddsname": ""}, {"caller": "x", "baseddsname": "mod/x", "roi": ""},
                   {"caller": "unknown", "baseddsname": "mod/x"}):
        with pytest.raises(ValueError):
            O.run_script_series(read_order(spark, order_file({**BASE, **change}), SERIES_FIELDS), *args)


def test_tile_order_fields(spark):
    order = read_order(spark, order_file({"jsfile": "f", "roi": "", "filldata": 0, "dt": 5, "mpid_hpid": 1001, "out_hcol": 1}), TILE_FIELDS)
    assert (order.mpid_hpid, order.out_hcol, order.out_htable) == (1001, 1, None)
    with pytest.raises(AttributeError):
        order.nothing


def test_tile_order_end_to_end(spark, world):
    blocks = world["blocks"]
    info = '{"proj":"%s","minZoom":0,"maxZoom":%d,"dataType":3,"timeType":5,"hTableName":"t","tileWid":4,"tileHei":4,"styleid":%d}'
    products = spark.createDataFrame(
        [(1, "mod/x", 0, "hbase", info % ("EPSG:4326", 2, 0)), (2, "mod/y", 0, "hbase", info % ("EPSG:4326", 5, 7)),
         (3, "mod/z", 0, "hbase", info % ("EPSG:3857", 5, 7)), (9, "out", 4, "hbase", "{}")],
        "pid int, name string, userid int, source string, info string")
    c = catalog_of(spark)
    catalog = T.Catalog(products, c.bands, c.items)
    both = blocks.unionByName(blocks.withColumn("dsname", F.lit("mod/y")))

    def add(address, tiles):
        return sum(tiles.values())

    order = read_order(spark, order_file({"jsfile": "add", "roi": "sys:1;", "filldata": -9, "dt": 20200100000000, "mpid_hpid": 9,
                                          "out_hcol": 20200101000000, "out_htable": "t2"}), TILE_FIELDS)
    inputs = [("mod/x", 0), ("mod/y", 20200200000000)]
    done = O.run_tiles(order, both, world["segments"], catalog, {"add": add}, inputs, scratch("tiles") + "/out")
    # the region covers four tiles; growing its extent reaches the column to the right
    assert (done.good, done.bad) == (6, 0)
    info_row = done.catalog.products.where("pid = 9").first()
    assert info_row.name == "out" and json.loads(info_row.info)["maxZoom"] == 2 and json.loads(info_row.info)["styleid"] == 7
    for bad_inputs in ([("mod/x", 0), ("mod/z", 0)], [("nothing", 0)], []):
        with pytest.raises(ValueError):
            O.run_tiles(order, both, world["segments"], catalog, {"add": add}, bad_inputs, scratch("tiles") + "/out")
    with pytest.raises(ValueError):
        O.run_tiles(order, both, world["segments"], catalog, {}, inputs, scratch("tiles") + "/out")


def catalog_of(spark):
    return T.Catalog(
        spark.createDataFrame([(5, "old", 0, "file", "{}")], "pid int, name string, userid int, source string, info string"),
        spark.createDataFrame([(5, 0, "{}")], "pid int, bindex int, info string"),
        spark.createDataFrame([(5, 1, 1, 2)], "pid int, hcol long, dt0 long, dt1 long"))


def test_tile_job_registers_only_without_failures(spark):
    cells = {(20200100000000, z, y, x): z for z in range(3) for y in range(max(1, 2**z // 2)) for x in range(2**z)}
    blocks = blocks_of(spark, cells)
    args = dict(out_dsname="mine", out_hpid=9, out_hcol=1, max_zoom=2, extent=(-180.0, -10.0, 90.0, -90.0), width=4, height=4)
    def twice(address, tiles):
        return tiles[("a", 20200100000000)] * 2

    args = dict(inputs=[("a", 20200100000000)], **args)
    tiles = T.compute_tiles(blocks, twice, **args)
    path = scratch("job") + "/out"
    job = dict(catalog=catalog_of(spark), dsname="mine", hcol=1, proj="EPSG:4326", max_zoom=2, table="out", styleid=0, userid=3,
               fill=-9, extent=(-180, -10, 90, -90))
    done = T.run_tile_job(tiles, path, **job)
    assert (done.good, done.bad) == (1 + 1 + 4, 0)
    assert sorted(r.pid for r in done.catalog.products.collect()) == [5, 9]
    assert [(r.hcol, r.dt1) for r in done.catalog.items.where("pid = 9").collect()] == [(1, 2)]
    assert done.catalog.bands.where("pid = 9").count() == 1
    assert {np.frombuffer(r.data, "<i2")[0] for r in read_tiles(spark, path, "mine", 2).collect()} == {4}

    def fails(address, tiles):
        raise RuntimeError("no")

    failed = T.run_tile_job(T.compute_tiles(blocks, fails, **args), scratch("job") + "/out", **job)
    assert (failed.good, failed.bad) == (0, 6) and failed.catalog.products.count() == 1
    runs = T.region_runs(segments_of(spark, [("r", 2, 0, 0, 0)]), ["r"])
    clipped = T.compute_tiles(blocks, twice, run_segments=runs, fill=-9, **args)
    got = arrays(clipped.where("z = 2"))
    assert got[(2, 0, 0)][0, 0, 0] == 4 and got[(2, 0, 0)][0, 0, 1] == -9 and (got[(2, 1, 1)] == -9).all()


def test_catalog_snapshot(spark, world):
    folder = scratch("catalog")
    world["products"].write.parquet(folder + "/product")
    assert read_catalog_table(spark, folder, "product").count() == 1


def test_query_parameters(spark, world):
    text = "SELECT count(*) AS n FROM {items} WHERE fid >= :low"
    assert O.run_query(spark, text, '{"low": 2}', items=world["items"]).first().n == 2
    for nothing in (None, "", "{}", "null", "undefined"):
        assert O.run_query(spark, "SELECT count(*) AS n FROM {items}", nothing, items=world["items"]).first().n == 4


# ---- edges ---------------------------------------------------------------------------------------

def test_repeated_cells_need_a_version(spark):
    path = scratch("upsert") + "/t"
    one = blocks_of(spark, {(20200100000000, 2, 0, 0): 1})
    two = blocks_of(spark, {(20200100000000, 2, 0, 0): 2})
    upsert_tiles(one, path)
    with pytest.raises(ValueError):
        upsert_tiles(one.unionByName(two), path)
    upsert_tiles(one.withColumn("v", F.lit(1)).unionByName(two.withColumn("v", F.lit(2))), path, version="v")
    assert [np.frombuffer(r.data, "<i2")[0] for r in read_tiles(spark, path).collect()] == [2]
    assert [f for f in os.listdir(os.path.dirname(path)) if "staged" in f] == []


def test_failed_tiles_replace_nothing(spark):
    path = scratch("job") + "/t"
    blocks = blocks_of(spark, {(20200100000000, 0, 0, 0): 3})
    job = dict(catalog=catalog_of(spark), dsname="mine", hcol=1, proj="EPSG:4326", max_zoom=0, table="out", styleid=0, userid=3, fill=-9,
               extent=(-180, 180, 90, -90))

    def compute(fn):
        return T.compute_tiles(blocks, fn, [("a", 20200100000000)], "mine", 9, 1, 0)

    def same(address, tiles):
        return next(iter(tiles.values()))

    def fails(address, tiles):
        raise RuntimeError("no")

    assert T.run_tile_job(compute(same).limit(0), path, **job).good == 0
    assert T.run_tile_job(compute(same), path, **job).good == 1
    assert T.run_tile_job(compute(fails), path, **job).bad == 1
    (kept,) = read_tiles(spark, path).collect()
    assert kept.status == 0 and read_tiles(spark, path + "_failed").first().log == "RuntimeError: no"


def test_dates_become_partition_filters(spark):
    path = scratch("pruned") + "/t"
    dates = [20200100000000, 20200200000000, 20210300000000]
    upsert_tiles(blocks_of(spark, {(d, 2, 0, 0): 1 for d in dates}), path)
    tiles = read_tiles(spark, path)
    some = spark.createDataFrame([("k", dates[1])], "key string, hcol long")
    plans = [tile_cell(tiles, 1, dates[0], 2, 0, 0), tiles_on_dates(tiles, some), P.capped_dates(tiles, ["y"], dates[0], dates[1]),
             T.compute_tiles(tiles, lambda a, t: None, [("a", dates[1])], "o", 1, 1, 4), T.composite_order(tiles, dates[0], dates[1], "max", 0, 9, -9, 1)]
    for frame in plans:
        text = frame._jdf.queryExecution().executedPlan().toString()
        filters = text[text.index("PartitionFilters: ["):].split("]", 1)[0]
        assert "ym" in filters, text
    assert plans[0].count() == 1 and plans[1].count() == 1 and plans[2].count() == 2


def test_unknown_regions_are_errors_and_paths_are_read(spark, world):
    with pytest.raises(ValueError):
        R.known_segments(world["segments"], ["sys:77"])
    path = scratch("region") + "/r"
    world["segments"].write.parquet(path)
    found = R.known_segments(world["segments"], [path, "sys:1"])
    assert {r.roi_id for r in found.select("roi_id").distinct().collect()} == {path, "sys:1"}
    order = read_order(spark, order_file({**BASE, "roi": "sys:77"}), STATISTIC_FIELDS)
    with pytest.raises(ValueError):
        O.run_statistics(order, world["blocks"], world["segments"], world["products"], world["bands"])


def test_fill_values_must_fit_and_nan_counts_as_fill(spark):
    blocks = blocks_of(spark, {(1, 2, 0, 0): 5})
    with pytest.raises(Exception, match="does not fit"):
        B.clip_blocks(blocks, segments_of(spark, [("r", 2, 0, 0, 0)]).drop("roi_id"), -70000, 4, 4).collect()
    data = np.array([1, np.nan, 3, np.nan], "<f4").tobytes()
    tile = spark.createDataFrame([(2, 0, 0, 2, 2, 1, 6, data)], "z int, y int, x int, width int, height int, nbands int, data_type int, data binary")
    (r,) = B.block_stats(tile, R.Regions(segments_of(spark, [("r", 2, 0, 0, 1), ("r", 2, 1, 0, 1)]), 2, 2), 0, 9, float("nan")).collect()
    assert (r.valid_cnt, r.fill_cnt, r.sum) == (2, 2, 4)


def test_other_shapes_of_one_tile_and_null_blocks(spark):
    blocks = blocks_of(spark, {(1, 2, 0, 0): 5, (2, 2, 0, 0): 6})
    failed = blocks.limit(1).withColumn("data", F.lit(None).cast("binary"))
    assert B.decode_blocks(blocks.unionByName(failed)).count() == 2
    assert B.composite_blocks(blocks.unionByName(failed), "max", 0, 9, -9).count() == 1
    other = blocks.limit(1).withColumn("width", F.lit(8)).withColumn("height", F.lit(2))
    with pytest.raises(Exception, match="differ in size"):
        B.composite_blocks(blocks.unionByName(other), "max", 0, 9, -9).collect()


def test_composites_exchange_once_where_counts_allow(spark):
    cells = {(d, 2, 0, 0): d for d in range(1, 60)} | {(d, 2, 0, 1): d for d in range(1, 4)}
    blocks = blocks_of(spark, cells).repartition(5)
    plain = B.composite_blocks(blocks, "max", 0, 50, -9, two_steps=False)
    spread = B.composite_blocks(blocks, "max", 0, 50, -9)
    assert {k: v.tolist() for k, v in arrays(plain).items()} == {k: v.tolist() for k, v in arrays(spread).items()}
    steps = [frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for frame in (plain, spread)]
    assert steps == [2, 3]
    path = scratch("counted") + "/t"
    write_tiles(blocks, path)
    counts = tile_counts(spark, path)
    assert {(r.y, r.x): r.n for r in counts.collect()} == {(0, 0): 59, (0, 1): 3}
    assert B.any_heavy(counts, heavy=58) and not B.any_heavy(counts, heavy=59)
    write_tiles(blocks.where("hcol <= 10"), path)  # the whole partition is replaced, and so are its counts
    assert {(r.y, r.x): r.n for r in tile_counts(spark, path).collect()} == {(0, 0): 10, (0, 1): 3}
    assert tile_counts(spark, path + "-none") is None


def counted(spark, tile_fn, name):
    """``tile_fn`` that leaves a file for each call."""
    folder = scratch(name)

    def fn(address, tiles):
        import uuid

        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        return tile_fn(address, tiles)

    return fn, lambda: len(os.listdir(folder))


def test_composite_computes_its_input_once(spark):
    blocks = blocks_of(spark, {(d, 2, y, 0): d for d in range(1, 20) for y in range(2)})
    fn, calls = counted(spark, lambda a, t: next(iter(t.values())), "calls")
    done = B.map_tiles(blocks, fn, [("a", 5)], ("hcol", "z", "y", "x"))
    B.composite_blocks(done, "max", 0, 50, -9).collect()
    assert calls() == 2


def two_stores(spark, other_value=50):
    one = blocks_of(spark, {(1, 2, 0, 0): 5, (2, 2, 0, 0): 6})
    two = blocks_of(spark, {(1, 2, 0, 0): other_value}).withColumn("hpid", F.lit(2))
    return one.unionByName(two)


def test_several_store_blocks_are_refused(spark):
    mixed = two_stores(spark).coalesce(1)
    segments = segments_of(spark, [("r", 2, 0, 0, 3)])
    with pytest.raises(Exception, match="several store blocks"):
        B.composite_blocks(mixed, "max", 0, 90, -9).collect()
    with pytest.raises(Exception, match="several store blocks"):
        B.composite_blocks(mixed.repartition(3, "hpid"), "max", 0, 90, -9).collect()
    with pytest.raises(Exception, match="several store blocks"):
        S.zonal_stats_blocks(mixed.where("hcol = 1"), R.Regions(segments, 4, 4), 0, 90, -9).collect()
    pixels = B.decode_blocks(mixed)
    with pytest.raises(Exception, match="several store blocks"):
        S.zonal_stats(pixels.where("hcol = 1"), R.Regions(segments, 4, 4), 0, 90, -9).collect()
    with pytest.raises(Exception, match="several store blocks"):
        composite(P.explode_pixels(pixels), "max", 0, 90, -9).collect()
    with pytest.raises(Exception, match="several store blocks"):
        B.map_tiles(mixed, lambda a, t: next(iter(t.values())), [("a", 1)]).collect()


def test_a_cell_is_written_once(spark):
    tiles = blocks_of(spark, {(1, 2, 0, 0): 5})
    path = scratch("twice") + "/t"
    with pytest.raises(ValueError, match="several rows for the cell"):
        merge_cells(tiles.unionByName(tiles), path)
    assert not os.path.exists(path)
    # a task each, so that only the write can see both
    done = T.compute_tiles(two_stores(spark).repartition(4, "hpid"), lambda a, t: next(iter(t.values())), [("a", 1)], "o", 9, 7, 4)
    empty = lambda text: spark.createDataFrame([], text)
    catalog = T.Catalog(empty("pid int, name string, userid int, source string, info string"), empty("pid int, bindex int, info string"), empty("pid int, hcol long, dt0 long, dt1 long"))
    with pytest.raises(Exception, match="several (rows for the cell|store blocks)"):
        T.run_tile_job(done, path, catalog, "o", 7, "EPSG:4326", 4, "t", 0, 0, -9, (-180.0, 180.0, 90.0, -90.0))


def test_job_counts_survive_a_retried_task(spark):
    """The function fails its first call outright, so Spark tries the task again; local mode needs a session that allows it."""
    import subprocess
    import sys

    code = """
import os, sys
from pyspark.sql import SparkSession, Observation, functions as F
spark = SparkSession.builder.master("local[2, 3]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
sys.path.insert(0, sys.argv[1])
from tilewright.sinks.tiles import staged
mark = sys.argv[2] + "/mark"
def once(batches):
    for batch in batches:
        yield batch
    if not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("first try")
seen = Observation()
rows = spark.range(0, 100, 1, 4).mapInArrow(once, "id long")
with staged(rows, sys.argv[2] + "/t", seen, F.count(F.lit(1)).alias("n")) as done:
    print("COUNTS", seen.get["n"], done.count(), os.path.exists(mark))
"""
    out = subprocess.run([sys.executable, "-c", code, str(REPO), scratch("retry")], capture_output=True, text=True, timeout=300)
    assert "COUNTS 100 100 True" in out.stdout, out.stderr[-2000:]


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_bands_of_one_block_need_no_exchange(spark):
    cells = {(1, 2, 0, x): np.arange(48).reshape(3, 4, 4) + x for x in range(3)}
    blocks = blocks_of(spark, cells, shape=(3, 4, 4)).withColumn("pid", F.lit(1))
    table = lambda rows: spark.createDataFrame(rows, "pid int, bindex int, hpid int, bsq_index int")
    keys = ("pid", "hcol", "z", "y", "x")
    one = B.select_block_bands(blocks, table([(1, 0, 1, 2), (1, 1, 1, 0)]), keys, [1, 0, 1])
    assert exchanges(one) == 0
    got = {r.x: np.frombuffer(r.data, "<i2").reshape(r.nbands, 16).tolist() for r in one.collect()}
    assert got == {x: [cells[1, 2, 0, x][b].reshape(-1).tolist() for b in (0, 2, 0)] for x in range(3)}
    second = blocks.withColumn("hpid", F.lit(2)).where("x < 2")
    spread = B.select_block_bands(blocks.unionByName(second), table([(1, 0, 2, 1), (1, 1, 1, 2), (1, 2, 2, 0)]), keys)
    assert {r.x: np.frombuffer(r.data, "<i2").reshape(3, 16).tolist() for r in spread.collect()} == {
        x: [cells[1, 2, 0, x][b].reshape(-1).tolist() for b in (1, 2, 0)] for x in range(2)}
    # bucketed tiles are put together where they lie
    path = scratch("bucketed") + "/b"
    write_bucketed(blocks.unionByName(second), "banded", 4, path)
    try:
        stored = spark.table("banded")
        again = B.select_block_bands(stored, table([(1, 0, 2, 1), (1, 1, 1, 2), (1, 2, 2, 0)]), keys)
        assert exchanges(again) == 0 and sorted(map(tuple, again.collect())) == sorted(map(tuple, spread.collect()))
    finally:
        spark.sql("DROP TABLE banded")
