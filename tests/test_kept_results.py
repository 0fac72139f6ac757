"""Results that are kept and reused: tile summaries, folds, growing series, tile files."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_tiles import arrays, blocks_of, scratch, segments_of
from tilewright.functions.dates import CollectionSpec, Period
from tilewright.operators import blocks as B
from tilewright.operators.collections import build_collections
from tilewright.operators.regions import Regions
from tilewright.operators.summaries import tile_summaries, zonal_stats_summed
from tilewright.plans import statistics as S
from tilewright.sinks.directory import write_tile_files
from tilewright.sinks.tiles import write_tiles
from tilewright.sources.directory import date_folders, read_tile_files, read_tile_files_between, read_tile_files_on
from tilewright.streaming.growing import GrowingSeries

ARGS = (0, 60, -9)


def grid(spark, dates=(1,), z=4, rows=8, columns=16, seed=4):
    rng = np.random.default_rng(seed)
    return blocks_of(spark, {(d, z, y, x): rng.integers(-9, 90, (2, 4, 4)) for d in dates for y in range(rows) for x in range(columns)}, shape=(2, 4, 4))


def near(rows):
    """Rows by key with doubles to nine digits: sums are added in another order."""
    return sorted((tuple(None if v is None else v if isinstance(v, str) else float(f"{v:.9g}") for v in r) for r in rows), key=str)


SEGMENTS = [("big", 4, g, 3, 50) for g in range(2, 30)] + [("thin", 4, 9, 0, 63)] + [("one", 4, g, 8, 11) for g in range(4, 8)] + [("one", 4, 5, 9, 10)]


@pytest.mark.parametrize("merge", ["reference", "all"])
def test_summaries_give_the_rows_of_whole_reads(spark, merge):
    blocks = grid(spark)
    blocks = blocks.withColumn("status", F.when(F.expr("y = 3 AND x = 5"), 1).otherwise(0))
    regions = Regions(segments_of(spark, SEGMENTS), 4, 4)
    want = S.zonal_stats_blocks(blocks, regions, *ARGS, merge=merge)
    got = zonal_stats_summed(blocks, tile_summaries(blocks, *ARGS), regions, *ARGS, merge=merge)
    assert got.columns == want.columns and near(got.collect()) == near(want.collect())
    assert got.where("roi_id = 'one'").first().all_cnt == 16  # overlaps of one region count once


def test_inner_tiles_read_no_data(spark):
    path = scratch("summed")
    write_tiles(grid(spark, rows=64, columns=128, z=7).repartition(4), f"{path}/t")
    stored = spark.read.parquet(f"{path}/t")
    tile_summaries(stored, *ARGS).write.parquet(f"{path}/s")
    segments = segments_of(spark, [("r", 7, g, 0, 511) for g in range(0, 250)])  # all tiles but the last rows are inside
    spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
    try:
        got = zonal_stats_summed(stored, spark.read.parquet(f"{path}/s"), Regions(segments, 4, 4), *ARGS)
        scans = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and f"{path}/t" in line]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    with_data = [s for s in scans if "data:binary" in s]
    assert len(scans) == 2 and len(with_data) == 1, scans
    assert "GreaterThanOrEqual(y,48)" in with_data[0].replace(" ", ""), with_data  # only the neighbourhoods of the border are read
    want = S.zonal_stats_blocks(stored, Regions(segments, 4, 4), *ARGS)
    assert near(got.collect()) == near(want.collect())


def test_a_missing_summary_is_an_error(spark):
    blocks, regions = grid(spark), Regions(segments_of(spark, SEGMENTS), 4, 4)
    some = tile_summaries(blocks, *ARGS).where("y <> 3")
    with pytest.raises(Exception, match="no summary"):
        zonal_stats_summed(blocks, some, regions, *ARGS).collect()


def range_fold(log=None):
    def start(address):
        return np.full((2, 2, 4, 4), [[[[99]]], [[[-99]]]])

    def add(state, date, px):
        return np.stack([np.minimum(state[0], px), np.maximum(state[1], px)])

    def merge(a, b):
        return np.stack([np.minimum(a[0], b[0]), np.maximum(a[1], b[1])])

    return B.Fold(start, add, merge, lambda s: (s[1] - s[0]).astype("<i2"))


def test_folds_give_the_same_for_any_partitioning(spark, monkeypatch):
    blocks = grid(spark, dates=range(40), rows=2, columns=2)
    keys = ("z", "y", "x")
    want = arrays(B.apply_to_stack(blocks, lambda a, dates: (lambda s: (np.max(s, 0) - np.min(s, 0)).astype("<i2"))([p for _, p in dates]), keys))
    for frame in (blocks.coalesce(1), blocks.repartition(7), blocks.repartition(3, "hcol")):
        for two_steps in (True, False):
            got = arrays(B.fold_blocks(frame, range_fold(), keys, two_steps=two_steps))
            assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)
    monkeypatch.setattr(B, "HELD_BYTES", 1)
    got = arrays(B.fold_blocks(blocks, range_fold(), keys))
    assert all((got[k] == want[k]).all() for k in want)


def test_a_hot_tile_is_shared_by_reducers(spark):
    """A third of all dates lie on one tile: its states reach the last reducer as one row a first reducer."""
    hot = blocks_of(spark, {(d, 2, 0, 0): d % 50 for d in range(200)} | {(d, 2, y, x): 1 for d in range(10) for y in range(2) for x in range(4) if (y, x) != (0, 0)})
    parts = B.tile_parts(hot.repartition(32), B.composite_start("max", *ARGS), ("z", "y", "x"))
    assert parts.where("y = 0 AND x = 0").select("salt").distinct().count() == 16
    done = {(r.y, r.x): np.frombuffer(r.data, "<i2")[0] for r in B.composite_blocks(hot.repartition(32), "max", *ARGS).collect()}
    assert done[0, 0] == 49 and len(done) == 8


def test_a_task_hands_on_what_it_holds_when_that_is_much(spark, monkeypatch):
    """Room for two tiles: the first one's later date finds it gone, so it comes out in two parts."""
    blocks = blocks_of(spark, {(d, 2, 0, x): 1 for d, x in ((1, 0), (1, 1), (2, 0))}).coalesce(1).sortWithinPartitions("hcol", "x")
    start, keys = B.composite_start("max", *ARGS), ("z", "y", "x")
    room = 2 * start((2, 0, 0, 4, 4, 1, 3)).nbytes
    count = lambda: sorted((r.x, r.dates) for r in B.tile_parts(blocks, start, keys).collect())
    assert count() == [(0, 2), (1, 1)]
    monkeypatch.setattr(B, "HELD_BYTES", room)
    assert count() == [(0, 1), (0, 1), (1, 1)]
    fold = range_fold()
    folded = lambda key: B._Folded(fold, keys, key)
    two = blocks_of(spark, {(d, 2, 0, x): np.ones((2, 4, 4)) for d, x in ((1, 0), (1, 1), (2, 0))}, shape=(2, 4, 4)).coalesce(1).sortWithinPartitions("hcol", "x")
    monkeypatch.setattr(B, "HELD_BYTES", 2 * fold.start({}).nbytes)
    assert sorted((r.x, r.dates) for r in B.tile_parts(two, folded, keys, date="hcol").collect()) == [(0, 1), (0, 1), (1, 1)]


def test_failing_folds_are_rows(spark):
    def add(state, date, px):
        if date == 3:
            raise ArithmeticError("bad date")
        return px if state is None else state + px

    fold = B.Fold(lambda a: None, add, lambda a, b: b if a is None else a if b is None else a + b, lambda s: s)
    blocks = blocks_of(spark, {(d, 2, 0, x): 1 for d in range(6) for x in range(2) if not (x and d == 3)}).repartition(4)
    rows = {r.x: (r.status, r.log) for r in B.fold_blocks(blocks, fold, ("z", "y", "x")).collect()}
    assert rows == {0: (1, "ArithmeticError: bad date"), 1: (0, None)}


def monthly(hcol):
    return F.when(hcol > 0, F.call_function("div", hcol, F.lit(100000000)))


DATES = [20190100000000, 20190115000000, 20190200000000, 20190210000000, 20190301000000]


def test_batches_equal_one_run_and_replays_change_nothing(spark):
    blocks, regions = grid(spark, DATES, rows=4), Regions(segments_of(spark, SEGMENTS[:-5]), 4, 4)
    items = spark.createDataFrame([(1, d, d, d, d + 1) for d in DATES], "pid int, fid long, hcol long, dt0 long, dt1 long")
    dates = build_collections(items, CollectionSpec(Period(20190000000000, 20200000000000), "m", Period(0, 31235959)))
    for method in ("max", "ave"):
        want = near(S.series_stats_blocks(blocks, dates, regions, method, *ARGS).collect())
        grown = GrowingSeries(spark, scratch("grown"), method, *ARGS, monthly)
        with pytest.raises(ValueError):
            grown.parts()
        for batch, days in enumerate((DATES[::2], DATES[1::2])):
            grown.fold(blocks.where(F.col("hcol").isin(days)), batch)
        assert near(grown.statistics(regions).select(S.series_stats_blocks(blocks, dates, regions, method, *ARGS).columns).collect()) == want
        grown.fold(blocks.where(F.col("hcol").isin(DATES[1::2])), 1)
        assert near(grown.statistics(regions).collect()) == want
        grown.compact()
        assert len(grown._folders()) == 1 and near(grown.statistics(regions).collect()) == want
        grown.fold(blocks.where(F.col("hcol").isin(DATES[1::2])), 1)  # replayed after it was compacted
        assert near(grown.statistics(regions).collect()) == want
        grown.fold(blocks.limit(0), 2)
        assert near(grown.statistics(regions).collect()) == want


def test_a_stream_of_files_is_folded(spark):
    root, blocks = scratch("stream"), grid(spark, DATES, rows=2)
    regions = Regions(segments_of(spark, SEGMENTS[:10]), 4, 4)
    grown = GrowingSeries(spark, f"{root}/kept", "sum", *ARGS, monthly)
    for n, days in enumerate((DATES[:2], DATES[2:])):
        blocks.where(F.col("hcol").isin(days)).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        grown.follow(stream, f"{root}/checkpoint", availableNow=True).awaitTermination()
    whole = GrowingSeries(spark, f"{root}/whole", "sum", *ARGS, monthly)
    whole.fold(blocks, 0)
    assert len(grown._folders()) == 2 and near(grown.statistics(regions).collect()) == near(whole.statistics(regions).collect())


def test_tile_files_round_trip_and_other_folders_stay_closed(spark):
    root, blocks = scratch("tree"), grid(spark, DATES, rows=2, columns=2)
    assert write_tile_files(blocks, root, "tab") == 20
    assert write_tile_files(blocks.where(F.col("hcol") == DATES[0]), f"file:{root}", "tab") == 4  # again, in place
    assert sorted(f for _, _, names in os.walk(root) for f in names if not f.startswith(".")) == sorted(f"tile_4_{y}_{x}" for _ in DATES for y in range(2) for x in range(2))
    assert sorted(r.hcol for r in date_folders(spark, root, "tab").collect()) == DATES
    back = {(r.hcol, r.y, r.x): bytes(r.data) for r in read_tile_files(spark, root, "tab").collect()}
    assert back == {(r.hcol, r.y, r.x): bytes(r.data) for r in blocks.collect()}
    os.chmod(f"{root}/tab/1/{DATES[1]}", 0)
    os.mkdir(f"{root}/tab/1/notes")
    os.rename(f"{root}/tab/1/{DATES[3]}", f"{root}/tab/1/{DATES[3]}x")  # no date folder any more
    some = read_tile_files_between(spark, root, "tab", DATES[0], DATES[2], parts={"day": 0}, y=1)
    assert {(r.hcol, r.y, r.x) for r in some.collect()} == {(d, 1, x) for d in (DATES[0], DATES[2]) for x in (0, 1)}
    assert all(str(DATES[1]) not in f for f in some.inputFiles())
    wanted = spark.createDataFrame([(DATES[4],), (5,)], "dt long")
    assert read_tile_files_on(spark, root, "tab", wanted).count() == 4
    assert read_tile_files_on(spark, root, "tab", wanted.where("dt = 5")).count() == 0
    assert date_folders(spark, root, "none").count() == 0
    os.chmod(f"{root}/tab/1/{DATES[1]}", 0o755)
