"""Tile computing, window export and composite orders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from tilewright.functions.grid import TILE_SIZE, tile_range
from tilewright.operators.blocks import TileFunction, clip_blocks, composite_blocks, map_tiles
from tilewright.operators.pixels import dated, good_tiles
from tilewright.operators.regions import clip, intersection_of, merged
from tilewright.sinks.registry import output_bands, output_item, output_product, replace_rows
from tilewright.sinks.tiles import FAILED, merge_cells, staged


def zoom_windows(spark: SparkSession, extent: tuple[float, float, float, float], max_zoom: int,
                 tile_size: int = TILE_SIZE, min_zoom: int = 0) -> list:
    """Tile range of (left, right, top, bottom) at each zoom: one small row per zoom."""
    left, right, top, bottom = (F.lit(float(v)) for v in extent)
    zooms = spark.range(min_zoom, max_zoom + 1).select(F.col("id").cast("int").alias("z"))
    ranges = zooms.withColumn("r", tile_range(left, right, top, bottom, F.col("z"), tile_size))
    return ranges.where("r.xmin is not null").select("z", "r.xmin", "r.xmax", "r.ymin", "r.ymax").collect()


def in_windows(tiles: DataFrame, windows: list) -> DataFrame:
    """Tiles inside the windows; the comparisons are with constants, so the scan prunes by them."""
    test = F.lit(False)
    for w in windows:
        test = test | ((F.col("z") == w.z) & F.col("y").between(w.ymin, w.ymax) & F.col("x").between(w.xmin, w.xmax))
    return tiles.where(test)


def export_window(tiles: DataFrame, extent: tuple[float, float, float, float], z: int,
                  tile_size: int = TILE_SIZE) -> DataFrame:
    """Tiles of one zoom that meet an extent."""
    return in_windows(tiles, zoom_windows(tiles.sparkSession, extent, z, tile_size, z))


def export_pixels(pixels: DataFrame, run_segments: DataFrame, fill: float, width: int, height: int) -> DataFrame:
    """Window pixels with everything outside the region set to fill."""
    return clip(pixels, run_segments, fill, width, height)


def region_runs(segments: DataFrame, roi_ids: list[str]) -> DataFrame:
    """Disjoint runs of one region, or of the pixels all regions share."""
    if len(set(roi_ids)) == 1:
        return merged(segments.where(F.col("roi_id") == roi_ids[0])).drop("roi_id")
    return intersection_of(segments, roi_ids)


def compute_tiles(blocks: DataFrame, fn: TileFunction, inputs: list[tuple[str, int]], out_dsname: str, out_hpid: int,
                  out_hcol: int, max_zoom: int, extent: tuple[float, float, float, float] | None = None,
                  run_segments: DataFrame | None = None, fill: float = 0, width: int = TILE_SIZE,
                  height: int = TILE_SIZE) -> DataFrame:
    """Result tiles of a user function over all zooms up to ``max_zoom``; each zoom is computed on its own.

    ``inputs`` lists the (dataset, date) pairs the function reads.
    """
    dates = [date for _, date in inputs]
    chosen = dated(good_tiles(blocks), min(dates), max(dates)).where(F.col("z") <= max_zoom)
    if extent is not None:
        chosen = in_windows(chosen, zoom_windows(blocks.sparkSession, extent, max_zoom, width))
    out = map_tiles(chosen, fn, inputs)
    if run_segments is not None:
        # failed tiles have no pixels: they pass through beside the clip, in the same run of the function
        out = clip_blocks(out, run_segments, fill, width, height)
    return out.withColumn("dsname", F.lit(out_dsname)).withColumn("hpid", F.lit(out_hpid)).withColumn(
        "hcol", F.lit(out_hcol).cast("long"))


@dataclass(frozen=True)
class Catalog:
    """Snapshot frames a tile job adds its product to."""

    products: DataFrame
    bands: DataFrame
    items: DataFrame


@dataclass(frozen=True)
class TileJobResult:
    good: int
    bad: int
    catalog: Catalog


def run_tile_job(tiles: DataFrame, path: str, catalog: Catalog, dsname: str, hcol: int, proj: str, max_zoom: int,
                 table: str, styleid: int, userid: int, fill: float,
                 extent: tuple[float, float, float, float]) -> TileJobResult:
    """Write computed tiles, then add band, item and product rows when no tile failed.

    Tiles go in cell by cell: other dates, regions and products of the table stay. Failed tiles replace nothing; they are
    kept with their error text in a table beside it, under ``path`` + FAILED. Tiles are staged, so the user function runs once, and
    counted while they are staged.
    """
    spark = tiles.sparkSession
    is_good, seen = F.col("status") == 0, Observation()
    # struct order makes the sample row the same whichever task comes first
    sample = F.min(F.when(is_good, F.struct("hpid", "nbands", "data_type"))).alias("first")
    with staged(tiles, path, seen, F.count_if(is_good).alias("good"), F.count_if(~is_good).alias("bad"), sample) as done:
        counts = Row(**seen.get)
        if counts.good:
            merge_cells(good_tiles(done), path)
        if counts.bad:
            merge_cells(done.where("status <> 0"), path.rstrip("/") + FAILED)
    first = counts.first
    if counts.bad or first is None:
        return TileJobResult(counts.good, counts.bad, catalog)
    left, right, top, bottom = (float(v) for v in extent)
    row = spark.range(1).select(
        F.lit(first.hpid).alias("pid"), F.lit(first.hpid).alias("hpid"), F.lit(hcol).cast("long").alias("hcol"),
        F.lit(first.nbands).alias("nbands"), F.lit(first.data_type).alias("data_type"), F.lit(dsname).alias("name"),
        F.lit(userid).alias("userid"), F.lit(proj).alias("proj"), F.lit(max_zoom).alias("maxzoom"),
        F.lit(table).alias("table"), F.lit(styleid).alias("styleid"), F.lit(left).alias("left"),
        F.lit(right).alias("right"), F.lit(top).alias("top"), F.lit(bottom).alias("bottom"))
    return TileJobResult(counts.good, 0, Catalog(
        replace_rows(catalog.products, output_product(row), ["pid"]),
        replace_rows(catalog.bands, output_bands(row, fill), ["pid", "bindex"]),
        replace_rows(catalog.items, output_item(row), ["pid", "hcol"])))


def composite_order(blocks: DataFrame, start: int, stop: int, method: str, low: float, high: float, fill: float,
                    out_hcol: int) -> DataFrame:
    """Composite of one dataset's tiles over a date range as tiles of a new date."""
    chosen = dated(good_tiles(blocks), start, stop)
    done = composite_blocks(chosen, method, low, high, fill, ("dsname", "hpid", "z", "y", "x"))
    return done.withColumn("hcol", F.lit(out_hcol).cast("long")).withColumn("status", F.lit(0))
