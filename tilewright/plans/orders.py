"""Jobs started from an order document."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions.grid import grow_extent
from tilewright.functions.text import EMPTY_PARAMS
from tilewright.operators.blocks import SHAPE, any_heavy
from tilewright.operators.catalog import common_inputs, product_by_name
from tilewright.operators.collections import build_collections, daily_series
from tilewright.operators.pixels import dated
from tilewright.operators.regions import Regions, common_extent, known_segments, region_extents, window_of
from tilewright.plans import statistics
from tilewright.plans.datasets import resolved
from tilewright.plans.tiles import Catalog, TileJobResult, compute_tiles, region_runs, run_tile_job
from tilewright.sources.catalog import with_product_info
from tilewright.sources.tiles import in_months
from tilewright.sources.orders import Order, check_script_series, check_series, check_statistics


def _product(products: DataFrame, name: str):
    row = with_product_info(product_by_name(products, name)).first()
    if row is None:
        raise ValueError(f"unknown product {name!r}")
    return row


def _tiles(blocks: DataFrame, p, products: DataFrame, bands: DataFrame) -> DataFrame:
    """Tiles of a product at its highest zoom, assembled from the store blocks its bands lie in."""
    return resolved(blocks.where((F.col("dsname") == p.name) & (F.col("z") == p.maxZoom)), products, bands, p.name)


def run_statistics(order: Order, blocks: DataFrame, segments: DataFrame, products: DataFrame, bands: DataFrame) -> DataFrame:
    """Region statistics of one dataset date at its highest zoom. ``bands`` is the band table of the products."""
    check_statistics(order)
    p = _product(products, order.dsname)
    tiles = _tiles(dated(blocks, order.dt, order.dt), p, products, bands)
    wanted = known_segments(segments, [order.roi])
    regions = Regions(wanted, p.tileWid, p.tileHei)
    tiles = window_of(tiles, wanted, p.tileWid, p.tileHei)
    return statistics.zonal_stats_blocks(tiles, regions, order.validMinInc, order.validMaxInc, order.filldata)


def resolve_inputs(products: DataFrame, names: list[str]) -> dict:
    """Projection, lowest max zoom and first style of the named datasets, which must fit together."""
    if not names:
        raise ValueError("a job needs at least one dataset")
    spark = products.sparkSession
    named = spark.createDataFrame([(0, n, i) for i, n in enumerate(names)], "job int, dsname string, ord int")
    common = common_inputs(named, products, "job").first()
    if common.unknown:
        raise ValueError(f"unknown dataset among {names}")
    if not common.same_proj:
        raise ValueError(f"datasets differ in projection: {names}")
    first = _product(products, names[0])
    return {"proj": first.proj, "max_zoom": common.max_zoom, "styleid": common.styleid, "width": first.tileWid,
            "height": first.tileHei}


def common_extent_of(segments: DataFrame, rois: list[str], tile_size: int) -> tuple[float, float, float, float]:
    """Extent shared by all the regions, grown by half a level-0 pixel; the globe without regions."""
    if not rois:
        return -180.0, 180.0, 90.0, -90.0
    extents = region_extents(segments.where(F.col("roi_id").isin(*rois)), tile_size)
    grown = grow_extent(*[F.col(c) for c in ("left", "right", "top", "bottom")])
    row = common_extent(extents).select(grown.alias("e")).select("e.*").first()
    return row.left, row.right, row.top, row.bottom


def _with_known_bands(blocks: DataFrame, catalog: Catalog, name: str) -> DataFrame:
    """Tiles of a product, band-resolved if the catalog lists its bands, else its one store block as it is."""
    mine = product_by_name(catalog.products, name).select("pid")
    columns = ["dsname", "hcol", "z", "y", "x", *SHAPE, "status", "data"]
    if catalog.bands.join(mine, "pid", "left_semi").first() is None:
        return blocks.where(F.col("dsname") == name).select(columns)
    return resolved(blocks, catalog.products, catalog.bands, name).select(columns)


def run_tiles(order: Order, blocks: DataFrame, segments: DataFrame, catalog: Catalog, functions: dict,
              inputs: list[tuple[str, int]], path: str) -> TileJobResult:
    """Compute tiles of all zooms with the user's function named by ``jsfile``, write and register them.

    ``inputs`` are the (dataset, date) pairs the function reads; date 0 stands for the order's date.
    The output is the registered product ``mpid_hpid``. Inputs are band-resolved with the catalog's bands. With a region, pixels outside become fill.
    """
    if order.jsfile not in functions:
        raise ValueError(f"unknown function {order.jsfile!r}")
    common = resolve_inputs(catalog.products, [n for n, _ in inputs])
    rois = [r for r in (order.roi or "").split(";") if r]
    segments = known_segments(segments, rois) if rois else segments
    extent = common_extent_of(segments, rois, common["width"])
    target = catalog.products.where(F.col("pid") == order.mpid_hpid).first()
    if target is None:
        raise ValueError(f"unknown output product {order.mpid_hpid}")
    dates = [d or order.dt for _, d in inputs]
    blocks = dated(blocks, min(dates), max(dates))
    frames = [_with_known_bands(blocks, catalog, name) for name in dict.fromkeys(n for n, _ in inputs)]
    tiles = compute_tiles(
        reduce(DataFrame.unionByName, frames), functions[order.jsfile], [(n, d or order.dt) for n, d in inputs], target.name, order.mpid_hpid,
        order.out_hcol, common["max_zoom"], extent, region_runs(segments, rois) if rois else None, order.filldata,
        common["width"], common["height"])
    return run_tile_job(tiles, path, catalog, target.name, order.out_hcol, common["proj"], common["max_zoom"],
                        order.out_htable, common["styleid"], target.userid, order.filldata, extent)


def _series_inputs(order: Order, name: str, blocks, segments, products, items, bands):
    p = _product(products, name)
    mine = items.where(F.col("pid") == p.pid)
    spec = order.dates()
    dates = build_collections(mine, spec) if spec.repeat_type else daily_series(mine, spec.whole)
    tiles = _tiles(in_months(blocks, dates), p, products, bands)
    wanted = known_segments(segments, [order.roi])
    tiles = window_of(tiles, wanted, p.tileWid, p.tileHei)
    return tiles, dates, Regions(wanted, p.tileWid, p.tileHei), not spec.repeat_type


def run_series(order: Order, blocks: DataFrame, segments: DataFrame, products: DataFrame, items: DataFrame, bands: DataFrame,
               counts: DataFrame | None = None) -> DataFrame:
    """Series of one dataset: repeated periods by key, or every date under its day.

    ``counts`` are those kept beside the tile table (``tile_counts``); if they show no tile with many dates, one exchange is saved.
    """
    check_series(order)
    tiles, dates, regions, per_date = _series_inputs(order, order.dsname, blocks, segments, products, items, bands)
    heavy = counts is None or any_heavy(counts.where(F.col("dsname") == order.dsname))
    return statistics.series_stats_blocks(tiles, dates, regions, order.method, order.validMinInc, order.validMaxInc,
                                          order.filldata, per_date, two_steps=heavy).orderBy("key", "roi_id", "band")


def run_script_series(order: Order, blocks: DataFrame, segments: DataFrame, products: DataFrame, items: DataFrame,
                      functions: dict, bands: DataFrame, strips: int = 1) -> DataFrame:
    """Series with one of the user's functions, named by the order's ``caller``: a ``Fold``, or a function over dates in order."""
    check_script_series(order)
    if order.caller not in functions:
        raise ValueError(f"unknown function {order.caller!r}")
    tiles, dates, regions, per_date = _series_inputs(order, order.baseddsname, blocks, segments, products, items, bands)
    return statistics.script_series_blocks(tiles, dates, regions, functions[order.caller], order.validMinInc,
                                           order.validMaxInc, order.filldata, strips, per_date
                                           ).orderBy("key", "roi_id", "band")


def run_query(spark: SparkSession, text: str, params_json: str | None, **frames: DataFrame) -> DataFrame:
    """A user's SQL with ``:name`` parameters taken from a JSON object; frames are named in braces."""
    given = params_json is not None and params_json not in EMPTY_PARAMS
    return spark.sql(text, args=json.loads(params_json) if given else {}, **frames)
