"""Region statistics and series analysis."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.operators.blocks import Fold, apply_to_stack, block_stats, composite_blocks, fold_blocks, join_strips
from tilewright.operators.composite import composite
from tilewright.operators.pixels import explode_pixels, good_tiles
from tilewright.operators.regions import Regions
from tilewright.operators.sides import fits_broadcast, hinted
from tilewright.sources.tiles import in_months
from tilewright.operators.zonal import merge_stats, tile_stats


def _by_date(tiles: DataFrame, collections: DataFrame) -> DataFrame:
    """One row per tile and key holding its date. Dates without a tile, and tiles without a key, drop out.

    Where both sides name the product (dsname, pid), a date counts for its own product only.
    """
    own = [c for c in ("dsname", "pid") if c in tiles.columns and c in collections.columns]
    dates = collections.select("key", "hcol", *own).distinct()
    return in_months(tiles, dates).join(hinted(dates, fits_broadcast(dates)), ["hcol", *own])


def _place(pixels: DataFrame, width: int) -> DataFrame:
    pos = F.col("pos").cast("long")
    return pixels.withColumn("row", F.call_function("div", pos, F.lit(width).cast("long")).cast("int")).withColumn(
        "col", (pos % width).cast("int"))


def zonal_stats(tiles: DataFrame, regions: Regions, low: float, high: float, fill: float,
                keys: tuple[str, ...] = (), merge: str = "reference") -> DataFrame:
    """Statistics of every region and band; tiles hold pixel arrays. Failed tiles are left out."""
    pixels = explode_pixels(regions.touching(good_tiles(tiles)))
    return merge_stats(tile_stats(pixels, regions.cuts, low, high, fill, keys), keys, merge)


def zonal_stats_blocks(blocks: DataFrame, regions: Regions, low: float, high: float, fill: float,
                       keys: tuple[str, ...] = (), merge: str = "reference") -> DataFrame:
    """Same numbers from binary blocks."""
    return merge_stats(block_stats(good_tiles(blocks), regions, low, high, fill, keys), keys, merge)


def series_stats(tiles: DataFrame, collections: DataFrame, regions: Regions, method: str, low: float, high: float,
                 fill: float, per_date: bool = False, merge: str = "reference",
                 stats_range: tuple[float, float] | None = None) -> DataFrame:
    """Composite the dates of each key, then statistics per key, region and band.

    ``per_date`` keeps every date its own composite and only merges statistics by key (day keys).
    The statistics use the composite's valid range unless ``stats_range`` names another, so a ``sum``
    above the range counts as invalid.
    """
    keys = ("key", "hcol") if per_date else ("key",)
    dated = regions.touching(_by_date(good_tiles(tiles), collections))
    # narrow to region pixels before the composite's shuffle
    pixels = regions.narrow(explode_pixels(dated))
    combined = _place(composite(pixels, method, low, high, fill, (*keys, "z", "y", "x", "band", "pos")), regions.width)
    s_low, s_high = stats_range or (low, high)
    stats = tile_stats(combined, regions.cuts, s_low, s_high, fill, keys)
    return merge_stats(stats, ("key",), merge, then_by="hcol" if per_date else None)


def series_stats_blocks(blocks: DataFrame, collections: DataFrame, regions: Regions, method: str, low: float,
                        high: float, fill: float, per_date: bool = False,
                        merge: str = "reference", stats_range: tuple[float, float] | None = None, two_steps: bool = True) -> DataFrame:
    """``series_stats`` on binary blocks: whole tiles are composited, one row per tile and date is sent.

    For ``two_steps`` see ``composite_blocks``; a tile has one date under a key where ``per_date`` is set.
    """
    keys = ("key", "hcol") if per_date else ("key",)
    dated = regions.touching(_by_date(good_tiles(blocks), collections))
    combined = composite_blocks(dated, method, low, high, fill, (*keys, "z", "y", "x"), two_steps=two_steps and not per_date)
    s_low, s_high = stats_range or (low, high)
    stats = block_stats(combined, regions, s_low, s_high, fill, keys)
    return merge_stats(stats, ("key",), merge, then_by="hcol" if per_date else None)


def script_series(tiles: DataFrame, collections: DataFrame, regions: Regions, stack: Callable[[Column], Column],
                  low: float, high: float, fill: float) -> DataFrame:
    """Series with a user aggregate over the dates of a pixel instead of a named method.

    ``stack`` maps the column of valid values (null where invalid) to an aggregate, for example
    ``lambda v: F.max(v) - F.min(v)``.
    """
    dated = regions.touching(_by_date(good_tiles(tiles), collections))
    pixels = regions.narrow(explode_pixels(dated))
    valid = F.when((F.col("dn") != fill) & F.col("dn").between(low, high), F.col("dn"))
    combined = pixels.groupBy("key", "z", "y", "x", "band", "pos").agg(F.coalesce(stack(valid), F.lit(fill)).alias("dn"))
    stats = tile_stats(_place(combined, regions.width), regions.cuts, low, high, fill, ("key",))
    return merge_stats(stats, ("key",))


def script_series_blocks(blocks: DataFrame, collections: DataFrame, regions: Regions, fn, low: float, high: float,
                         fill: float, strips: int = 1, per_date: bool = False) -> DataFrame:
    """Series with a Python function over the date stack of each tile: a ``Fold``, or one that needs dates in order (``apply_to_stack``)."""
    keys = ("key", "hcol") if per_date else ("key",)
    dated = regions.touching(_by_date(good_tiles(blocks), collections))
    address = (*keys, "z", "y", "x")
    if isinstance(fn, Fold):
        out = good_tiles(fold_blocks(dated, fn, address, two_steps=not per_date))
    else:
        out = good_tiles(join_strips(apply_to_stack(dated, fn, address, strips), address))
    return merge_stats(block_stats(out, regions, low, high, fill, keys), ("key",), then_by="hcol" if per_date else None)
