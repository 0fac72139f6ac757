"""Datasets by name: what a script used to open, as frames of tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tilewright.operators.blocks import select_block_bands
from tilewright.operators.catalog import product_by_name
from tilewright.operators.pixels import capped_dates, dated, good_tiles
from tilewright.sources.catalog import with_band_info
from tilewright.sources.tiles import tiles_on_dates

ADDRESS = ("pid", "hcol", "z", "y", "x")


def _bands(products: DataFrame, bands: DataFrame, name: str) -> DataFrame:
    """Store block and slice of each band of a product; no rows for an unknown name."""
    mine = product_by_name(products, name).select("pid")
    return with_band_info(bands).join(mine, "pid", "left_semi").select(
        "pid", "bindex", F.col("hPid").alias("hpid"), F.col("bsqIndex").alias("bsq_index"))


def _selected(blocks: DataFrame, name: str, bands: DataFrame, wanted: Sequence[int]) -> DataFrame:
    """Band-resolved tiles with every column the jobs need: one row per address and date, bands in the asked order."""
    return select_block_bands(blocks, bands, ADDRESS, wanted).withColumn("dsname", F.lit(name)).withColumn(
        "hpid", F.col("pid")).withColumn("status", F.lit(0))


def resolved(tiles: DataFrame, products: DataFrame, bands: DataFrame, name: str, wanted: Sequence[int] = ()) -> DataFrame:
    """All tiles of a product, each assembled from the store blocks its bands lie in; failed blocks are left out."""
    return _selected(_of_product(tiles, products, name), name, _bands(products, bands, name), wanted)


def _of_product(tiles: DataFrame, products: DataFrame, name: str) -> DataFrame:
    pid = product_by_name(products, name).select("pid").first()
    if pid is None:
        raise ValueError(f"unknown product {name!r}")
    mine = tiles.where(F.col("dsname") == name).withColumn("pid", F.lit(pid.pid))
    return good_tiles(mine) if "status" in tiles.columns else mine


def dataset(tiles: DataFrame, products: DataFrame, bands: DataFrame, items: DataFrame, name: str, dt: int = 0,
            wanted: Sequence[int] = ()) -> DataFrame:
    """Tiles of one product and date with the wanted bands (none named means all).

    Date 0 means the product's first item; a tile lacking a wanted band has no row.
    """
    mine = _of_product(tiles, products, name)
    if dt == 0:
        first = items.join(product_by_name(products, name).select("pid"), "pid", "left_semi").agg(F.min("hcol")).first()[0]
        if first is None:
            return _selected(mine.limit(0), name, _bands(products, bands, name), wanted)
        dt = first
    return _selected(dated(mine, dt, dt), name, _bands(products, bands, name), wanted)


def collection(tiles: DataFrame, products: DataFrame, bands: DataFrame, name: str, dates: DataFrame,
               wanted: Sequence[int] = ()) -> DataFrame:
    """Tiles of one product on the listed dates (column ``hcol``); missing dates are skipped."""
    mine = tiles_on_dates(_of_product(tiles, products, name), dates)
    return _selected(mine, name, _bands(products, bands, name), wanted)


def between(tiles: DataFrame, products: DataFrame, bands: DataFrame, name: str, start: int, stop: int,
            wanted: Sequence[int] = (), cap: int | None = None, **parts: int) -> DataFrame:
    """Tiles of one product in a date range with the given date parts, with a ``cap`` the first so many dates of each tile."""
    mine = _of_product(tiles, products, name)
    chosen = capped_dates(mine, ["z", "y", "x"], start, stop, cap, **parts)
    return _selected(chosen, name, _bands(products, bands, name), wanted)
