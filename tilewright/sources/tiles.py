"""The tile table: Parquet partitioned by (dsname, z, ym), rows sorted by (y, x, hcol) inside files.

``ym`` is ``hcol div 10^8``. It exists only to prune: readers keep it and add its predicate to every test of dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions.dates import MONTH, int_div
from tilewright.functions.keys import encode_key
from tilewright.operators.pixels import dated
from tilewright.operators.sides import fits_broadcast, hinted

CELL = ("dsname", "hpid", "hcol", "z", "y", "x")


def read_tiles(spark: SparkSession, path: str, dsname: str | None = None, z: int | None = None,
               start: int | None = None, stop: int | None = None) -> DataFrame:
    """Tiles of a table; dataset, zoom and date range become partition filters."""
    tiles = spark.read.parquet(path)
    if dsname is not None:
        tiles = tiles.where(F.col("dsname") == dsname)
    if z is not None:
        tiles = tiles.where(F.col("z") == z)
    if start is not None:
        tiles = tiles.where((F.col("ym") >= start // MONTH) & (F.col("hcol") >= start))
    if stop is not None:
        tiles = tiles.where((F.col("ym") <= stop // MONTH) & (F.col("hcol") <= stop))
    return tiles


def tile_cell(tiles: DataFrame, hpid: int, hcol: int, z: int, y: int, x: int) -> DataFrame:
    """One cell by its key; no row when absent."""
    c = F.col
    return dated(tiles, hcol, hcol).where((c("hpid") == hpid) & (c("z") == z) & (c("y") == y) & (c("x") == x))


def cell_by_row_key(cells: DataFrame, pid: int, z: int, y: int, x: int, pid_bytes: int, yx_bytes: int) -> DataFrame:
    """Binary cells of a table kept under store row keys."""
    key = encode_key(*[F.lit(v) for v in (pid, z, y, x)], pid_bytes, yx_bytes)
    return cells.where(F.col("row_key") == key)


def tiles_on_dates(tiles: DataFrame, dates: DataFrame) -> DataFrame:
    """Tiles of the listed dates (column ``hcol``); missing dates are skipped."""
    wanted = dates.select("hcol").distinct()
    return in_months(tiles, wanted).join(hinted(wanted, fits_broadcast(wanted)), "hcol", "left_semi")


def in_months(tiles: DataFrame, dates: DataFrame) -> DataFrame:
    """Tiles in the months of the dates: a list of at most twelve numbers a year that becomes a partition filter."""
    if "ym" not in tiles.columns:
        return tiles
    months = [m for (m,) in dates.select(int_div(F.col("hcol"), MONTH)).distinct().collect() if m is not None]
    return tiles.where(F.col("ym").isin(months) if months else F.lit(False))


def newest(cells: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The newest version of each cell. Keys only are ranked; the winner's columns come along once."""
    others = [c for c in cells.columns if c not in keys]
    best = cells.groupBy(*keys).agg(F.max_by(F.struct(*others), version).alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in others])
