"""Statistics of whole tiles, kept beside a tile table, so that only tiles on a region's border are read."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tilewright.functions.dates import int_div
from tilewright.functions.grid import pixel_area_km2
from tilewright.operators.blocks import SHAPE, TILE, _block_arrays, _schema, cuts_per_tile, stats_of_cuts
from tilewright.operators.pixels import good_tiles
from tilewright.operators.regions import Regions
from tilewright.operators.zonal import STATS, merge_stats

# What names a tile, as far as a table has it.
ADDRESS = ("dsname", "pid", "hpid", "hcol", *TILE)
# Neighbourhoods of border tiles that may stand in the scan's filter one by one, and their side in tiles.
NEAR, SIDE = 256, 16


def tile_summaries(blocks: DataFrame, low: float, high: float, fill: float) -> DataFrame:
    """The statistics that every band of every good tile has as a whole, for one valid range and fill value: one small row each.

    Kept as a table in the layout of the tiles, it serves ``zonal_stats_summed`` for that range. No exchange.
    """
    address = [c for c in ADDRESS if c in blocks.columns]
    area = F.transform(F.sequence(F.lit(0), F.col("height") - 1), lambda r: pixel_area_km2(F.col("z"), F.col("y").cast("long") * F.col("height") + r, F.col("width")))
    work = (good_tiles(blocks) if "status" in blocks.columns else blocks).select(*address, *SHAPE, area.alias("km2"), "data")
    schema = _schema([work.schema[c] for c in address], "band int, sum double, sq_sum double, valid_cnt long, valid_min double, valid_max double, "
                     "area_km2 double, all_cnt long, fill_cnt long")

    def summed(batches):
        for batch in batches:
            at, rows = [], []
            for i, block in enumerate(_block_arrays(batch)):
                if block is None:
                    continue
                km2 = np.asarray(batch.column("km2")[i].values)
                for band in range(block.shape[0]):
                    v = block[band].astype("f8")
                    is_fill = np.isnan(v) if np.isnan(fill) else v == fill
                    ok = ~is_fill & (v >= low) & (v <= high)
                    vv, n = np.where(ok, v, 0.0), int(ok.sum())
                    rows.append((band, vv.sum(), (vv * vv).sum(), n, v[ok].min() if n else 0.0, v[ok].max() if n else 0.0,
                                 float(ok.sum(axis=1) @ km2), v.size, int(is_fill.sum())))
                    at.append(i)
            if at:
                added = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*batch.select(address).take(pa.array(at)).columns, *added], schema.fieldNames())

    types = [pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    return work.mapInArrow(summed, schema)


def _near(tiles: DataFrame, border: DataFrame) -> DataFrame:
    """``tiles`` in neighbourhoods that hold a border tile, as constants that reach the scan, unless these are very many."""
    places = border.select("z", int_div(F.col("y"), SIDE).alias("ny"), int_div(F.col("x"), SIDE).alias("nx")).distinct().limit(NEAR + 1).collect()
    if len(places) > NEAR:
        return tiles
    test = F.lit(False)
    for z, ny, nx in places:
        test = test | ((F.col("z") == z) & F.col("y").between(ny * SIDE, ny * SIDE + SIDE - 1) & F.col("x").between(nx * SIDE, nx * SIDE + SIDE - 1))
    return tiles.where(test)


def zonal_stats_summed(blocks: DataFrame, summaries: DataFrame, regions: Regions, low: float, high: float, fill: float,
                       keys: Sequence[str] = (), merge: str = "reference") -> DataFrame:
    """Rows of ``zonal_stats_blocks`` from the tiles' ``summaries`` (of the same range and fill) and the pixels of border tiles.

    A tile all of whose pixels a region has gives its summary, joined by address: no ``data`` of it is used, and neighbourhoods without a
    border tile are not read. A tile without a summary is an error, so a table that lags behind is noticed.
    """
    keys, blocks = list(keys), good_tiles(blocks)
    address = [c for c in ADDRESS if c in blocks.columns and c in summaries.columns]
    whole = (regions.cuts.groupBy(*TILE, "roi_id").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("n"))
             .where(F.col("n") == regions.width * regions.height).drop("n"))
    whole = F.broadcast(whole) if regions.small else whole
    border = regions.cuts.join(whole, [*TILE, "roi_id"], "left_anti")
    names = list(dict.fromkeys([*keys, *address]))
    inner = blocks.select(*names).join(whole, list(TILE)).join(summaries.select(*address, "band", *STATS), address, "left")
    missing = F.raise_error(F.lit("a tile has no summary: bring the table of summaries up to date")).cast("int")
    store = ["hpid"] if "hpid" in names and "hpid" not in keys else []
    columns = [*keys, *TILE, *store, "roi_id", "band", *STATS]
    columns = list(dict.fromkeys(columns))
    inner = inner.withColumn("band", F.when(F.col("band").isNull(), missing).otherwise(F.col("band"))).select(*columns)
    outer = stats_of_cuts(_near(blocks, border), cuts_per_tile(border, regions.small), low, high, fill, keys).select(*columns)
    return merge_stats(outer.unionByName(inner), keys, merge)
