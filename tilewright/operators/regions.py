"""Regions of interest as horizontal pixel segments ``(roi_id, z, gy, x0, x1)``.

Segments are cut at tile edges, which turns "pixel in region" into an equi join on
(z, y, x, row) with a column range inside it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from tilewright.functions.grid import pixel_area_km2, resolution
from tilewright.functions.pixels import is_valid
from tilewright.operators.sides import BROADCAST_BYTES, fits_broadcast, hinted, row_bytes

ROI_KINDS = ("sys", "user")
_SAME_ROW = ("z", "y", "x", "row")


def region_segments(segments: DataFrame, roi_id: str) -> DataFrame:
    """Segments of one region given as ``sys:<n>``, ``user:<n>`` or a path naming a stored region table."""
    if not roi_id:
        raise ValueError("empty region id")
    if roi_id.split(":", 1)[0] in ROI_KINDS and ":" in roi_id:
        return segments.where(F.col("roi_id") == roi_id)
    return segments.sparkSession.read.parquet(roi_id)


def known_segments(segments: DataFrame, roi_ids: Sequence[str]) -> DataFrame:
    """Segments of all these regions (ids or paths) under the names given; ValueError for one that has none."""
    out = None
    for roi in dict.fromkeys(roi_ids):
        one = region_segments(segments, roi).withColumn("roi_id", F.lit(roi))
        if one.first() is None:
            raise ValueError(f"unknown region {roi!r}")
        out = one if out is None else out.unionByName(one.select(out.columns))
    return out


def runs(segments: DataFrame, by: Sequence[str], at_least: int = 1) -> DataFrame:
    """Disjoint runs (x0, x1) of each pixel row covered by ``at_least`` of its segments.

    One pass over the segment ends: +1 at a start, -1 after a stop, and a running count. No pair of
    segments is ever formed.
    """
    by = list(by)
    ends = F.explode(F.array(F.struct(F.col("x0").cast("long").alias("at"), F.lit(1).alias("step")),
                             F.struct((F.col("x1").cast("long") + 1).alias("at"), F.lit(-1).alias("step"))))
    # one shuffle serves both the sums and the windows
    steps = (segments.select(*by, ends.alias("e")).select(*by, "e.at", "e.step").repartition(*by)
             .groupBy(*by, "at").agg(F.sum("step").alias("step")).where("step <> 0"))
    order = Window.partitionBy(*by).orderBy("at")
    depth = steps.withColumn("depth", F.sum("step").over(order))
    # keep the places where coverage starts or ends; each start's run reaches to the next end
    within, before = F.col("depth") >= at_least, (F.col("depth") - F.col("step")) >= at_least
    borders = depth.withColumn("starts", within).where(within != before).withColumn("next", F.lead("at").over(order))
    return borders.where("starts").select(*by, F.col("at").alias("x0"), (F.col("next") - 1).alias("x1"))


def merged(segments: DataFrame) -> DataFrame:
    """Each region without overlaps between its own segments."""
    return runs(segments, ["roi_id", "z", "gy"])


def union_of(segments: DataFrame) -> DataFrame:
    """Disjoint runs covering every pixel of any region."""
    return runs(segments, ["z", "gy"])


def intersection_of(segments: DataFrame, roi_ids: Sequence[str]) -> DataFrame:
    """Disjoint runs of the pixels inside all the named regions."""
    wanted = set(roi_ids)
    chosen = merged(segments.where(F.col("roi_id").isin(*wanted)))
    return runs(chosen, ["z", "gy"], at_least=len(wanted))


def cut_to_tiles(segments: DataFrame, width: int, height: int) -> DataFrame:
    """Segments per tile row: adds y, x, row, first and last column c0..c1 and the row's pixel area."""
    w, h = F.lit(width).cast("long"), F.lit(height).cast("long")

    def div(c: Column, n: Column) -> Column:
        return F.call_function("div", c.cast("long"), n)

    keep = [c for c in segments.columns if c not in ("gy", "x0", "x1")]
    return (
        segments.withColumn("x", F.explode(F.sequence(div(F.col("x0"), w), div(F.col("x1"), w))))
        .select(
            *keep,
            div(F.col("gy"), h).cast("int").alias("y"), F.col("x").cast("int").alias("x"),
            (F.col("gy") % h).cast("int").alias("row"),
            F.greatest(F.col("x0") - F.col("x") * w, F.lit(0)).cast("int").alias("c0"),
            F.least(F.col("x1") - F.col("x") * w, w - 1).cast("int").alias("c1"),
            pixel_area_km2(F.col("z"), F.col("gy").cast("long"), width).alias("pixel_km2"),
        )
    )


class Regions:
    """Segments cut for one tile size, with the frames the jobs join to.

    Whether they may be broadcast is decided once, by adding up how many tile rows the segments
    touch: merging segments only lowers that number, so no derived frame has more rows.
    """

    def __init__(self, segments: DataFrame, width: int, height: int):
        self.segments, self.width, self.height = segments, width, height

    @cached_property
    def small(self) -> bool:
        w = F.lit(self.width).cast("long")
        touched = (F.call_function("div", F.col("x1").cast("long"), w) - F.call_function("div", F.col("x0").cast("long"), w) + 1)
        total = self.segments.agg(F.sum(touched)).first()[0] or 0
        return total * row_bytes(self._cuts) <= BROADCAST_BYTES

    @cached_property
    def _cuts(self) -> DataFrame:
        return cut_to_tiles(merged(self.segments), self.width, self.height)

    @property
    def cuts(self) -> DataFrame:
        """Cuts per region, overlaps inside a region removed: what the zonal statistics join with."""
        return hinted(self._cuts, self.small)

    @property
    def any_cuts(self) -> DataFrame:
        """Cuts covering the pixels of any region once."""
        runs_ = cut_to_tiles(union_of(self.segments), self.width, self.height)
        return hinted(runs_.select(*_SAME_ROW, "c0", "c1"), self.small)

    def touching(self, tiles: DataFrame) -> DataFrame:
        """Tiles that hold at least one region pixel. Run before pixels are exploded."""
        addresses = tiles_of(self.segments, self.width, self.height)
        return tiles.join(hinted(addresses, self.small), ["z", "y", "x"], "left_semi")

    def narrow(self, pixels: DataFrame) -> DataFrame:
        """Pixels of at least one region, each once: less to send before a shuffle."""
        return (pixels.join(self.any_cuts, list(_SAME_ROW))
                .where(F.col("col").between(F.col("c0"), F.col("c1"))).drop("c0", "c1"))


def tiles_of(segments: DataFrame, width: int, height: int) -> DataFrame:
    """Tile addresses touched by any of the segments."""
    w, h = F.lit(width).cast("long"), F.lit(height).cast("long")
    xs = F.sequence(F.call_function("div", F.col("x0").cast("long"), w), F.call_function("div", F.col("x1").cast("long"), w))
    return segments.select(
        "z", F.call_function("div", F.col("gy").cast("long"), h).cast("int").alias("y"), F.explode(xs).alias("x")
    ).distinct().withColumn("x", F.col("x").cast("int"))


def window_of(tiles: DataFrame, segments: DataFrame, width: int, height: int) -> DataFrame:
    """Tiles inside the tile range of the segments, per zoom, as plain predicates the scan can use.

    One aggregate over the segments gives one row per zoom; partitions and row groups outside are
    not read at all.
    """
    ranges = tiles_of(segments, width, height).groupBy("z").agg(
        F.min("y").alias("ymin"), F.max("y").alias("ymax"), F.min("x").alias("xmin"), F.max("x").alias("xmax")).collect()
    test = F.lit(False)
    for r in ranges:
        test = test | ((F.col("z") == r.z) & F.col("y").between(r.ymin, r.ymax) & F.col("x").between(r.xmin, r.xmax))
    return tiles.where(test)


def pixels_in_regions(pixels: DataFrame, cuts: DataFrame) -> DataFrame:
    """Inner join: each pixel once per region holding it, with roi_id and pixel_km2."""
    return (pixels.join(cuts.select(*_SAME_ROW, "c0", "c1", "roi_id", "pixel_km2"), list(_SAME_ROW))
            .where(F.col("col").between(F.col("c0"), F.col("c1"))).drop("c0", "c1"))


def clip(pixels: DataFrame, run_segments: DataFrame, fill: float, width: int, height: int) -> DataFrame:
    """Set ``dn`` outside the runs to the fill value; every pixel stays.

    ``run_segments`` must be disjoint: ``merged`` for one region, ``intersection_of`` for several.
    """
    cuts = cut_to_tiles(run_segments.select("z", "gy", "x0", "x1"), width, height).select(*_SAME_ROW, "c0", "c1")
    p, c = pixels.alias("p"), hinted(cuts, fits_broadcast(cuts)).alias("c")
    inside = F.col("p.col").between(F.col("c.c0"), F.col("c.c1"))
    for name in _SAME_ROW:
        inside = inside & (F.col(f"p.{name}") == F.col(f"c.{name}"))
    outside = F.lit(fill).cast(pixels.schema["dn"].dataType)
    return p.join(c, inside, "left").select(
        *[F.col(f"p.{n}") for n in pixels.columns if n != "dn"],
        F.when(F.col("c.row").isNotNull(), F.col("p.dn")).otherwise(outside).alias("dn"))


def mask_tiles(tiles: DataFrame, mask: DataFrame, low: float, high: float, fill: float,
               keys: Sequence[str] = ("z", "y", "x", "band")) -> DataFrame:
    """Keep ``dn`` where the mask tile's pixel is valid, else fill. Both sides hold pixel arrays.

    Arrays are zipped per tile, so nothing is shuffled per pixel. Tiles without a mask tile are dropped.
    """
    other = mask.select(*keys, F.col("dn").alias("_mask"))
    element = tiles.schema["dn"].dataType.elementType
    fill_lit = F.lit(fill).cast(element)
    return (
        tiles.join(other, list(keys))
        .withColumn("dn", F.zip_with("dn", "_mask", lambda v, m: F.when(is_valid(m, low, high, fill), v).otherwise(fill_lit)))
        .drop("_mask")
    )


def region_extents(segments: DataFrame, tile_size: int) -> DataFrame:
    """Bounding extent of every region in degrees."""
    reso = resolution(F.col("z"), tile_size)
    return segments.groupBy("roi_id").agg(
        F.min(F.col("x0") * reso - 180.0).alias("left"),
        F.max((F.col("x1") + 1) * reso - 180.0).alias("right"),
        F.max(F.lit(90.0) - F.col("gy") * reso).alias("top"),
        F.min(F.lit(90.0) - (F.col("gy") + 1) * reso).alias("bottom"),
    )


def common_extent(extents: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Extent shared by all rows of a group, never beyond the globe; inverted when there is none."""
    return extents.groupBy(*by).agg(
        F.greatest(F.max("left"), F.lit(-180.0)).alias("left"),
        F.least(F.min("right"), F.lit(180.0)).alias("right"),
        F.least(F.min("top"), F.lit(90.0)).alias("top"),
        F.greatest(F.max("bottom"), F.lit(-90.0)).alias("bottom"),
    )
