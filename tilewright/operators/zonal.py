"""Zonal statistics: per tile first, then merged per key and region.

The merge keeps only tiles with at least one valid pixel (``merge="reference"``), which is why the
two levels cannot be folded into one aggregate. Where every tile of a group is empty, the tile with
the smallest (y, x) stands for it. ``merge="all"`` adds up every tile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.functions.pixels import is_valid
from tilewright.operators.regions import pixels_in_regions

STATS = ("sum", "sq_sum", "valid_cnt", "valid_min", "valid_max", "area_km2", "all_cnt", "fill_cnt")


def tile_stats(pixels: DataFrame, cuts: DataFrame, low: float, high: float, fill: float,
               keys: Sequence[str] = ()) -> DataFrame:
    """Statistics of every (``keys``, region, band, tile)."""
    dn = F.col("dn").cast("double")
    valid = is_valid(F.col("dn"), low, high, fill)

    def of_valid(c: Column) -> Column:
        return F.when(valid, c)

    inside = pixels_in_regions(pixels, cuts)
    store = [F.min("hpid").alias("hpid"), F.max("hpid").alias("hpid_to")] if "hpid" in pixels.columns and "hpid" not in keys else []
    return inside.groupBy(*keys, "roi_id", "band", "z", "y", "x").agg(
        F.coalesce(F.sum(of_valid(dn)), F.lit(0.0)).alias("sum"),
        F.coalesce(F.sum(of_valid(dn * dn)), F.lit(0.0)).alias("sq_sum"),
        F.count(of_valid(F.lit(1))).alias("valid_cnt"),
        F.coalesce(F.min(of_valid(dn)), F.lit(0.0)).alias("valid_min"),
        F.coalesce(F.max(of_valid(dn)), F.lit(0.0)).alias("valid_max"),
        F.coalesce(F.sum(of_valid(F.col("pixel_km2"))), F.lit(0.0)).alias("area_km2"),
        F.count(F.lit(1)).alias("all_cnt"),
        F.count(F.when(F.col("dn") == F.lit(fill), F.lit(1))).alias("fill_cnt"), *store,
    )


def merge_stats(stats: DataFrame, keys: Sequence[str] = (), merge: str = "reference",
                then_by: str | None = None) -> DataFrame:
    """Merge tile statistics per (``keys``, region, band) and add mean and stddev.

    Where tiles name their store block (``hpid``), two of them under one key are an error: band 0 of the one is not band 0 of the other.

    ``then_by`` orders rows of one tile (several dates under one key) where the first empty one is needed.
    """
    if merge not in ("reference", "all"):
        raise ValueError(f"unknown merge mode {merge!r}")
    some = F.col("valid_cnt") > 0
    # One number orders tiles by (y, x): min_by on it stays a hash aggregate, on a struct it would sort.
    order = F.col("y").cast("long") * (1 << 22) + F.col("x")
    if then_by is not None:
        order = order.cast("decimal(18,0)") * F.lit(10**14).cast("decimal(15,0)") + F.col(then_by).cast("decimal(15,0)")

    def total(name: str) -> Column:
        if merge == "all":
            return F.sum(name)
        empty = F.when(~some, order)
        return F.coalesce(F.sum(F.when(some, F.col(name))), F.min_by(F.col(name), empty))

    last = "hpid_to" if "hpid_to" in stats.columns else "hpid"
    store = [F.min("hpid").alias("_lo"), F.max(last).alias("_hi")] if "hpid" in stats.columns and "hpid" not in keys else []
    grouped = stats.groupBy(*keys, "roi_id", "band").agg(
        *store, *[total(n).alias(n) for n in ("sum", "sq_sum", "valid_cnt", "area_km2", "all_cnt", "fill_cnt")],
        F.coalesce(F.min(F.when(some, F.col("valid_min"))), F.lit(0.0)).alias("valid_min"),
        F.coalesce(F.max(F.when(some, F.col("valid_max"))), F.lit(0.0)).alias("valid_max"),
    )
    if store:
        mixed = F.raise_error(F.lit("tiles of several store blocks (hpid) of one dataset: choose bands first")).cast("bigint")
        grouped = grouped.withColumn("valid_cnt", F.when(F.col("_lo") < F.col("_hi"), mixed).otherwise(F.col("valid_cnt")))
    return with_moments(grouped.select(*keys, "roi_id", "band", *STATS))


def with_moments(stats: DataFrame) -> DataFrame:
    """Mean and population standard deviation; 0 when nothing is valid."""
    some, n = F.col("valid_cnt") > 0, F.col("valid_cnt")
    mean = F.col("sum") / n
    spread = F.sqrt(F.greatest(F.col("sq_sum") / n - mean * mean, F.lit(0.0)))
    return (stats.withColumn("mean", F.when(some, mean).otherwise(0.0))
            .withColumn("stddev", F.when(some, spread).otherwise(0.0)))
