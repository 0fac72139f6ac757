"""Nearest earlier or later item of each probe (as-of joins) without a nested loop.

Work is cut into calendar slices. Inside a slice the nearest item is found by one window over the
distinct dates of items and probes. The edge item of a slice is also entered into the slices up to
the next one that has items, so no slice depends on another. A slice of one product holds at most as
many rows as it has distinct dates: neither a product with most of the probes nor a date that
repeats in them makes one task large. Rows of probes meet their answer by a join on the distinct dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tilewright.functions.dates import YEAR, int_div
from tilewright.operators.sides import fits_broadcast, hinted

# Order of rows sharing a date when going forward: carried items, items, probes. An item at the
# probe's date counts for "before"; going backward it comes last and so does not count for "after".
ITEM, PROBE = 0, 1
CARRIED_FORWARD, CARRIED_BACKWARD = -1, 2


def nearest_keys(keys: DataFrame, items: DataFrame, by: Sequence[str] = ("pid",), dt: str = "dt",
                 after: bool = False, slice_unit: int = YEAR) -> DataFrame:
    """Nearest item per distinct (``by``, ``dt``) of ``keys``; other columns of ``keys`` are kept.

    Adds fid, dt0, dt1 (null when there is none). Before: greatest dt0 <= dt. After: least dt0 > dt.
    Of items sharing a dt0 the smallest fid is taken.
    """
    by = list(by)
    extra = [c for c in keys.columns if c not in by + [dt]]
    # primitive aggregates throughout: a minimum over structs would sort instead of hash
    marks = items.groupBy(*by, "dt0").agg(F.min("fid").alias("fid"), F.min_by("dt1", "fid").alias("dt1"))
    item = F.struct("fid", "dt0", "dt1")
    in_slice = int_div(F.col("dt0"), slice_unit)

    pick, extreme = (F.min_by, F.min) if after else (F.max_by, F.max)
    edge = [pick("fid", "dt0").alias("fid"), extreme("dt0").alias("dt0"), pick("dt1", "dt0").alias("dt1")]
    next_slice = (F.lag if after else F.lead)("_s").over(Window.partitionBy(*by).orderBy("_s"))
    edges = marks.groupBy(*by, in_slice.alias("_s")).agg(*edge).withColumn("_next", next_slice).where("_next is not null")
    if after:
        reach, place, carried = F.sequence(F.col("_next"), F.col("_s") - 1), (F.col("_slice") + 1) * slice_unit - 1, CARRIED_BACKWARD
    else:
        reach, place, carried = F.sequence(F.col("_s") + 1, F.col("_next")), F.col("_slice") * slice_unit, CARRIED_FORWARD
    carry = edges.withColumn("_slice", F.explode(reach)).select(
        *by, "_slice", place.alias("_at"), F.lit(carried).alias("_tag"), item.alias("_item"))
    listed = marks.select(*by, in_slice.alias("_slice"), F.col("dt0").alias("_at"), F.lit(ITEM).alias("_tag"), item.alias("_item"))
    probes = keys.select(*by, int_div(F.col(dt), slice_unit).alias("_slice"), F.col(dt).cast("long").alias("_at"),
                         F.lit(PROBE).alias("_tag"), F.lit(None).cast(listed.schema["_item"].dataType).alias("_item"), *extra)
    events = probes.unionByName(listed.unionByName(carry), allowMissingColumns=True)

    def direction(name):
        return F.col(name).desc() if after else F.col(name).asc()

    order = (Window.partitionBy(*by, "_slice").orderBy(direction("_at"), direction("_tag"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = events.withColumn("_near", F.last("_item", ignorenulls=True).over(order)).where(F.col("_tag") == PROBE)

    # beyond the outermost slice with items only the outermost item is left
    last = marks.groupBy(*by).agg(*edge).select(*by, item.alias("_last"))
    usable = F.col("_last.dt0") > F.col("_at") if after else F.col("_last.dt0") <= F.col("_at")
    return (
        local.join(hinted(last, fits_broadcast(last)), by, "left")
        .withColumn("_hit", F.coalesce(F.col("_near"), F.when(usable, F.col("_last"))))
        .select(*by, F.col("_at").alias(dt), *extra,
                F.col("_hit.fid").alias("fid"), F.col("_hit.dt0").alias("dt0"), F.col("_hit.dt1").alias("dt1"))
    )


def _nearest_rows(probes: DataFrame, items: DataFrame, by: Sequence[str], dt: str, after: bool) -> DataFrame:
    by = list(by)
    hits = nearest_keys(probes.select(*by, dt).distinct(), items, by, dt, after)
    return probes.join(hits, [*by, dt], "left")


def nearest_before(probes: DataFrame, items: DataFrame, by: Sequence[str] = ("pid",), dt: str = "dt") -> DataFrame:
    """Every probe row with the last item starting at or before it."""
    return _nearest_rows(probes, items, by, dt, after=False)


def nearest_after(probes: DataFrame, items: DataFrame, by: Sequence[str] = ("pid",), dt: str = "dt") -> DataFrame:
    """Every probe row with the first item starting strictly after it."""
    return _nearest_rows(probes, items, by, dt, after=True)


def with_contained(hits: DataFrame, dt: str = "dt") -> DataFrame:
    """Flag probes inside the found item's period ``[dt0, dt1)``; false means only the nearest earlier one."""
    return hits.withColumn("contained", F.col("dt0").isNotNull() & (F.col(dt) >= F.col("dt0")) & (F.col(dt) < F.col("dt1")))


def with_default_date(requests: DataFrame, items: DataFrame, by: Sequence[str] = ("pid",), dt: str = "dt") -> DataFrame:
    """Replace date 0 by the product's first item date."""
    by = list(by)
    first = items.groupBy(*by).agg(F.min("hcol").alias("_first"))
    # a product with most of the requests is one reducer only where its items are too many to broadcast
    return (requests.join(hinted(first, fits_broadcast(first)), by, "left")
            .withColumn(dt, F.coalesce(F.nullif(F.col(dt), F.lit(0)), F.col("_first"))).drop("_first"))
