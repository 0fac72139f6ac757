"""Tiles holding pixel arrays: explode, band choice, lookup, window export, tile maths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tilewright.functions.dates import MONTH, has_parts
from tilewright.functions.grid import pixel_of_point
from tilewright.operators.sides import fits_broadcast, hinted


def explode_pixels(tiles: DataFrame, column: str = "dn") -> DataFrame:
    """One row per pixel: pos, row and col inside the tile, and its value."""
    rest = [c for c in tiles.columns if c != column]
    return (
        tiles.select(*rest, F.posexplode(column).alias("pos", column))
        .withColumn("row", F.call_function("div", F.col("pos"), F.col("width")).cast("int"))
        .withColumn("col", (F.col("pos") % F.col("width")).cast("int"))
    )


def dated(tiles: DataFrame, start: int, stop: int) -> DataFrame:
    """Tiles of a date range; where the table's month column is there, its bounds become partition filters."""
    chosen = tiles.where(F.col("hcol").between(start, stop))
    return chosen.where(F.col("ym").between(start // MONTH, stop // MONTH)) if "ym" in tiles.columns else chosen


def good_tiles(tiles: DataFrame) -> DataFrame:
    """Drop failed tiles."""
    return tiles.where("status = 0")


def status_counts(tiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Good and bad tiles, counted by a query: retried tasks cannot count twice."""
    return tiles.groupBy(*by).agg(
        F.count_if(F.col("status") == 0).alias("good"), F.count_if(F.col("status") != 0).alias("bad"))


def with_bands(tiles: DataFrame, bands: DataFrame) -> DataFrame:
    """Tiles with the columns ``bands`` has for their band, before their pixels are taken apart; a band it lacks has no rows.

    A product has few bands, so a join by band would bring all tiles to a few tasks: the bands are copied to the tiles. If they
    are too many for that, tiles move as whole rows.
    """
    return tiles.join(hinted(bands, fits_broadcast(bands)), "band")


def select_bands(tiles: DataFrame, bands: Sequence[int], n_bands: int) -> DataFrame:
    """Chosen bands in the asked order as ``out_band``; an empty list means all."""
    wanted = list(bands) or list(range(n_bands))
    bad = [b for b in wanted if not 0 <= b < n_bands]
    if bad:
        raise ValueError(f"band index out of range: {bad}")
    # one row per use, so a band asked for twice comes out twice
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for i, b in enumerate(wanted)])
    uses = F.filter(places, lambda p: p["b"] == F.col("band"))
    return tiles.where(F.col("band").isin(*set(wanted))).withColumn("_use", F.explode(uses)).withColumn(
        "out_band", F.col("_use.i")).drop("_use")


def capped_dates(cells: DataFrame, by: Sequence[str], start: int, stop: int, cap: int | None = None, date: str = "hcol",
                 **parts: int) -> DataFrame:
    """Cells in [start, stop] with the given date parts; with a ``cap``, on the first so many dates of each group.

    The store read of old had a cap of 30 dates, which a caller has to ask for. Only keys and
    dates are ranked; each group's last admitted date is joined back as a bound, so cell data moves
    only when the bounds are too many to broadcast.
    """
    chosen = (dated(cells, start, stop) if date == "hcol" else cells.where(F.col(date).between(start, stop))).where(has_parts(F.col(date), **parts))
    if cap is None:
        return chosen
    # Spark keeps the first `cap` of a group before the shuffle too (a rank filter over a window), so
    # a group with most of the rows does not pile up.
    order = Window.partitionBy(*by).orderBy(date)
    ranked = chosen.select(*by, date).distinct().withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= cap)
    bounds = ranked.where(F.col("_rank") == cap).select(*by, F.col(date).alias("_last"))
    bounded = chosen.join(hinted(bounds, fits_broadcast(bounds)), list(by), "left")
    return bounded.where(F.col("_last").isNull() | (F.col(date) <= F.col("_last"))).drop("_last")


def lookup_points(points: DataFrame, tiles: DataFrame, z: int, width: int, height: int, per_row: int = 4096) -> DataFrame:
    """Values of every band and date at lon/lat points; points without a tile have no rows.

    Only pixels with a point leave the tiles, each value once a list of points; the points of a pixel meet them there (``at_pixels``).
    """
    at = points.withColumn("_p", pixel_of_point(F.col("lon"), F.col("lat"), z, width, height)).select(
        *points.columns, *[F.col(f"_p.{c}").alias(c) for c in PIXEL])
    # as many rows as pixels asked for, and more only for pixels with more than per_row points
    wanted = pixel_lists(at, PIXEL, per_row).withColumnsRenamed({"y": "_y", "x": "_x"})
    cut = tiles.where(F.col("z") == z).join(
        hinted(wanted, fits_broadcast(wanted)), (F.col("y") == F.col("_y")) & (F.col("x") == F.col("_x")))
    rest = [c for c in tiles.columns if c not in ("z", "y", "x", "dn")]
    values = cut.select(F.col("_y").alias("y"), F.col("_x").alias("x"), "row", "col", "_part", *rest,
                        F.get("dn", F.col("row") * width + F.col("col")).alias("value"))
    hits = at_pixels(at, values, PIXEL, points.columns, per_row)
    return hits.select(F.lit(z).alias("z"), "y", "x", *points.columns, "col", "row", *rest, "value")


PIXEL = ("y", "x", "row", "col")


def pixel_lists(points: DataFrame, pixel: Sequence[str], per_row: int) -> DataFrame:
    """The pixels that have a point, once for each list ``_part`` of at most ``per_row`` points that ``at_pixels`` makes of them."""
    counts = points.groupBy(*pixel).agg(F.count(F.lit(1)).alias("_n"))
    last = F.call_function("div", F.col("_n") - 1, F.lit(per_row))
    return counts.select(*pixel, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_part"))


def at_pixels(points: DataFrame, values: DataFrame, pixel: Sequence[str], columns: Sequence[str], per_row: int) -> DataFrame:
    """Every point with every value of its pixel. ``pixel`` names the columns of both that address it, ``columns`` those of the points.

    The points of a pixel are gathered, at most ``per_row`` to a row, and only these lists are joined. ``values`` has a row
    for each of them (``pixel_lists``), and the lists are spread last, value by value, so the rows of a date, band and value
    stand together: a written result has points times dates of rows, but its columns are runs and repeated lists.

    A join hands on all that it finds for a row of its left side at once. Values stand there, and each finds one list, so
    a task holds ``per_row`` rows and not points times values of a pixel. The lists of a crowded pixel are several tasks' work. The
    number of tasks is given, as the bytes they read, by which Spark would bring them together, don't tell how many rows they make.
    """
    # ordered by the points themselves: a list that is made again holds the same
    place = F.row_number().over(Window.partitionBy(*pixel).orderBy(*columns))
    numbered = points.select(*dict.fromkeys([*pixel, *columns])).withColumn("_part", F.call_function("div", place - 1, F.lit(per_row)))
    key = [*pixel, "_part"]
    lists = numbered.groupBy(*key).agg(F.collect_list(F.struct(*columns)).alias("_points"))
    rest = [c for c in values.columns if c not in key]
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = values.repartition(tasks, *key).join(lists.repartition(tasks, *key).hint("merge"), key)
    spread = met.select(*pixel, *rest, F.explode("_points").alias("_point"))
    return spread.select(*pixel, *[F.col(f"_point.{c}").alias(c) for c in columns], *rest)


def in_range(tiles: DataFrame, z: int, tile_range: Column | dict) -> DataFrame:
    """Tiles of one zoom inside an inclusive tile range; plain predicates reach the scan."""
    r = tile_range
    return tiles.where((F.col("z") == z) & F.col("y").between(r["ymin"], r["ymax"]) & F.col("x").between(r["xmin"], r["xmax"]))


def combine_tiles(a: DataFrame, b: DataFrame, pair, keys: Sequence[str] = ("z", "y", "x", "band")) -> DataFrame:
    """Pixelwise function of two tile sets: ``pair`` maps two value columns to one.

    Used for user expressions over two dates or datasets; Catalyst sees the expression and the
    arrays stay whole.
    """
    other = b.select(*keys, F.col("dn").alias("_dn"))
    return a.join(other, list(keys)).withColumn("dn", F.zip_with("dn", "_dn", pair)).drop("_dn")


def covering_tiles(extents: DataFrame, tile_range_of, zooms: Sequence[int]) -> DataFrame:
    """All tiles of the zooms inside each row's extent (columns left, right, top, bottom)."""
    zs = F.explode(F.array(*[F.lit(z) for z in zooms]))
    ranged = extents.withColumn("z", zs).withColumn(
        "_r", tile_range_of(F.col("left"), F.col("right"), F.col("top"), F.col("bottom"), F.col("z")))
    # an inverted or off-globe extent has no tiles
    ok = (F.col("_r.ymin") <= F.col("_r.ymax")) & (F.col("_r.xmin") <= F.col("_r.xmax"))
    return (
        ranged.where(ok)
        .withColumn("y", F.explode(F.sequence(F.col("_r.ymin"), F.col("_r.ymax"))))
        .withColumn("x", F.explode(F.sequence(F.col("_r.xmin"), F.col("_r.xmax"))))
        .drop("_r")
    )
