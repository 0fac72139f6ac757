"""The plate-carrée tile pyramid: ``2^z`` columns and ``max(1, 2^z / 2)`` rows from lon -180, lat 90.

Three address rules differ at the right and bottom edge and are kept as three functions:
``tile_of_point_strict`` steps back one tile, ``tile_of_point_clamped`` clamps, and
``pixel_of_point`` rounds and does neither.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TILE_SIZE = 256
MAX_ZOOM = 21
EARTH_RADIUS_KM = 6371.0088


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def tile_columns(z) -> Column:
    """Number of tile columns at a zoom, as a double: exact, and no zoom overflows it."""
    return F.pow(F.lit(2.0), _col(z))


def tile_rows(z) -> Column:
    return F.greatest(F.lit(1.0), tile_columns(z) / 2)


def resolution(z, tile_size: int = TILE_SIZE) -> Column:
    """Degrees per pixel."""
    return F.lit(360.0) / (tile_columns(z) * tile_size)


def tile_bounds(z, y, x, tile_size: int = TILE_SIZE) -> Column:
    """Struct of left, right, top, bottom; at z=0 the tile's lower half lies below the globe."""
    size = resolution(z, tile_size) * tile_size
    left = _col(x) * size - 180.0
    top = F.lit(90.0) - _col(y) * size
    return F.struct(left.alias("left"), (left + size).alias("right"), top.alias("top"), (top - size).alias("bottom"))


def _tile_index(distance: Column, reso: Column, count: Column, tile_size: int) -> Column:
    """Tile at a distance in degrees from the origin; the far edge belongs to the last tile."""
    return F.least(F.floor(F.floor(distance / reso) / tile_size), count - 1).cast("int")


def tile_of_point_strict(lon: Column, lat: Column, z, tile_size: int = TILE_SIZE) -> Column:
    """Tile of a point and its bounds; all fields are null off the globe or off the zoom range.

    Only x and y are conditional and the struct itself is not, so that Spark computes each once
    and the generated code stays small enough to be compiled.
    """
    ok = lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0) & _col(z).between(0, MAX_ZOOM)
    reso = resolution(z, tile_size)
    x = F.when(ok, _tile_index(lon + 180.0, reso, tile_columns(z), tile_size))
    y = F.when(ok, _tile_index(F.lit(90.0) - lat, reso, tile_rows(z), tile_size))
    size = reso * tile_size
    left, top = x * size - 180.0, F.lit(90.0) - y * size
    return F.struct(x.alias("x"), y.alias("y"), left.alias("left"), (left + size).alias("right"), top.alias("top"),
                    (top - size).alias("bottom"))


def tile_of_point_clamped(lon: Column, lat: Column, z, tile_size: int = TILE_SIZE) -> Column:
    """Tile of a point; points outside the globe go to the nearest edge tile."""
    nx, ny = tile_columns(z), tile_rows(z)
    reso = F.lit(360.0) / nx / tile_size

    def tile(distance, count):
        return F.greatest(F.lit(0.0), F.least(count - 1, F.floor(distance / reso / tile_size))).cast("int")

    return F.struct(tile(lon + 180.0, nx).alias("x"), tile(F.lit(90.0) - lat, ny).alias("y"))


def pixel_of_point(lon: Column, lat: Column, z, width: int = TILE_SIZE, height: int = TILE_SIZE) -> Column:
    """Tile, pixel column and pixel row of a point by rounding; the far edge overflows to the next tile."""
    n = tile_columns(z)
    full_x = ((lon + 180.0) / (F.lit(360.0) / n / width) + 0.5).cast("long")
    full_y = ((F.lit(90.0) - lat) / (F.lit(180.0) / (n / 2.0) / height) + 0.5).cast("long")
    w, h = F.lit(width).cast("long"), F.lit(height).cast("long")
    return F.struct(
        F.call_function("div", full_y, h).cast("int").alias("y"),
        F.call_function("div", full_x, w).cast("int").alias("x"),
        (full_x % w).cast("int").alias("col"),
        (full_y % h).cast("int").alias("row"),
    )


def tile_range(left: Column, right: Column, top: Column, bottom: Column, z, tile_size: int = TILE_SIZE) -> Column:
    """Inclusive tile range of an extent at one zoom, with its bounds.

    All fields are null when a corner is off the globe or the zoom off its range.
    """
    ok = _col(z).between(0, MAX_ZOOM)
    for lon in (left, right):
        ok = ok & lon.between(-180.0, 180.0)
    for lat in (top, bottom):
        ok = ok & lat.between(-90.0, 90.0)
    reso = resolution(z, tile_size)
    size = reso * tile_size
    xmin, xmax = (F.when(ok, _tile_index(v + 180.0, reso, tile_columns(z), tile_size)) for v in (left, right))
    ymin, ymax = (F.when(ok, _tile_index(F.lit(90.0) - v, reso, tile_rows(z), tile_size)) for v in (top, bottom))
    return F.struct(
        xmin.alias("xmin"), xmax.alias("xmax"), ymin.alias("ymin"), ymax.alias("ymax"),
        (xmin * size - 180.0).alias("left"), (xmax * size - 180.0 + size).alias("right"),
        (F.lit(90.0) - ymin * size).alias("top"), (F.lit(90.0) - ymax * size - size).alias("bottom"))


def parse_extent(text: Column) -> Column:
    """``"left,right,top,bottom"`` to a struct of doubles; all fields are null unless there are four numbers."""
    numbers = F.transform(F.split(F.regexp_replace(text, ",+$", ""), ","), lambda p: p.try_cast("double"))
    complete = (F.size(numbers) == 4) & F.forall(numbers, lambda n: n.isNotNull())
    kept = F.when(complete, numbers)
    return F.struct(*[F.get(kept, F.lit(i)).alias(n) for i, n in enumerate(("left", "right", "top", "bottom"))])


# Half of a level-0 pixel in degrees (fixed value).
HALF_PIXEL = 1.40625 / 2


def grow_extent(left: Column, right: Column, top: Column, bottom: Column) -> Column:
    """Grow by half a level-0 pixel on every side, staying on the globe."""
    return F.struct(
        F.greatest(F.lit(-180.0), left - HALF_PIXEL).alias("left"),
        F.least(F.lit(180.0), right + HALF_PIXEL).alias("right"),
        F.least(F.lit(90.0), top + HALF_PIXEL).alias("top"),
        F.greatest(F.lit(-90.0), bottom - HALF_PIXEL).alias("bottom"),
    )


def pixel_area_km2(z, global_row: Column, tile_size: int = TILE_SIZE) -> Column:
    """Area of one pixel of a pixel row on the sphere: ``R^2 * dlon * (sin(top) - sin(bottom))``."""
    reso = resolution(z, tile_size)
    top = F.sin(F.radians(F.lit(90.0) - global_row * reso))
    bottom = F.sin(F.radians(F.lit(90.0) - (global_row + 1) * reso))
    return F.lit(EARTH_RADIUS_KM * EARTH_RADIUS_KM) * F.radians(reso) * (top - bottom)
