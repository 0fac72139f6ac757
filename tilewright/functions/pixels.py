"""Pixel types, validity, physical values and classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Element type codes (fixed values): little-endian numpy type and the Spark type wide enough for it.
PIXEL_TYPES = {
    1: ("<u1", "short"),
    2: ("<u2", "int"),
    3: ("<i2", "short"),
    4: ("<u4", "long"),
    5: ("<i4", "int"),
    6: ("<f4", "float"),
    7: ("<f8", "double"),
}
BYTE_WIDTHS = {1: 1, 2: 2, 3: 2, 4: 4, 5: 4, 6: 4, 7: 8}


def byte_width(data_type: Column) -> Column:
    """Bytes per element; 0 for an unknown code."""
    width = F.lit(0)
    for code, n in BYTE_WIDTHS.items():
        width = F.when(data_type == code, F.lit(n)).otherwise(width)
    return width


def is_valid(dn: Column, low: float, high: float, fill: float) -> Column:
    """Inside the closed range and not the fill value."""
    return (dn != F.lit(fill)) & dn.between(F.lit(low), F.lit(high))


def physical(dn: Column, scale: Column, offset: Column) -> Column:
    return scale * dn + offset


def classify_ranges(value: Column, ranges: Sequence[tuple[float, float]]) -> Column:
    """Index of the first closed range holding the value, else null."""
    index = F.lit(None).cast("int")
    for i in reversed(range(len(ranges))):
        low, high = ranges[i]
        index = F.when(value.between(F.lit(low), F.lit(high)), F.lit(i)).otherwise(index)
    return index


def classify_stops(value: Column, stops: Sequence[float], kind: str) -> Column:
    """Place of a value among ascending colour stops.

    ``exact``: index of the equal stop, else null. ``discrete``: index of the last stop not above the
    value, else null. ``linear``: fractional index, interpolated between neighbours and held at both ends.
    """
    if list(stops) != sorted(set(stops)) or not stops:
        raise ValueError("stops must be ascending and distinct")
    if kind == "exact":
        place = F.lit(None).cast("int")
        for i, s in enumerate(stops):
            place = F.when(value == F.lit(s), F.lit(i)).otherwise(place)
        return place
    if kind == "discrete":
        place = F.lit(None).cast("int")
        for i, s in enumerate(stops):
            place = F.when(value >= F.lit(s), F.lit(i)).otherwise(place)
        return place
    if kind == "linear":
        place = F.when(value.isNotNull(), F.lit(0.0))
        for i, (a, b) in enumerate(zip(stops, stops[1:])):
            step = F.lit(float(i)) + (value - F.lit(float(a))) / F.lit(float(b - a))
            place = F.when(value >= F.lit(a), step).otherwise(place)
        return F.when(value >= F.lit(stops[-1]), F.lit(float(len(stops) - 1))).otherwise(place)
    raise ValueError(f"unknown style kind {kind!r}")
