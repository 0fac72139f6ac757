"""Composite over dates, pixel-row form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tilewright.functions.pixels import is_valid

# Methods with their result element type: ave and sum give 32-bit floats (fixed values).
METHODS = {"min": "long", "max": "long", "ave": "float", "sum": "float"}
PIXEL_KEYS = ("z", "y", "x", "band", "pos")


def check_method(method: str) -> str:
    if method not in METHODS:
        raise ValueError(f"unknown composite method {method!r}")
    return method


def composite(pixels: DataFrame, method: str, low: float, high: float, fill: float,
              keys: Sequence[str] = PIXEL_KEYS) -> DataFrame:
    """Combine the valid values of each pixel over its dates; pixels without one get the fill value.

    All four methods aggregate partially before the shuffle, so one row per pixel and task is sent. Pixels of several store
    blocks (``hpid``) under one key are an error.
    """
    check_method(method)
    dn = F.when(is_valid(F.col("dn"), low, high, fill), F.col("dn"))
    value = {"min": F.min(dn), "max": F.max(dn), "ave": F.avg(dn.cast("double")), "sum": F.sum(dn.cast("double"))}[method]
    kind = pixels.schema["dn"].dataType if METHODS[method] == "long" else METHODS[method]
    done = F.coalesce(value.cast(kind), F.lit(fill).cast(kind))
    if "hpid" in pixels.columns and "hpid" not in keys:
        mixed = F.raise_error(F.lit("tiles of several store blocks (hpid) of one dataset: choose bands first")).cast(kind)
        done = F.when(F.min("hpid") < F.max("hpid"), mixed).otherwise(done)
    return pixels.groupBy(*keys).agg(done.alias("dn"))
