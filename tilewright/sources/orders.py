"""Job orders: JSON documents with the field names users already have."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tilewright.functions.dates import CollectionSpec, Period
from tilewright.operators.composite import check_method

# Order fields (fixed values).
STATISTIC_FIELDS = ("dsname string, jsfile string, roi string, filldata double, validMinInc double, validMaxInc double, "
                    "dt long, sdui string")
SERIES_FIELDS = (STATISTIC_FIELDS + ", method string, whole_start long, whole_start_inc int, whole_stop long, "
                 "whole_stop_inc int, repeat_start long, repeat_start_inc int, repeat_stop long, repeat_stop_inc int, "
                 "repeat_stopnextyear int, repeat_type string, baseddsname string, caller string")
TILE_FIELDS = ("jsfile string, roi string, filldata double, dt long, sdui string, mpid_hpid int, out_htable string, "
               "out_hcol long, out_hpidlen int, out_xylen int")


@dataclass(frozen=True)
class Order:
    """An order's values; fields it leaves out are None."""

    values: dict

    def __getattr__(self, name):
        try:
            return self.values[name]
        except KeyError:
            raise AttributeError(name) from None

    def dates(self) -> CollectionSpec:
        v = self.values
        whole = Period(v["whole_start"], v["whole_stop"], v["whole_start_inc"] != 0, v["whole_stop_inc"] != 0)
        if not v["repeat_type"]:
            return CollectionSpec(whole)
        repeat = Period(v["repeat_start"], v["repeat_stop"], v["repeat_start_inc"] != 0, v["repeat_stop_inc"] != 0)
        return CollectionSpec(whole, v["repeat_type"], repeat, v["repeat_stopnextyear"] or 0)


def read_order(spark: SparkSession, path: str, fields: str) -> Order:
    """One order from a JSON document; unknown fields are ignored, missing ones are None."""
    row = spark.read.schema(fields).option("multiLine", True).json(path).first()
    if row is None:
        raise ValueError(f"empty order: {path}")
    return Order(row.asDict())


def check_statistics(order: Order) -> Order:
    if not order.dsname and not order.jsfile:
        raise ValueError("order names neither a dataset nor a function")
    if not order.roi:
        raise ValueError("statistics need a region")
    return order


def check_series(order: Order) -> Order:
    check_statistics(order)
    check_method(order.method)
    return order


def check_script_series(order: Order) -> Order:
    if not order.baseddsname:
        raise ValueError("order names no base dataset")
    if not order.roi:
        raise ValueError("statistics need a region")
    if not order.caller:
        raise ValueError("order names no function to call")
    return order
