"""Date collections: which acquisition dates are worked on together.

A collection is kept in long form, one row per (product, key, date), so that it joins to tiles on
the date and never becomes one large array on the way. ``collection_arrays`` builds the array form
for listings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.functions.dates import (
    DAY, MONTH, PARTS, YEAR, CollectionSpec, Period, date_part, day_key, has_parts, in_period, int_div,
)


def _cut(period: Period, unit: int) -> Period:
    """Both ends cut down to the start of their month or year."""
    return Period(period.start // unit * unit, period.stop // unit * unit,
                  period.start_inclusive, period.stop_inclusive)


def build_collections(items: DataFrame, spec: CollectionSpec, by: Sequence[str] = ("pid",)) -> DataFrame:
    """Rows (``by``, key, hcol, n_items) of the items' dates that fall into each collection.

    A date listed by several items of one product appears once, with their number in ``n_items``.
    Collections without a date have no rows.
    """
    dates = items.groupBy(*by, "hcol").agg(F.count(F.lit(1)).alias("n_items"))
    hcol = F.col("hcol")
    if spec.repeat_type == "":
        keyed = dates.where(in_period(hcol, spec.whole)).withColumn("key", F.lit(""))
    elif spec.repeat_type == "m":
        # Cutting the stop too leaves the dated items of the last month out; kept as is.
        inside = Period(spec.repeat.start % MONTH, spec.repeat.stop % MONTH,
                        spec.repeat.start_inclusive, spec.repeat.stop_inclusive)
        keyed = (
            dates.where(in_period(hcol, _cut(spec.whole, MONTH)))
            .where(in_period(hcol % F.lit(MONTH).cast("long"), inside))
            .withColumn("key", int_div(hcol, MONTH).cast("string"))
        )
    else:
        keyed = _yearly(dates, spec)
    return keyed.select(*by, "key", "hcol", "n_items")


def _yearly(dates: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Windows of consecutive years may overlap: a date then belongs to several keys."""
    first = spec.whole.start // YEAR + (0 if spec.whole.start_inclusive else 1)
    last = spec.whole.stop // YEAR - (0 if spec.whole.stop_inclusive else 1)
    hcol, start_year = F.col("hcol"), F.col("start_year")
    year = date_part(hcol, "year")
    # A date can only belong to windows starting in its own year or the few years before it, so each
    # date names its candidates instead of being compared with every window.
    candidates = F.sequence(year - spec.stop_in_next_year, year)
    low = start_year * YEAR + spec.repeat.start % YEAR
    high = (start_year + spec.stop_in_next_year) * YEAR + spec.repeat.stop % YEAR
    above = hcol >= low if spec.repeat.start_inclusive else hcol > low
    below = hcol <= high if spec.repeat.stop_inclusive else hcol < high
    return (
        dates.where(hcol.between(first * YEAR, (last + spec.stop_in_next_year + 1) * YEAR))
        .withColumn("start_year", F.explode(candidates))
        .where(start_year.between(first, last) & above & below)
        .withColumn("key", start_year.cast("string"))
    )


def daily_series(items: DataFrame, period: Period, by: Sequence[str] = ("pid",)) -> DataFrame:
    """Every date of the period under its day key, so the times of one day share a key."""
    plain = build_collections(items, CollectionSpec(period), by)
    return plain.withColumn("key", day_key(F.col("hcol")))


def collection_arrays(collections: DataFrame, by: Sequence[str] = ("pid",)) -> DataFrame:
    """Array form (``by``, key, datetimes ascending); one array holds the distinct dates of one key."""
    return collections.groupBy(*by, "key").agg(F.array_sort(F.collect_list("hcol")).alias("datetimes"))


def candidate_dates(spans: DataFrame, start: str, stop: str, month: int = -1, day: int = -1, hour: int = -1,
                    minute: int = -1, second: int = -1) -> DataFrame:
    """Add ``dt``: every date in [start, stop] that the part filters allow, per row of ``spans``.

    At most one part may be free (-1). Days run 1 to 31 without a calendar check.
    """
    parts = {"month": month, "day": day, "hour": hour, "minute": minute, "second": second}
    free = [p for p, v in parts.items() if v == -1]
    if len(free) > 1:
        raise ValueError("at most one date part may be left free")
    ranges = {"month": (1, 12), "day": (1, 31), "hour": (0, 23), "minute": (0, 59), "second": (0, 59)}
    fixed = sum(v * PARTS[p][0] for p, v in parts.items() if v != -1)
    years = F.sequence(int_div(F.col(start), YEAR), int_div(F.col(stop), YEAR))
    out = spans.withColumn("_year", F.explode(F.when(F.col(start) <= F.col(stop), years)))
    dt: Column = F.col("_year") * YEAR + F.lit(fixed).cast("long")
    if free:
        low, high = ranges[free[0]]
        out = out.withColumn("_free", F.explode(F.sequence(F.lit(low), F.lit(high))))
        dt = dt + F.col("_free").cast("long") * PARTS[free[0]][0]
    return out.withColumn("dt", dt).where(F.col("dt").between(F.col(start), F.col(stop))).drop("_year", "_free")


def filter_dates(df: DataFrame, start: int, stop: int, month: int = -1, day: int = -1, hour: int = -1,
                 minute: int = -1, second: int = -1, column: str = "hcol") -> DataFrame:
    """Rows whose date lies in [start, stop] and has the given parts."""
    c = F.col(column)
    return df.where(c.between(start, stop) & has_parts(c, month, day, hour, minute, second))


def year_list(items: DataFrame, by: Sequence[str] = ("pid",)) -> DataFrame:
    return items.select(*by, int_div(F.col("hcol"), YEAR).alias("year")).distinct()


def month_list(items: DataFrame, year: int, by: Sequence[str] = ("pid",)) -> DataFrame:
    """Distinct months (as yyyyMM) that hold items of one year."""
    inside = items.where((F.col("hcol") >= year * YEAR) & (F.col("hcol") < (year + 1) * YEAR))
    return inside.select(*by, int_div(F.col("hcol"), MONTH).alias("year_month")).distinct()


def month_items(items: DataFrame, year_month: int) -> DataFrame:
    """Items of one month, half-open, ascending by date."""
    low, high = year_month * MONTH, (year_month + 1) * MONTH
    return items.where((F.col("hcol") >= low) & (F.col("hcol") < high)).orderBy("hcol", "fid")


def day_of(c: Column) -> Column:
    return int_div(c, DAY)
