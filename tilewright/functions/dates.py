"""Dates stored as ``yyyyMMddHHmmss`` longs.

Monthly products use day 00 and yearly products month 00, so these values are never
converted to a SQL date: every part is taken by integer division.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Divisor and modulus of every date part (fixed values of the date format).
PARTS = {
    "year": (10_000_000_000, None),
    "month": (100_000_000, 100),
    "day": (1_000_000, 100),
    "hour": (10_000, 100),
    "minute": (100, 100),
    "second": (1, 100),
}
YEAR, MONTH, DAY = 10_000_000_000, 100_000_000, 1_000_000

# Label wording (fixed values): unit signs after year, month, day, hour, and the season of month 3/6/9/12.
LABELS = {
    "zh": {"year": "年", "month": "月", "day": "日", "hour": "时",
           "seasons": {3: "春季", 6: "夏季", 9: "秋季", 12: "冬季"}},
    "en": {"year": "-", "month": "-", "day": "", "hour": "h",
           "seasons": {3: " spring", 6: " summer", 9: " autumn", 12: " winter"}},
}


@dataclass(frozen=True)
class Period:
    """A date interval whose ends may each be open or closed."""

    start: int
    stop: int
    start_inclusive: bool = True
    stop_inclusive: bool = True


@dataclass(frozen=True)
class CollectionSpec:
    """Which dates belong together.

    ``repeat_type`` is ``""`` (one collection), ``"m"`` (one per month) or ``"y"`` (one per year).
    ``repeat`` is the part of each month or year to keep; ``stop_in_next_year`` moves its end
    that many years on.
    """

    whole: Period
    repeat_type: str = ""
    repeat: Period | None = None
    stop_in_next_year: int = 0

    def __post_init__(self):
        if self.repeat_type not in ("", "m", "y"):
            raise ValueError(f"repeat type must be '', 'm' or 'y', not {self.repeat_type!r}")
        if self.repeat_type and self.repeat is None:
            raise ValueError(f"repeat type {self.repeat_type!r} needs a repeat period")
        if self.stop_in_next_year < 0:
            raise ValueError("stop_in_next_year must not be negative")


def int_div(c: Column, n: int) -> Column:
    """Integer division that keeps longs exact."""
    return F.call_function("div", c.cast("long"), F.lit(n).cast("long"))


def date_part(c: Column, part: str) -> Column:
    divisor, modulus = PARTS[part]
    value = int_div(c, divisor)
    return value if modulus is None else value % F.lit(modulus).cast("long")


def date_parts(c: Column) -> list[Column]:
    """All six parts, ready for ``select``."""
    return [date_part(c, p).alias(p) for p in PARTS]


def day_key(c: Column) -> Column:
    return int_div(c, DAY).cast("string")


def in_period(c: Column, period: Period) -> Column:
    low = c >= F.lit(period.start).cast("long") if period.start_inclusive else c > F.lit(period.start).cast("long")
    high = c <= F.lit(period.stop).cast("long") if period.stop_inclusive else c < F.lit(period.stop).cast("long")
    return low & high


def has_parts(c: Column, month: int = -1, day: int = -1, hour: int = -1, minute: int = -1, second: int = -1) -> Column:
    """Keep dates whose parts equal the given values; -1 leaves a part free."""
    test = F.lit(True)
    for part, value in (("month", month), ("day", day), ("hour", hour), ("minute", minute), ("second", second)):
        if value != -1:
            test = test & (date_part(c, part) == F.lit(value))
    return test


def date_label(dt: Column, raw: Column, time_type: Column, language: str = "zh") -> Column:
    """Text of a date at its time scale.

    Scales: 1 second, 2 minute, 3 hour, 4 day, 5 month, 6 season, 7 year. A season label exists for
    months 3, 6, 9 and 12 only; everything else shows the digits of ``raw``.
    """
    words = LABELS[language]
    # the fourteen digits hold every part in place
    digits = F.lpad(dt.cast("string"), 14, "0")

    def part(start, length):
        return F.substring(digits, start, length)

    year = F.concat(part(1, 4), F.lit(words["year"]))
    month = F.concat(year, part(5, 2), F.lit(words["month"]))
    day = F.concat(month, part(7, 2), F.lit(words["day"]))
    hour = F.concat(day, F.lit(" "), part(9, 2))
    minute = F.concat(hour, F.lit(":"), part(11, 2))
    second = F.concat(minute, F.lit(":"), part(13, 2))
    season = F.lit(None).cast("string")
    for m, word in words["seasons"].items():
        season = F.when(part(5, 2) == f"{m:02d}", F.concat(part(1, 4), F.lit(word))).otherwise(season)
    by_scale = (
        F.when(time_type == 1, second)
        .when(time_type == 2, minute)
        .when(time_type == 3, F.concat(hour, F.lit(words["hour"])))
        .when(time_type == 4, day)
        .when(time_type == 5, month)
        .when(time_type == 6, season)
        .when(time_type == 7, year)
    )
    return F.coalesce(by_scale, raw.cast("string"))
