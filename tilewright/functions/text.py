"""Text columns: templates, lineage lists, search, digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Placeholders (fixed values): today, and today minus 0 to 7 days.
TEMPLATE_TODAY = "{{{DATE}}}"
TEMPLATE_BACK = "{{{DATE-%d}}}"
TEMPLATE_DAYS = 7

# Texts that stand for "no parameters" (fixed values).
EMPTY_PARAMS = ("", "{}", "null", "undefined")


def fill_template(text: Column, today: Column) -> Column:
    """Replace the date placeholders by ``yyyyMMdd`` text; ``today`` is a date column or literal."""

    def stamp(back):
        return F.date_format(F.date_sub(today, back), "yyyyMMdd")

    out = F.replace(text, F.lit(TEMPLATE_TODAY), stamp(0))
    for back in range(TEMPLATE_DAYS + 1):
        out = F.replace(out, F.lit(TEMPLATE_BACK % back), stamp(back))
    return out


def non_empty_parts(text: Column, separator: str = ";") -> Column:
    """Split and drop empty entries."""
    return F.filter(F.split(text, separator), lambda p: p != "")


def lineage_pairs(text: Column) -> Column:
    """``"ds,dt;ds,dt"`` to an array of (dsname, dt); null when any pair is malformed."""
    pairs = F.transform(non_empty_parts(text), lambda p: F.split(F.regexp_replace(p, ",+$", ""), ","))
    sound = F.forall(pairs, lambda p: (F.size(p) == 2) & F.get(p, 1).try_cast("long").isNotNull())
    return F.when(
        sound,
        F.transform(pairs, lambda p: F.struct(F.get(p, 0).alias("dsname"), F.get(p, 1).try_cast("long").alias("dt"))),
    )


def has_params(script: Column, params: Column) -> Column:
    """True when the script declares a parameter block and real parameters are given."""
    return F.contains(script, F.lit("sdui={")) & F.coalesce(~params.isin(*EMPTY_PARAMS), F.lit(False))


def contains_any(columns: list[Column], word: str) -> Column:
    """Case-insensitive substring search over several columns."""
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.contains(F.lower(c), F.lit(word.lower())), F.lit(False))
    return test


def md5_key(text: Column) -> Column:
    return F.md5(text)
