"""Queries over tiles, regions and dates."""

from __future__ import annotations

import json

from pyspark.sql import Window, functions as F

from checks.registry import Registry
from tilewright.functions.dates import CollectionSpec, Period
from tilewright.functions.keys import decode_key, encode_key
from tilewright.functions.pixels import classify_ranges, classify_stops, is_valid, physical
from tilewright.operators import blocks as B, collections as C, pixels as P, regions as R
from tilewright.operators.composite import composite
from tilewright.operators.pixels import explode_pixels, good_tiles
from tilewright.operators.regions import Regions
from tilewright.operators.summaries import tile_summaries, zonal_stats_summed
from tilewright.plans import datasets as DS, orders as O, statistics as S, tiles as T
from tilewright.session import shared_folder
from tilewright.sinks.directory import write_tile_files
from tilewright.sinks.reports import bands_side_by_side, result_json
from tilewright.sinks.tiles import upsert_tiles, write_tiles
from tilewright.sources.catalog import with_band_info
from tilewright.sources.directory import read_tile_files, read_tile_files_between, read_tile_files_on, with_shape
from tilewright.sources.orders import SERIES_FIELDS, STATISTIC_FIELDS, TILE_FIELDS, read_order
from tilewright.sources.tiles import cell_by_row_key, read_tiles, tile_cell, tiles_on_dates
from tilewright.streaming.growing import GrowingSeries

FILL, LOW, HIGH, W, H = -19999, -2000, 3000, 8, 8
D0 = 20190100000000
KEYS = ("z", "y", "x")
query = Registry()

STAT_DIGITS = {"sum": 3, "sq_sum": 1, "valid_min": 6, "valid_max": 6, "area_km2": 3, "mean": 6, "stddev": 4}


def rounded(df):
    """Doubles cut to a stable number of digits; counts as they are."""
    return df.select(*[F.round(F.col(c).cast("double"), STAT_DIGITS[c]).alias(c) if c in STAT_DIGITS else F.col(c)
                       for c in df.columns])


def zonal_sql(px, keys=(), merge="reference", tile_extra=(), low=LOW, high=HIGH):
    """DuckDB text of the two-level statistics over pixel rows ``px``."""
    k = "".join(f"{c}, " for c in keys)
    kt = "".join(f"{c}, " for c in (*keys, *tile_extra))
    order = "y * 4096 + x" if not tile_extra else f"row(y * 4096 + x, {tile_extra[0]})"
    v = f"dn <> {FILL} AND dn BETWEEN {low} AND {high}"
    area = ("6371.0088::double * 6371.0088 * radians(2.8125::double) * (sin(radians(90 - s.gy * 2.8125::double)) "
            "- sin(radians(90 - (s.gy + 1) * 2.8125::double)))")

    def total(c):
        if merge == "all":
            return f"sum({c})"
        return f"coalesce(sum(CASE WHEN valid_cnt > 0 THEN {c} END), arg_min({c}, {order}))"

    return f"""WITH px AS ({px}),
inside AS (SELECT px.*, s.roi_id, {area} AS km2 FROM px JOIN fx_seg s ON px.z = s.z AND px.gy = s.gy AND px.gx BETWEEN s.x0 AND s.x1),
t AS (SELECT {kt} roi_id, band, y, x, coalesce(sum(CASE WHEN {v} THEN dn::double END), 0) AS sum,
  coalesce(sum(CASE WHEN {v} THEN dn::double * dn::double END), 0) AS sq_sum, count(CASE WHEN {v} THEN 1 END) AS valid_cnt,
  coalesce(min(CASE WHEN {v} THEN dn END), 0) AS valid_min, coalesce(max(CASE WHEN {v} THEN dn END), 0) AS valid_max,
  coalesce(sum(CASE WHEN {v} THEN km2 END), 0) AS area_km2, count(*) AS all_cnt, count(CASE WHEN dn = {FILL} THEN 1 END) AS fill_cnt
  FROM inside GROUP BY {kt} roi_id, band, y, x),
m AS (SELECT {k} roi_id, band, {total('sum')} AS sum, {total('sq_sum')} AS sq_sum, {total('valid_cnt')}::bigint AS valid_cnt,
  coalesce(min(CASE WHEN valid_cnt > 0 THEN valid_min END), 0) AS valid_min,
  coalesce(max(CASE WHEN valid_cnt > 0 THEN valid_max END), 0) AS valid_max,
  {total('area_km2')} AS area_km2, {total('all_cnt')}::bigint AS all_cnt, {total('fill_cnt')}::bigint AS fill_cnt
  FROM t GROUP BY {k} roi_id, band)
SELECT {k} roi_id, band, round(sum::double, 3) AS sum, round(sq_sum::double, 1) AS sq_sum, valid_cnt,
 round(valid_min::double, 6) AS valid_min, round(valid_max::double, 6) AS valid_max, round(area_km2, 3) AS area_km2, all_cnt, fill_cnt,
 CASE WHEN valid_cnt > 0 THEN round(sum / valid_cnt, 6) ELSE 0 END::double AS mean,
 CASE WHEN valid_cnt > 0 THEN round(sqrt(greatest(sq_sum / valid_cnt - (sum / valid_cnt) * (sum / valid_cnt), 0)), 4) ELSE 0 END::double AS stddev
FROM m"""


GOOD = "SELECT * FROM fx_px WHERE status = 0"
VALID = f"dn <> {FILL} AND dn BETWEEN {LOW} AND {HIGH}"
ARGS = (LOW, HIGH, FILL)


def regions(fx):
    return Regions(fx.seg, W, H)


def as_blocks(fx):
    """The fixture tiles as binary blocks, both bands in one, good tiles only."""
    return B.encode_tiles(good_tiles(fx.tile), ["dsname", "hpid", "hcol", *KEYS]).withColumn("status", F.lit(0))


@query("zonal_stats_one_date", zonal_sql(f"{GOOD} AND hcol = {D0}"))
def _(fx):
    return rounded(S.zonal_stats(fx.tile.where(F.col("hcol") == D0), regions(fx), *ARGS))


@query("zonal_stats_one_date_blocks", zonal_sql(f"{GOOD} AND hcol = {D0}"))
def _(fx):
    return rounded(S.zonal_stats_blocks(as_blocks(fx).where(F.col("hcol") == D0), regions(fx), *ARGS))


@query("zonal_stats_all_tiles_mode", zonal_sql(f"{GOOD} AND hcol = {D0}", merge="all"))
def _(fx):
    return rounded(S.zonal_stats(fx.tile.where(F.col("hcol") == D0), regions(fx), *ARGS, merge="all"))


_AGG = {"min": f"coalesce(min(CASE WHEN {VALID} THEN dn END), {FILL})::bigint", "max": f"coalesce(max(CASE WHEN {VALID} THEN dn END), {FILL})::bigint",
        "ave": f"coalesce(avg(CASE WHEN {VALID} THEN dn::double END)::float, {FILL})::double",
        "sum": f"coalesce(sum(CASE WHEN {VALID} THEN dn::double END)::float, {FILL})::double"}


def composite_sql(method, px=GOOD, keys="z, y, x, band, pos"):
    return f"SELECT {keys}, {_AGG[method]} AS dn FROM ({px}) p GROUP BY {keys}"


def _kind(method):
    return "long" if method in ("min", "max") else "double"


for _m in ("min", "max", "ave", "sum"):
    @query(f"composite_{_m}", composite_sql(_m))
    def _(fx, m=_m):
        done = composite(explode_pixels(good_tiles(fx.tile)), m, LOW, HIGH, FILL)
        return done.withColumn("dn", F.col("dn").cast(_kind(m)))

    @query(f"composite_{_m}_blocks", composite_sql(_m))
    def _(fx, m=_m):
        done = B.composite_blocks(as_blocks(fx), m, LOW, HIGH, FILL)
        return explode_pixels(B.decode_blocks(done, _kind(m))).select(*KEYS, "band", "pos", "dn")


# ---- date collections ----------------------------------------------------------------------------

_W = Period(19960315000000, 20000620000000, start_inclusive=False)
SPECS = {
    "plain": CollectionSpec(_W),
    "monthly": CollectionSpec(_W, "m", Period(5000000, 20000000, stop_inclusive=False)),
    "yearly": CollectionSpec(_W, "y", Period(401000000, 930000000)),
    "yearly_next_year": CollectionSpec(_W, "y", Period(1101000000, 215000000, stop_inclusive=False), stop_in_next_year=1),
    "yearly_overlapping": CollectionSpec(_W, "y", Period(301000000, 615000000, stop_inclusive=False), stop_in_next_year=1),
}
_COLLECTION_SQL = {
    "plain": "SELECT pid, '' AS key, hcol, count(*) AS n_items FROM fx_item WHERE hcol > 19960315000000 AND hcol <= 20000620000000 GROUP BY pid, hcol",
    "monthly": """SELECT pid, (hcol // 100000000)::varchar AS key, hcol, count(*) AS n_items FROM fx_item
WHERE hcol > 19960300000000 AND hcol <= 20000600000000 AND hcol % 100000000 >= 5000000 AND hcol % 100000000 < 20000000 GROUP BY pid, hcol""",
}


def _year_sql(low, high_test, first=1997, last=2000):
    years = ", ".join(f"({y})" for y in range(first, last + 1))
    return f"""SELECT pid, w.y::varchar AS key, hcol, count(*) AS n_items FROM fx_item JOIN (VALUES {years}) AS w(y)
ON hcol >= w.y * 10000000000 + {low} AND {high_test} GROUP BY pid, w.y, hcol"""


_COLLECTION_SQL["yearly"] = _year_sql(401000000, "hcol <= w.y * 10000000000 + 930000000")
_COLLECTION_SQL["yearly_next_year"] = _year_sql(1101000000, "hcol < (w.y + 1) * 10000000000 + 215000000")
_COLLECTION_SQL["yearly_overlapping"] = _year_sql(301000000, "hcol < (w.y + 1) * 10000000000 + 615000000")

for _name, _spec in SPECS.items():
    @query(f"collection_{_name}", _COLLECTION_SQL[_name])
    def _(fx, spec=_spec):
        return C.build_collections(fx.item, spec)


@query("collection_arrays", f"""SELECT pid, key, string_agg(hcol::varchar, ',' ORDER BY hcol) AS datetimes
FROM ({_COLLECTION_SQL['monthly']}) c GROUP BY pid, key""")
def _(fx):
    arrays = C.collection_arrays(C.build_collections(fx.item, SPECS["monthly"]))
    return arrays.withColumn("datetimes", F.array_join("datetimes", ","))


# ---- series --------------------------------------------------------------------------------------

_WHOLE = Period(20190100000000, 20220100000000)
MONTHLY = CollectionSpec(_WHOLE, "m", Period(0, 31235959))
YEARLY = CollectionSpec(Period(20180000000000, 20220000000000), "y", Period(0, 1231235959), stop_in_next_year=1)
_MONTH_PX = f"SELECT *, (hcol // 100000000)::varchar AS key FROM fx_px WHERE status = 0 AND hcol BETWEEN {_WHOLE.start} AND {_WHOLE.stop}"
_YEAR_PX = """SELECT p.*, w.y::varchar AS key FROM fx_px p JOIN (VALUES (2018), (2019), (2020), (2021), (2022)) AS w(y)
ON hcol >= w.y * 10000000000 AND hcol <= (w.y + 1) * 10000000000 + 1231235959 WHERE status = 0"""


def series_sql(px, method, keys=("key",), extra=()):
    ks = ", ".join((*keys, *extra, "z", "y", "x", "band", "pos", "gx", "gy"))
    return zonal_sql(composite_sql(method, px, ks), keys, tile_extra=extra)


def tile_dates(fx, spec):
    return C.build_collections(fx.tile_item, spec)


@query("series_monthly_max", series_sql(_MONTH_PX, "max"))
def _(fx):
    return rounded(S.series_stats(fx.tile, tile_dates(fx, MONTHLY), regions(fx), "max", *ARGS))


@query("series_monthly_max_blocks", series_sql(_MONTH_PX, "max"))
def _(fx):
    return rounded(S.series_stats_blocks(as_blocks(fx), tile_dates(fx, MONTHLY), regions(fx), "max", *ARGS))


@query("series_yearly_ave", series_sql(_YEAR_PX, "ave"))
def _(fx):
    return rounded(S.series_stats(fx.tile, tile_dates(fx, YEARLY), regions(fx), "ave", *ARGS))


@query("series_yearly_ave_blocks", series_sql(_YEAR_PX, "ave"))
def _(fx):
    return rounded(S.series_stats_blocks(as_blocks(fx), tile_dates(fx, YEARLY), regions(fx), "ave", *ARGS))


@query("series_yearly_sum_same_range", series_sql(_YEAR_PX, "sum"))
def _(fx):
    return rounded(S.series_stats(fx.tile, tile_dates(fx, YEARLY), regions(fx), "sum", *ARGS))


@query("series_daily", series_sql("SELECT *, (hcol // 1000000)::varchar AS key FROM fx_px WHERE status = 0", "min", extra=("hcol",)))
def _(fx):
    days = C.daily_series(fx.tile_item, Period(20190000000000, 20300000000000))
    return rounded(S.series_stats(fx.tile, days, regions(fx), "min", *ARGS, per_date=True))


_DAYS = "20190101000000 + ((hcol // 10000000000 - 2019) * 12 + hcol // 100000000 % 100 - 1) // 2 * 1000000 + (hcol // 100000000 % 100 - 1) % 2 * 10000"


@query("series_two_dates_a_day", series_sql(f"SELECT *, (hcol // 1000000)::varchar AS key FROM (SELECT * EXCLUDE (hcol), {_DAYS} AS hcol FROM fx_px WHERE status = 0) h", "min", extra=("hcol",)))
def _(fx):
    """Two dates lie under each day's key: each is its own composite, and their statistics are merged."""
    tiles = fx.tile.withColumn("hcol", F.expr(_DAYS.replace("//", "DIV")))
    items = tiles.select(F.lit(1).alias("pid"), F.col("hcol").alias("fid"), "hcol", F.col("hcol").alias("dt0"), (F.col("hcol") + 1).alias("dt1")).distinct()
    days = C.daily_series(items, Period(20190000000000, 20300000000000))
    return rounded(S.series_stats(tiles, days, regions(fx), "min", *ARGS, per_date=True))


@query("stack_dates_in_order", "SELECT z, y, x, row_number() OVER (PARTITION BY z, y, x ORDER BY hcol) - 1 AS pos, hcol // 100000000 AS dn FROM (SELECT DISTINCT z, y, x, hcol FROM fx_px WHERE status = 0) t")
def _(fx):
    """What a function over a date stack is given, in the order it is given."""
    out = B.apply_to_stack(as_blocks(fx).repartition(5), months_as_pixels, KEYS)
    return explode_pixels(B.decode_blocks(good_tiles(out))).select(*KEYS, "pos", "dn")


def months_as_pixels(address, dates):
    import numpy as np

    return np.array([[[hcol // 100000000 for hcol, _ in dates]]], "<i4")


_RANGE_PX = f"""SELECT key, z, y, x, band, pos, gx, gy, coalesce(max(CASE WHEN {VALID} THEN dn END) - min(CASE WHEN {VALID} THEN dn END), {FILL}) AS dn
FROM ({_YEAR_PX}) p GROUP BY key, z, y, x, band, pos, gx, gy"""


@query("script_series_range", zonal_sql(_RANGE_PX, ("key",)))
def _(fx):
    stats = S.script_series(fx.tile, tile_dates(fx, YEARLY), regions(fx), lambda v: F.max(v) - F.min(v), *ARGS)
    return rounded(stats)


def spread_of_stack(address, dates):
    """Largest minus smallest valid value of each pixel: a user function over a date stack."""
    import numpy as np

    least = most = None
    for _, px in dates:
        v = px.astype("i4")
        ok = (v != FILL) & (v >= LOW) & (v <= HIGH)
        if least is None:
            least, most = np.full(v.shape, 1 << 30, "i4"), np.full(v.shape, -(1 << 30), "i4")
        np.minimum(least, v, out=least, where=ok)
        np.maximum(most, v, out=most, where=ok)
    return np.where(most >= least, most - least, FILL).astype("<i4")


@query("script_series_range_blocks", zonal_sql(_RANGE_PX, ("key",)))
def _(fx):
    return rounded(S.script_series_blocks(as_blocks(fx), tile_dates(fx, YEARLY), regions(fx), spread_of_stack, *ARGS, strips=4))


@query("script_series_range_folded", zonal_sql(_RANGE_PX, ("key",)))
def _(fx):
    """The same function in four parts, so that no dates of a tile need come together."""
    return rounded(S.script_series_blocks(as_blocks(fx), tile_dates(fx, YEARLY), regions(fx), spread_fold(), *ARGS))


def spread_fold():
    import numpy as np

    def start(address):
        return None

    def add(state, date, px):
        v = px.astype("i4")
        ok = (v != FILL) & (v >= LOW) & (v <= HIGH)
        return merge(state, (np.where(ok, v, 1 << 30), np.where(ok, v, -(1 << 30))))

    def merge(a, b):
        return b if a is None else a if b is None else (np.minimum(a[0], b[0]), np.maximum(a[1], b[1]))

    def finish(state):
        least, most = state
        return np.where(most >= least, most - least, FILL).astype("<i4")

    return B.Fold(start, add, merge, finish)


@query("series_grown_in_batches", series_sql(_MONTH_PX, "max"))
def _(fx):
    """Dates come in four batches, one of them twice, with a compaction in between."""
    month = lambda hcol: F.when(hcol.between(_WHOLE.start, _WHOLE.stop), F.call_function("div", hcol, F.lit(100000000)))
    grown = GrowingSeries(fx.spark, shared_folder(fx.spark, "grown"), "max", *ARGS, month)
    blocks = as_blocks(fx)
    for batch in (0, 1, 1, 2, 3):
        grown.fold(blocks.where((F.col("y") + F.col("x")) % 4 == batch), batch)
        if batch == 2:
            grown.compact()
    return rounded(grown.statistics(regions(fx)))


# Regions of several tiles, so that some tiles lie wholly inside.
@query("zonal_with_tile_summaries", zonal_sql(f"{GOOD} AND hcol = {D0}").replace("fx_seg", "fx_wide"))
def _(fx):
    blocks, path = as_blocks(fx), shared_folder(fx.spark, "summed")
    write_tiles(blocks, f"{path}/tiles")
    stored = read_tiles(fx.spark, f"{path}/tiles")
    write_tiles(tile_summaries(stored, *ARGS), f"{path}/summaries")
    summaries = fx.spark.read.parquet(f"{path}/summaries")
    return rounded(zonal_stats_summed(stored.where(F.col("hcol") == D0), summaries, Regions(fx.wide, W, H), *ARGS))


# ---- results, clips, masks -----------------------------------------------------------------------

def _wide_sql():
    cols = {"areakm2": "area_km2", "acnt": "all_cnt", "fcnt": "fill_cnt", "vcnt": "valid_cnt", "vmin": "valid_min",
            "vmax": "valid_max", "sum": "sum", "sqsum": "sq_sum", "mean": "mean", "stddev": "stddev"}
    picks = ", ".join(f"max(CASE WHEN band = {b} THEN {c} END) AS {n}_b{b + 1}" for b in (0, 1) for n, c in cols.items())
    return f"SELECT key, roi_id, {picks} FROM ({series_sql(_MONTH_PX, 'max')}) s GROUP BY key, roi_id"


def _monthly(fx):
    return rounded(S.series_stats(fx.tile, tile_dates(fx, MONTHLY), regions(fx), "max", *ARGS))


@query("zonal_two_bands_csv", _wide_sql())
def _(fx):
    return bands_side_by_side(_monthly(fx), 2)


_JSON_NUMBERS = ["sum", "sq_sum", "valid_cnt", "valid_min", "valid_max", "area_km2", "all_cnt", "fill_cnt"]


@query("result_json", f"""SELECT roi_id, key, band, {', '.join(f'{c}::double AS {c}' for c in _JSON_NUMBERS)}, 0::bigint AS state, 'success' AS message
FROM ({series_sql(_MONTH_PX, 'max')}) s""")
def _(fx):
    """Documents are read back, so their text is checked field by field."""
    schema = ("state long, message string, data array<struct<key: string, data: array<struct<sum: double, sq_sum: double, validCnt: double, "
              "validMin: double, validMax: double, areakm2: double, allCnt: double, fillCnt: double>>>>")
    docs = result_json(_monthly(fx)).withColumn("d", F.from_json("document", schema))
    per_key = docs.select("roi_id", "d.state", "d.message", F.explode("d.data").alias("k"))
    bands = per_key.select("roi_id", "state", "message", "k.key", F.posexplode("k.data").alias("band", "s"))
    names = {"sum": "sum", "valid_cnt": "validCnt", "valid_min": "validMin", "valid_max": "validMax", "all_cnt": "allCnt",
             "fill_cnt": "fillCnt", "sq_sum": "sq_sum", "area_km2": "areakm2"}
    return bands.select("roi_id", "key", "band", "state", "message", *[F.col(f"s.{n}").alias(c) for c, n in names.items()])


def _clip_sql(inside):
    return f"""SELECT hcol, z, y, x, band, pos, CASE WHEN {inside} THEN dn ELSE {FILL} END AS dn FROM fx_px p WHERE status = 0"""


def _in(roi):
    return f"EXISTS (SELECT 1 FROM fx_seg s WHERE s.roi_id = '{roi}' AND s.z = p.z AND s.gy = p.gy AND p.gx BETWEEN s.x0 AND s.x1)"


_PIXEL = ("hcol", *KEYS, "band", "pos", "dn")


def _clipped(fx, rois):
    return T.export_pixels(explode_pixels(good_tiles(fx.tile)), T.region_runs(fx.seg, rois), FILL, W, H).select(*_PIXEL)


@query("clip_to_region", _clip_sql(_in("user:7")))
def _(fx):
    return _clipped(fx, ["user:7"])


@query("clip_two_regions", _clip_sql(f"{_in('sys:0')} AND {_in('user:1')}"))
def _(fx):
    return _clipped(fx, ["sys:0", "user:1"])


@query("clip_to_region_blocks", _clip_sql(_in("user:7")))
def _(fx):
    cut = B.clip_blocks(as_blocks(fx), T.region_runs(fx.seg, ["user:7"]), FILL, W, H)
    return explode_pixels(B.decode_blocks(cut)).select(*_PIXEL)


@query("mask_by_other_date", f"""SELECT a.hcol, a.z, a.y, a.x, a.band, a.pos, CASE WHEN b.dn <> {FILL} AND b.dn BETWEEN 0 AND 800 THEN a.dn ELSE {FILL} END AS dn
FROM fx_px a JOIN fx_px b ON a.z = b.z AND a.y = b.y AND a.x = b.x AND a.band = b.band AND a.pos = b.pos
WHERE a.status = 0 AND b.status = 0 AND b.hcol = {D0 + 100000000}""")
def _(fx):
    tiles = good_tiles(fx.tile)
    masked = R.mask_tiles(tiles, tiles.where(F.col("hcol") == D0 + 100000000), 0, 800, FILL)
    return explode_pixels(masked).select(*_PIXEL)


@query("mask_by_other_date_blocks", f"""SELECT a.hcol, a.z, a.y, a.x, a.band, a.pos, CASE WHEN b.dn <> {FILL} AND b.dn BETWEEN 0 AND 800 THEN a.dn ELSE {FILL} END AS dn
FROM fx_px a JOIN fx_px b ON a.z = b.z AND a.y = b.y AND a.x = b.x AND a.band = b.band AND a.pos = b.pos
WHERE a.status = 0 AND b.status = 0 AND b.hcol = {D0 + 100000000}""")
def _(fx):
    blocks = as_blocks(fx)
    return _pixels(B.mask_blocks(blocks, blocks.where(F.col("hcol") == D0 + 100000000), 0, 800, FILL))


@query("physical_values", f"""SELECT p.hcol, p.z, p.y, p.x, p.band, p.pos, 0.5::double * p.dn + (-10)::double AS value
FROM fx_px p JOIN fx_band b ON b.bindex = p.band AND b.pid = 1 WHERE p.status = 0 AND {VALID}""")
def _(fx):
    bands = with_band_info(fx.band).where("pid = 1").withColumnRenamed("bindex", "band").select("band", "scale", "offset")
    tiles = P.with_bands(good_tiles(fx.tile), bands)
    pixels = explode_pixels(tiles).where(is_valid(F.col("dn"), LOW, HIGH, FILL))
    return pixels.select(
        "hcol", *KEYS, "band", "pos", physical(F.col("dn").cast("double"), F.col("scale"), F.col("offset")).alias("value"))


# ---- reading tiles -------------------------------------------------------------------------------

@query("explode_pixels_stats", """SELECT hcol, z, y, x, band, count(*) AS n, sum(dn)::bigint AS total, min(dn) AS low, max(dn) AS high,
sum(pos * dn)::bigint AS placed FROM fx_px WHERE status = 0 GROUP BY hcol, z, y, x, band""")
def _(fx):
    pixels = explode_pixels(B.decode_blocks(as_blocks(fx)))
    return pixels.groupBy("hcol", *KEYS, "band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dn").alias("total"), F.min("dn").alias("low"), F.max("dn").alias("high"),
        F.sum(F.col("pos") * F.col("dn")).alias("placed"))


@query("band_select", """SELECT hcol, z, y, x, w.out_band, pos, dn FROM fx_px JOIN (VALUES (0, 1), (1, 0), (2, 1)) AS w(out_band, band) USING (band) WHERE status = 0""")
def _(fx):
    chosen = P.select_bands(good_tiles(fx.tile), [1, 0, 1], 2)
    return explode_pixels(chosen).select("hcol", *KEYS, "out_band", "pos", "dn")


def _band_table(fx):
    """Bands of all products; those of the tiles' product are the slices of its store block."""
    return with_band_info(fx.band).select("pid", "bindex", F.col("hPid").alias("hpid"), F.col("bsqIndex").alias("bsq_index"))


@query("band_select_blocks", """SELECT hcol, z, y, x, w.out_band, pos, dn FROM fx_px JOIN (VALUES (0, 1), (1, 0)) AS w(out_band, band) USING (band) WHERE status = 0""")
def _(fx):
    blocks = as_blocks(fx).withColumn("pid", F.lit(1))
    cut = B.select_block_bands(blocks, _band_table(fx), ["pid", "hcol", *KEYS], [1, 0])
    return explode_pixels(B.decode_blocks(cut).withColumnRenamed("band", "out_band")).select("hcol", *KEYS, "out_band", "pos", "dn")


@query("tiles_on_dates", f"SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND hcol IN ({D0}, {D0 + 200000000})")
def _(fx):
    dates = fx.tile_item.where(F.col("hcol").isin(D0, D0 + 200000000, D0 + 77)).unionByName(fx.tile_item.where(F.col("hcol") == D0))
    return explode_pixels(tiles_on_dates(good_tiles(fx.tile), dates)).select(*_PIXEL)


@query("tile_cell", f"SELECT band, pos, dn FROM fx_px WHERE hcol = {D0} AND z = 4 AND y = 3 AND x = 9")
def _(fx):
    return explode_pixels(tile_cell(fx.tile, 1, D0, 4, 3, 9)).select("band", "pos", "dn")


@query("cell_by_row_key", f"SELECT band, pos, dn FROM fx_px WHERE hcol = {D0} AND z = 4 AND y = 3 AND x = 9")
def _(fx):
    one_date = as_blocks(fx).where(F.col("hcol") == D0)
    keyed = one_date.withColumn("row_key", encode_key(*[F.col(c) for c in ("hpid", *KEYS)], 4, 4))
    return explode_pixels(B.decode_blocks(cell_by_row_key(keyed, 1, 4, 3, 9, 4, 4))).select("band", "pos", "dn")


@query("capped_dates_per_tile", """SELECT pid, dt, dn, event_id FROM (SELECT *, dense_rank() OVER (PARTITION BY pid ORDER BY dt) AS k FROM fx_obs
WHERE dt BETWEEN 20240101000000 AND 20241231235959 AND (dt // 10000) % 100 = 6) t WHERE k <= 30""")
def _(fx):
    cells = P.capped_dates(fx.obs, ["pid"], 20240101000000, 20241231235959, 30, date="dt", hour=6)
    return cells.select("pid", "dt", "dn", "event_id")


@query("uncapped_dates_per_tile", """SELECT pid, dt, dn, event_id FROM fx_obs WHERE dt BETWEEN 20240101000000 AND 20241231235959 AND (dt // 10000) % 100 = 6""")
def _(fx):
    cells = P.capped_dates(fx.obs, ["pid"], 20240101000000, 20241231235959, None, date="dt", hour=6)
    return cells.select("pid", "dt", "dn", "event_id")


# Shift and scale that take the fixture's values into each element type's range, and back exactly.
_TYPE_CASES = {1: "((dn + 19999) % 256)", 2: "(dn + 19999)", 3: "dn", 4: "((dn + 19999) * 100000)", 5: "(dn * 100000)",
               6: "(dn / 4)", 7: "(dn / 8)"}

@query("block_roundtrip", " UNION ALL ".join(
    f"SELECT {k} AS data_type, z, y, x, band, hcol, sum({e.replace('dn', 'dn::double')}) AS total, sum(pos * {e.replace('dn', 'dn::double')}) AS placed FROM fx_px WHERE status = 0 GROUP BY z, y, x, band, hcol"
    for k, e in _TYPE_CASES.items()))
def _(fx):
    out = None
    for k, e in _TYPE_CASES.items():
        typed = good_tiles(fx.tile).withColumn("dn", F.expr(f"transform(dn, v -> {e.replace('dn', 'cast(v as double)')})"))
        blocks = B.encode_tiles(typed.withColumn("data_type", F.lit(k)), ["dsname", "hpid", "hcol", *KEYS])
        pixels = explode_pixels(B.decode_blocks(blocks, "double"))
        sums = pixels.groupBy("data_type", *KEYS, "band", "hcol").agg(
            F.sum("dn").alias("total"), F.sum(F.col("pos") * F.col("dn")).alias("placed"))
        out = sums if out is None else out.unionByName(sums)
    return out


_KEY_CASES = ((1, 2), (4, 2), (4, 4))


def _signed(v, width):
    half, full = 1 << (8 * width - 1), 1 << (8 * width)
    return f"(({v}) % {full} + {full} + {half}) % {full} - {half}"


_KEY_BASE = "SELECT c_custkey AS pid, c_custkey % 22 AS z, c_custkey * 97 % 70001 AS y, c_custkey * 131 % 90001 AS x FROM customer"


def _hex_of(v, width):
    return f"right(repeat('0', 16) || hex(({v}) % {1 << (8 * width)}), {2 * width})"


@query("key_roundtrip", " UNION ALL ".join(
    f"""SELECT {p} AS pid_bytes, {w} AS yx_bytes, pid, z, y, x, {_hex_of('(x + y) % 10', 1)} || {_hex_of('pid', p)} || {_hex_of('z', 1)} || {_hex_of('y', w)} || {_hex_of('x', w)} AS row_key,
 (x + y) % 10 AS k_bucket, {_signed('pid', p)} AS k_pid, z AS k_z, {_signed('y', w)} AS k_y, {_signed('x', w)} AS k_x FROM ({_KEY_BASE}) k"""
    for p, w in _KEY_CASES))
def _(fx):
    cells = fx.customer.selectExpr("c_custkey AS pid", "c_custkey % 22 AS z", "c_custkey * 97 % 70001 AS y", "c_custkey * 131 % 90001 AS x")
    out = None
    for p, w in _KEY_CASES:
        key = encode_key(*[F.col(c) for c in ("pid", "z", "y", "x")], p, w)
        rows = cells.withColumn("k", key).withColumn("d", decode_key(F.col("k"), p, w)).select(
            F.lit(p).alias("pid_bytes"), F.lit(w).alias("yx_bytes"), "pid", "z", "y", "x", F.hex("k").alias("row_key"),
            *[F.col(f"d.{c}").alias(f"k_{c}") for c in ("bucket", "pid", "z", "y", "x")])
        out = rows if out is None else out.unionByName(rows)
    return out


@query("tile_table_upsert", f"""SELECT hcol, z, y, x, band, pos, CASE WHEN hcol = {D0} AND y < 4 AND dn <> {FILL} THEN dn + 1 ELSE dn END AS dn FROM fx_px WHERE status = 0""")
def _(fx):
    """All tiles are written, those of one date's upper half are replaced, and the table is read back."""
    blocks = as_blocks(fx)
    path = shared_folder(fx.spark, "tiles")
    write_tiles(blocks, path)
    add_one = T.compute_tiles(blocks.where(F.col("y") < 4), plus_one, [("mod/vi", D0)], "mod/vi", 1, D0, 21)
    # a repeated cell: the later version counts
    twice = add_one.select(*blocks.columns).withColumn("v", F.lit(2)).unionByName(
        blocks.where(f"y < 4 AND hcol = {D0}").withColumn("v", F.lit(1)))
    upsert_tiles(twice, path, version="v")
    back = read_tiles(fx.spark, path, "mod/vi", 4).select("hcol", *KEYS, "width", "height", "nbands", "data_type", "data")
    return explode_pixels(B.decode_blocks(back)).select(*_PIXEL)


_JOB_DATES = (20200500000000, 20200501000000)


@query("tile_job_two_dates", f"""SELECT d.hcol, z, y, x, band, pos, CASE WHEN dn = {FILL} THEN dn ELSE dn + 1 END AS dn
FROM fx_px CROSS JOIN (VALUES ({_JOB_DATES[0]}), ({_JOB_DATES[1]})) AS d(hcol) WHERE status = 0 AND fx_px.hcol = {D0}""")
def _(fx):
    """One date is computed in two halves, another of the same month at once; all cells and both items are there afterwards."""
    path = shared_folder(fx.spark, "jobs") + "/tiles"
    empty = lambda text: fx.spark.createDataFrame([], text)
    catalog = T.Catalog(empty("pid int, name string, userid int, source string, info string"), empty("pid int, bindex int, info string"),
                        empty("pid int, hcol long, dt0 long, dt1 long"))
    west, east, globe = (-180.0, -1.0, 90.0, -90.0), (1.0, 180.0, 90.0, -90.0), (-180.0, 180.0, 90.0, -90.0)
    for hcol, extent in ((_JOB_DATES[0], west), (_JOB_DATES[1], globe), (_JOB_DATES[0], east)):
        tiles = T.compute_tiles(as_blocks(fx), plus_one, [("mod/vi", D0)], "out", 9, hcol, 4, extent, width=W)
        catalog = T.run_tile_job(tiles, path, catalog, "out", hcol, "EPSG:4326", 4, "t", 0, 0, FILL, extent).catalog
    items = catalog.items.where("pid = 9").select("hcol")
    return explode_pixels(B.decode_blocks(tiles_on_dates(read_tiles(fx.spark, path, "out", 4), items))).select(*_PIXEL)


def plus_one(address, tiles):
    (pixels,) = tiles.values()
    return (pixels + (pixels != FILL)).astype("<i2")


# ---- values, points, windows ---------------------------------------------------------------------

RANGES = ((-1000, -1), (0, 500), (400, 900), (901, 3000))
STOPS = (-1000, 0, 250, 1000, 2500)


@query("classify_ranges", f"""SELECT hcol, band, class, count(*) AS n FROM (SELECT hcol, band,
 CASE WHEN dn BETWEEN -1000 AND -1 THEN 0 WHEN dn BETWEEN 0 AND 500 THEN 1 WHEN dn BETWEEN 400 AND 900 THEN 2 WHEN dn BETWEEN 901 AND 3000 THEN 3 END AS class
 FROM fx_px WHERE status = 0 AND {VALID}) t GROUP BY hcol, band, class""")
def _(fx):
    pixels = explode_pixels(good_tiles(fx.tile)).where(is_valid(F.col("dn"), LOW, HIGH, FILL))
    return pixels.withColumn("class", classify_ranges(F.col("dn"), RANGES)).groupBy("hcol", "band", "class").agg(
        F.count(F.lit(1)).alias("n"))


@query("classify_histogram_blocks", f"""SELECT hcol, band, class, count(*) AS n FROM (SELECT hcol, band,
 CASE WHEN dn BETWEEN -1000 AND -1 THEN 0 WHEN dn BETWEEN 0 AND 500 THEN 1 WHEN dn BETWEEN 400 AND 900 THEN 2 WHEN dn BETWEEN 901 AND 3000 THEN 3 END AS class
 FROM fx_px WHERE status = 0 AND {VALID}) t GROUP BY hcol, band, class""")
def _(fx):
    return B.class_counts(as_blocks(fx), RANGES, *ARGS, keys=["hcol"])


@query("classify_linear", f"""SELECT hcol, z, y, x, band, pos, round(CASE WHEN dn >= 2500 THEN 4 WHEN dn >= 1000 THEN 3 + (dn - 1000) / 1500::double WHEN dn >= 250 THEN 2 + (dn - 250) / 750::double
 WHEN dn >= 0 THEN 1 + dn / 250::double WHEN dn >= -1000 THEN (dn + 1000) / 1000::double ELSE 0 END, 6) AS place,
 CASE WHEN dn >= 2500 THEN 4 WHEN dn >= 1000 THEN 3 WHEN dn >= 250 THEN 2 WHEN dn >= 0 THEN 1 WHEN dn >= -1000 THEN 0 END AS step,
 CASE dn WHEN -1000 THEN 0 WHEN 0 THEN 1 WHEN 250 THEN 2 WHEN 1000 THEN 3 WHEN 2500 THEN 4 END AS same FROM fx_px WHERE status = 0 AND {VALID}""")
def _(fx):
    pixels = explode_pixels(good_tiles(fx.tile)).where(is_valid(F.col("dn"), LOW, HIGH, FILL))
    dn = F.col("dn")
    return pixels.select("hcol", *KEYS, "band", "pos", F.round(classify_stops(dn, STOPS, "linear"), 6).alias("place"),
                         classify_stops(dn, STOPS, "discrete").alias("step"), classify_stops(dn, STOPS, "exact").alias("same"))


_POINT_PIXEL = """SELECT id, floor(floor((90 - lat) / 2.8125 + 0.5) / 8)::int AS y, floor(floor((lon + 180) / 2.8125 + 0.5) / 8)::int AS x,
 (floor((lon + 180) / 2.8125 + 0.5) % 8)::int AS col, (floor((90 - lat) / 2.8125 + 0.5) % 8)::int AS row FROM fx_point"""


@query("pixel_values_at_points", f"""SELECT id, hcol, band, t.dn[q.row * 8 + q.col + 1] AS value FROM ({_POINT_PIXEL}) q JOIN fx_tile t ON t.z = 4 AND t.y = q.y AND t.x = q.x WHERE t.status = 0""")
def _(fx):
    tiles = good_tiles(fx.tile).select("hcol", *KEYS, "band", "dn")
    return P.lookup_points(fx.point, tiles, 4, W, H).select("id", "hcol", "band", "value")


@query("pixel_values_at_points_blocks", f"""SELECT id, hcol, band, t.dn[q.row * 8 + q.col + 1]::double AS value FROM ({_POINT_PIXEL}) q JOIN fx_tile t ON t.z = 4 AND t.y = q.y AND t.x = q.x WHERE t.status = 0""")
def _(fx):
    return B.lookup_points_blocks(fx.point, as_blocks(fx), 4, W, H)


@query("window_export", f"""SELECT hcol, z, y, x, band, pos, CASE WHEN {_in('sys:12')} THEN dn ELSE {FILL} END AS dn FROM fx_px p
WHERE status = 0 AND y BETWEEN 2 AND 5 AND x BETWEEN 4 AND 11""")
def _(fx):
    window = T.export_window(good_tiles(fx.tile), (-80.0, 80.0, 40.0, -40.0), 4, W)
    return T.export_pixels(explode_pixels(window), T.region_runs(fx.seg, ["sys:12"]), FILL, W, H).select(*_PIXEL)


_DIFF = f"""SELECT a.z, a.y, a.x, a.band, a.pos, CASE WHEN a.dn = {FILL} OR b.dn = {FILL} THEN {FILL} ELSE b.dn - a.dn END AS dn
FROM fx_px a JOIN fx_px b ON a.z = b.z AND a.y = b.y AND a.x = b.x AND a.band = b.band AND a.pos = b.pos
WHERE a.status = 0 AND b.status = 0 AND a.hcol = {D0} AND b.hcol = {D0 + 100000000}"""


@query("compute_tiles_difference", _DIFF)
def _(fx):
    tiles = good_tiles(fx.tile)
    first, second = (tiles.where(F.col("hcol") == d) for d in (D0, D0 + 100000000))
    fill = F.lit(FILL).cast("long")
    diff = P.combine_tiles(first, second, lambda a, b: F.when((a == fill) | (b == fill), fill).otherwise(b - a))
    return explode_pixels(diff).select(*KEYS, "band", "pos", "dn")


@query("compute_tiles_difference_blocks", f"""SELECT z, y, x, band, pos, dn FROM ({_DIFF}) d""")
def _(fx):
    days = [("mod/vi", D0), ("mod/vi", D0 + 100000000)]
    done = T.compute_tiles(as_blocks(fx), later_minus_earlier, days, "diff", 2, 1, 4)
    # tiles present on one of the dates only have no difference
    return explode_pixels(B.decode_blocks(good_tiles(done))).select(*KEYS, "band", "pos", "dn")


def later_minus_earlier(address, tiles):
    import numpy as np

    (_, a), (_, b) = sorted(tiles.items())
    return np.where((a == FILL) | (b == FILL), FILL, b.astype("i4") - a).astype("<i4")


def double_or_fail(address, tiles):
    """A user function that fails on some tiles."""
    import numpy as np

    if (address["y"] + address["x"]) % 16 == 5:
        raise ArithmeticError("no result")
    (pixels,) = tiles.values()
    return np.where(pixels == FILL, FILL, pixels.astype("i4") * 2).astype("<i4")


@query("compute_tiles_with_failures", f"""SELECT z, y, x, band, CASE WHEN (y + x) % 16 = 5 THEN 1 ELSE 0 END AS status,
CASE WHEN (y + x) % 16 = 5 THEN 'ArithmeticError: no result' END AS log,
CASE WHEN (y + x) % 16 <> 5 THEN sum(CASE WHEN dn = {FILL} THEN {FILL} ELSE dn * 2 END)::bigint END AS total
FROM fx_px WHERE status = 0 AND hcol = {D0} AND (band = 0 OR (y + x) % 16 <> 5) GROUP BY z, y, x, band""")
def _(fx):
    out = B.map_tiles(as_blocks(fx), double_or_fail, [("mod/vi", D0)])
    sums = B.decode_blocks(out.where("status = 0")).select(
        *KEYS, "band", "status", "log", F.aggregate("dn", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))
    failed = out.where("status <> 0").select(*KEYS, F.lit(0).alias("band"), "status", "log", F.lit(None).cast("long").alias("total"))
    return sums.unionByName(failed)


@query("tile_status_counts", """SELECT hcol, count(CASE WHEN status = 0 THEN 1 END) AS good, count(CASE WHEN status <> 0 THEN 1 END) AS bad FROM fx_tile GROUP BY hcol""")
def _(fx):
    return P.status_counts(fx.tile, ["hcol"])


def _legacy_sql(method):
    px = f"SELECT * FROM fx_px WHERE status = 0 AND band = 0 AND hcol BETWEEN {D0} AND {D0 + 200000000}"
    return zonal_sql(composite_sql(method, px, "z, y, x, band, pos, gx, gy"))


for _m in ("min", "max", "ave"):
    @query(f"legacy_zonal_{_m}", _legacy_sql(_m))
    def _(fx, m=_m):
        dates = C.build_collections(fx.tile_item, CollectionSpec(Period(D0, D0 + 200000000)))
        return rounded(S.series_stats(fx.tile.where("band = 0"), dates, regions(fx), m, *ARGS)).drop("key")


@query("legacy_composite_order", f"""SELECT z, y, x, band, pos, {_AGG['ave']} AS dn, 20190000000000 AS hcol FROM fx_px WHERE status = 0 AND hcol BETWEEN {D0} AND {D0 + 200000000} GROUP BY z, y, x, band, pos""")
def _(fx):
    done = T.composite_order(as_blocks(fx), D0, D0 + 200000000, "ave", LOW, HIGH, FILL, 20190000000000)
    return explode_pixels(B.decode_blocks(done, "double")).select(*_PIXEL)


# ---- tiles as files ------------------------------------------------------------------------------

def _directory(fx):
    """The fixture's tiles as files, under store block 1."""
    root = shared_folder(fx.spark, "tree")
    write_tile_files(as_blocks(fx), root, "t")
    return root


def _file_pixels(files):
    return _pixels(with_shape(files, W, H, 2, 3))


@query("directory_cell", f"SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND hcol = {D0 + 100000000} AND y = 1 AND x = 3")
def _(fx):
    return _file_pixels(read_tile_files(fx.spark, _directory(fx), "t", 1, D0 + 100000000, 4, 1, 3))


@query("directory_dates", f"SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND y = 2 AND hcol BETWEEN {D0} AND 20191231000000 AND hcol // 100000000 % 100 < 4")
def _(fx):
    """Files of candidate dates in one row of tiles; some of the candidates have no folder."""
    dates = fx.spark.range(1, 4).select((F.lit(D0 - 100000000) + F.col("id") * 100000000).alias("dt"))
    none = fx.spark.range(1).select(F.lit(20190215000000).alias("dt"))
    return _file_pixels(read_tile_files_on(fx.spark, _directory(fx), "t", dates.unionByName(none), 1, y=2))


@query("directory_range", "SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND x < 10 AND hcol BETWEEN 20190200000000 AND 20201200000000 AND hcol // 100000000 % 100 = 2")
def _(fx):
    return _file_pixels(read_tile_files_between(fx.spark, _directory(fx), "t", 20190200000000, 20201200000000, parts={"month": 2}).where("x < 10"))


# ---- datasets by name ----------------------------------------------------------------------------

def _named(fx):
    """The tiles under the name of product 1, whose two bands are the slices of its store block, and again under another name."""
    blocks = as_blocks(fx)
    mine, other = (blocks.withColumn("dsname", F.lit(name)) for name in ("ds/1", "ds/2"))
    return mine.unionByName(other), fx.product, fx.band


def _pixels(blocks):
    return explode_pixels(B.decode_blocks(blocks)).select(*_PIXEL)


@query("dataset_first_date", "SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND hcol = (SELECT min(hcol) FROM fx_px)")
def _(fx):
    return _pixels(DS.dataset(*_named(fx), fx.tile_item, "ds/1"))


@query("dataset_between_capped", """SELECT hcol, z, y, x, 0 AS band, pos, dn FROM (SELECT *, dense_rank() OVER (PARTITION BY z, y, x ORDER BY hcol) AS k FROM fx_px
WHERE status = 0 AND band = 1 AND hcol BETWEEN 20190200000000 AND 20201200000000 AND hcol // 1000000 % 100 = 0) t WHERE k <= 30""")
def _(fx):
    return _pixels(DS.between(*_named(fx), "ds/1", 20190200000000, 20201200000000, [1], cap=30, day=0))


@query("dataset_between_uncapped", """SELECT hcol, z, y, x, 0 AS band, pos, dn FROM fx_px
WHERE status = 0 AND band = 1 AND hcol BETWEEN 20190200000000 AND 20201200000000 AND hcol // 1000000 % 100 = 0""")
def _(fx):
    return _pixels(DS.between(*_named(fx), "ds/1", 20190200000000, 20201200000000, [1], day=0))


@query("dataset_collection", f"SELECT hcol, z, y, x, band, pos, dn FROM fx_px WHERE status = 0 AND hcol BETWEEN {D0} AND {D0 + 100000000}")
def _(fx):
    dates = C.build_collections(fx.tile_item, CollectionSpec(Period(D0, D0 + 100000000)))
    return _pixels(DS.collection(*_named(fx), "ds/1", dates))


# ---- bands in several store blocks ---------------------------------------------------------------

_TWO_PX = f"""SELECT dsname, w.place AS band, hcol, z, y, x, status, pos, CASE WHEN dn = {FILL} THEN dn ELSE dn + w.plus END AS dn, gx, gy
FROM fx_px JOIN (VALUES (0, 1, 1000), (1, 0, 0), (2, 0, 1000)) AS w(place, band, plus) USING (band) WHERE status = 0"""
_TWO_INFO = ('{"proj":"EPSG:4326","minZoom":0,"maxZoom":4,"dataType":3,"timeType":5,"hTableName":"t","tileWid":8,"tileHei":8,"styleid":1}')


def _two_blocks(fx):
    """Tiles with two store blocks, the second 1000 higher, of a product whose bands lie in both, not in the order of slices."""
    raised = good_tiles(fx.tile).withColumn("hpid", F.lit(2)).withColumn("dn", F.transform("dn", lambda v: F.when(v == FILL, v).otherwise(v + 1000)))
    second = B.encode_tiles(raised, ["dsname", "hpid", "hcol", *KEYS]).withColumn("status", F.lit(0))
    products = fx.spark.createDataFrame([(1, "mod/vi", 0, "hbase", _TWO_INFO), (2, "mod/other", 0, "hbase", _TWO_INFO)],
                                        "pid int, name string, userid int, source string, info string")
    info = '{"hPid":%d,"bsqIndex":%d,"bName":"b","scale":1,"offset":0,"validMin":0,"validMax":1,"noData":0}'
    bands = fx.spark.createDataFrame([(1, 0, info % (2, 1)), (1, 1, info % (1, 0)), (1, 2, info % (2, 0)), (2, 0, info % (1, 0))],
                                     "pid int, bindex int, info string")
    return as_blocks(fx).unionByName(second), products, bands


_ORDER = {"dsname": "mod/vi", "jsfile": "", "roi": "sys:12", "filldata": FILL, "validMinInc": LOW, "validMaxInc": HIGH, "dt": D0, "method": "max",
          "whole_start": _WHOLE.start, "whole_start_inc": 1, "whole_stop": _WHOLE.stop, "whole_stop_inc": 1, "repeat_type": "m", "repeat_start": 0,
          "repeat_start_inc": 1, "repeat_stop": 31235959, "repeat_stop_inc": 1, "repeat_stopnextyear": 0}


def _order(fx, fields, **more):
    """The order as a document in a folder, read back."""
    path = shared_folder(fx.spark, "order")
    fx.spark.createDataFrame([(json.dumps(_ORDER | more),)], "value string").coalesce(1).write.text(path)
    return read_order(fx.spark, path, fields)


@query("zonal_two_blocks", f"SELECT * FROM ({zonal_sql(f'SELECT * FROM ({_TWO_PX}) q WHERE hcol = {D0}')}) r WHERE roi_id = 'sys:12'")
def _(fx):
    blocks, products, bands = _two_blocks(fx)
    return rounded(O.run_statistics(_order(fx, STATISTIC_FIELDS), blocks, fx.seg, products, bands))


@query("series_two_blocks", "SELECT * FROM (" + series_sql(
    f"SELECT *, (hcol // 100000000)::varchar AS key FROM ({_TWO_PX}) q WHERE hcol BETWEEN {_WHOLE.start} AND {_WHOLE.stop}", "max") + ") r WHERE roi_id = 'sys:12'")
def _(fx):
    blocks, products, bands = _two_blocks(fx)
    return rounded(O.run_series(_order(fx, SERIES_FIELDS), blocks, fx.seg, products, fx.tile_item, bands))


@query("script_series_order", "SELECT * FROM (" + zonal_sql(f"""SELECT key, z, y, x, band, pos, gx, gy, coalesce(max(CASE WHEN {VALID} THEN dn END) - min(CASE WHEN {VALID} THEN dn END), {FILL}) AS dn
FROM (SELECT *, (hcol // 100000000)::varchar AS key FROM ({_TWO_PX}) q WHERE hcol BETWEEN {_WHOLE.start} AND {_WHOLE.stop}) p GROUP BY key, z, y, x, band, pos, gx, gy""", ("key",)) + ") r WHERE roi_id = 'sys:12'")
def _(fx):
    """A script order read from a document; the function it calls is a fold over the dates of a month."""
    blocks, products, bands = _two_blocks(fx)
    order = _order(fx, SERIES_FIELDS, baseddsname="mod/vi", caller="spread")
    return rounded(O.run_script_series(order, blocks, fx.seg, products, fx.tile_item, {"spread": spread_fold()}, bands))


@query("tile_order_region", f"""SELECT z, y, x, band, pos, CASE WHEN dn <> {FILL} AND EXISTS (SELECT 1 FROM fx_seg s WHERE s.roi_id = 'sys:12' AND s.z = q.z AND s.gy = q.gy AND q.gx BETWEEN s.x0 AND s.x1)
 THEN dn + 1 ELSE {FILL} END AS dn FROM ({_TWO_PX}) q WHERE hcol = {D0} AND y BETWEEN (SELECT (min(gy) - 1) // 8 FROM fx_seg WHERE roi_id = 'sys:12') AND (SELECT (max(gy) + 1) // 8 FROM fx_seg WHERE roi_id = 'sys:12')
 AND x BETWEEN (SELECT (min(x0) - 1) // 8 FROM fx_seg WHERE roi_id = 'sys:12') AND (SELECT (max(x1) + 1) // 8 FROM fx_seg WHERE roi_id = 'sys:12')""")
def _(fx):
    """A tile order read from a document: tiles of a region of a product with two store blocks are computed, written and read back."""
    blocks, products, bands = _two_blocks(fx)
    out = fx.spark.createDataFrame([(9, "out", 4, "hbase", "{}")], products.schema)
    catalog = T.Catalog(products.unionByName(out), bands, fx.tile_item)
    path = shared_folder(fx.spark, "ordered") + "/tiles"
    order = _order(fx, TILE_FIELDS, jsfile="plus", mpid_hpid=9, out_htable="t", out_hcol=20200500000000)
    done = O.run_tiles(order, blocks, fx.seg, catalog, {"plus": plus_one}, [("mod/vi", 0)], path)
    assert (done.bad, done.catalog.items.where("pid = 9").count()) == (0, 1)
    return explode_pixels(B.decode_blocks(read_tiles(fx.spark, path, "out", 4))).select(*KEYS, "band", "pos", "dn")


@query("series_rows_in_order", f"""SELECT key, band, row_number() OVER (ORDER BY key, band) AS place FROM (
SELECT DISTINCT (hcol // 100000000)::varchar AS key, band FROM ({_TWO_PX}) q JOIN fx_seg s ON q.z = s.z AND q.gy = s.gy AND q.gx BETWEEN s.x0 AND s.x1
WHERE s.roi_id = 'sys:12' AND hcol BETWEEN {_WHOLE.start} AND {_WHOLE.stop}) k""")
def _(fx):
    """The order of the job's rows, as numbers."""
    blocks, products, bands = _two_blocks(fx)
    out = O.run_series(_order(fx, SERIES_FIELDS), blocks, fx.seg, products, fx.tile_item, bands)
    placed = out.withColumn("_at", F.monotonically_increasing_id())
    return placed.select("key", "band", F.row_number().over(Window.orderBy("_at")).alias("place"))


@query("dataset_to_stats", zonal_sql(f"SELECT * FROM ({_TWO_PX}) q WHERE hcol = {D0}"))
def _(fx):
    blocks, products, bands = _two_blocks(fx)
    return rounded(S.zonal_stats_blocks(DS.dataset(blocks, products, bands, fx.tile_item, "mod/vi", D0), regions(fx), *ARGS))


@query("compute_two_blocks", f"""SELECT z, y, x, band, pos, CASE WHEN dn = {FILL} THEN dn ELSE dn + 1 END AS dn FROM ({_TWO_PX}) q WHERE hcol = {D0}""")
def _(fx):
    blocks, products, bands = _two_blocks(fx)
    done = T.compute_tiles(DS.resolved(blocks, products, bands, "mod/vi"), plus_one, [("mod/vi", D0)], "out", 9, 1, 4)
    return explode_pixels(B.decode_blocks(good_tiles(done))).select(*KEYS, "band", "pos", "dn")
