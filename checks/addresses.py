"""Queries over dates, nearest items, the tile grid and extents."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Registry
from tilewright.functions import dates as D, grid as G
from tilewright.operators import collections as C, nearest as N, regions as R
from tilewright.operators.pixels import covering_tiles

query = Registry()

# ---- nearest items -------------------------------------------------------------------------------

_ITEMS = "SELECT pid, dt0, min(fid) AS fid FROM fx_item GROUP BY pid, dt0"
_DT1 = "(SELECT i.dt1 FROM fx_item i WHERE i.pid = q.pid AND i.fid = q.fid)"
_PROBES = "SELECT pid, dt, count(*) AS n FROM fx_probe GROUP BY pid, dt"


def _asof_sql(test):
    return f"""SELECT p.pid, p.dt, p.n, i.fid, i.dt0 FROM ({_PROBES}) p ASOF LEFT JOIN ({_ITEMS}) i ON p.pid = i.pid AND {test}"""


def _probe_keys(fx):
    return fx.probe.groupBy("pid", "dt").agg(F.count(F.lit(1)).alias("n"))


@query("nearest_before", _asof_sql("p.dt >= i.dt0"))
def _(fx):
    return N.nearest_keys(_probe_keys(fx), fx.item).select("pid", "dt", "n", "fid", "dt0")


@query("nearest_after", _asof_sql("p.dt < i.dt0"))
def _(fx):
    return N.nearest_keys(_probe_keys(fx), fx.item, after=True).select("pid", "dt", "n", "fid", "dt0")


@query("nearest_before_rows", f"""SELECT l.l_orderkey, l.l_linenumber, l.pid, l.dt, q.fid FROM fx_probe l JOIN ({_asof_sql("p.dt >= i.dt0")}) q ON q.pid = l.pid AND q.dt = l.dt""")
def _(fx):
    return N.nearest_before(fx.probe, fx.item).select("l_orderkey", "l_linenumber", "pid", "dt", "fid")


@query("contained_flag", f"""SELECT q.pid, q.dt, q.n, q.fid, coalesce(q.dt >= q.dt0 AND q.dt < i.dt1, false) AS contained
FROM ({_asof_sql("p.dt >= i.dt0")}) q LEFT JOIN fx_item i ON i.pid = q.pid AND i.fid = q.fid""")
def _(fx):
    hits = N.with_contained(N.nearest_keys(_probe_keys(fx), fx.item))
    return hits.select("pid", "dt", "n", "fid", "contained")


@query("default_date", """SELECT p.pid, CASE WHEN l_linenumber % 3 = 0 THEN f.first ELSE p.dt END AS dt, count(*) AS n FROM fx_probe p
LEFT JOIN (SELECT pid, min(hcol) AS first FROM fx_item GROUP BY pid) f ON f.pid = p.pid GROUP BY ALL""")
def _(fx):
    asked = fx.probe.withColumn("dt", F.when(F.col("l_linenumber") % 3 == 0, F.lit(0)).otherwise(F.col("dt")))
    return N.with_default_date(asked, fx.item).groupBy("pid", "dt").agg(F.count(F.lit(1)).alias("n"))


# ---- dates ---------------------------------------------------------------------------------------

@query("date_parts", """SELECT event_id, dt // 10000000000 AS year, dt // 100000000 % 100 AS month, dt // 1000000 % 100 AS day,
dt // 10000 % 100 AS hour, dt // 100 % 100 AS minute, dt % 100 AS second FROM fx_obs""")
def _(fx):
    return fx.obs.select("event_id", *D.date_parts(F.col("dt")))


@query("date_part_filter", "SELECT event_id, dt FROM fx_obs WHERE dt // 100000000 % 100 = 1 AND dt // 10000 % 100 = 12 AND dt BETWEEN 20240105000000 AND 20301231235959")
def _(fx):
    return C.filter_dates(fx.obs, 20240105000000, 20301231235959, month=1, hour=12, column="dt").select("event_id", "dt")


@query("period_test", "SELECT pid, count(*) AS n FROM fx_item WHERE hcol > 19950101000000 AND hcol <= 19991231000000 GROUP BY pid")
def _(fx):
    return fx.item.where(D.in_period(F.col("hcol"), D.Period(19950101000000, 19991231000000, False, True))).groupBy("pid").agg(
        F.count(F.lit(1)).alias("n"))


def _label_sql():
    def part(k, n):
        return f"lpad((dt // {k} % 100)::varchar, 2, '0')" if n else f"lpad((dt // {k})::varchar, 4, '0')"
    y, m, d, h, mi, s = (part(k, n) for k, n in ((10**10, 0), (10**8, 1), (10**6, 1), (10**4, 1), (100, 1), (1, 1)))
    day = f"{y} || '年' || {m} || '月' || {d} || '日'"
    season = " ".join(f"WHEN {v} THEN {y} || '{w}'" for v, w in ((3, "春季"), (6, "夏季"), (9, "秋季"), (12, "冬季")))
    return f"""SELECT event_id, scale, coalesce(CASE scale WHEN 1 THEN {day} || ' ' || {h} || ':' || {mi} || ':' || {s}
 WHEN 2 THEN {day} || ' ' || {h} || ':' || {mi} WHEN 3 THEN {day} || ' ' || {h} || '时' WHEN 4 THEN {day}
 WHEN 5 THEN {y} || '年' || {m} || '月' WHEN 6 THEN CASE dt // 100000000 % 100 {season} END WHEN 7 THEN {y} || '年' END, dt::varchar) AS label
FROM (SELECT event_id, dt, event_id % 9 AS scale FROM fx_obs) o"""


@query("date_labels", _label_sql())
def _(fx):
    scale = F.col("event_id") % 9
    return fx.obs.select("event_id", scale.alias("scale"), D.date_label(F.col("dt"), F.col("dt"), scale).alias("label"))


@query("candidate_dates", """WITH spans AS (SELECT pid, min(hcol) AS a, max(hcol) AS b FROM fx_item GROUP BY pid),
c AS (SELECT pid, dt FROM (SELECT pid, a, b, y.y * 10000000000 + 600000000 + d.d * 1000000 AS dt FROM spans, range(1990, 2010) y(y), range(1, 32) d(d)) t WHERE dt BETWEEN a AND b)
SELECT c.pid, c.dt, count(i.fid) AS n FROM c LEFT JOIN fx_item i ON i.pid = c.pid AND i.hcol = c.dt GROUP BY c.pid, c.dt""")
def _(fx):
    """Every June day between a product's first and last item, with its number of items."""
    spans = fx.item.groupBy("pid").agg(F.min("hcol").alias("a"), F.max("hcol").alias("b"))
    days = C.candidate_dates(spans, "a", "b", month=6, day=-1, hour=0, minute=0, second=0)
    per_date = fx.item.groupBy("pid", F.col("hcol").alias("dt")).agg(F.count("fid").alias("n"))
    return days.select("pid", "dt").join(per_date, ["pid", "dt"], "left").na.fill(0, ["n"])


@query("year_list", "SELECT DISTINCT pid, hcol // 10000000000 AS year FROM fx_item")
def _(fx):
    return C.year_list(fx.item)


@query("month_list", "SELECT DISTINCT pid, hcol // 100000000 AS year_month FROM fx_item WHERE hcol // 10000000000 = 1995")
def _(fx):
    return C.month_list(fx.item, 1995)


@query("month_items", "SELECT pid, fid, hcol FROM fx_item WHERE hcol // 100000000 = 199606")
def _(fx):
    return C.month_items(fx.item, 199606).select("pid", "fid", "hcol")


# ---- tile grid -----------------------------------------------------------------------------------

_LEVELS = (0, 1, 5, 12, 21)


def _at_levels(fx):
    return fx.point.withColumn("z", F.explode(F.array(*[F.lit(z) for z in _LEVELS])))


_POINTS = f"fx_point CROSS JOIN (VALUES {', '.join(f'({z})' for z in _LEVELS)}) AS l(z)"


@query("tile_of_point_strict", f"""SELECT id, z, x, y, x * size - 180 AS left, x * size - 180 + size AS right, 90 - y * size AS top, 90 - y * size - size AS bottom
FROM (SELECT id, z, 360::double / (1 << z) AS size,
 CASE WHEN ok THEN least(floor(floor((lon + 180) / (360::double / (1 << z) / 256)) / 256)::bigint, (1 << z) - 1) END AS x,
 CASE WHEN ok THEN least(floor(floor((90 - lat) / (360::double / (1 << z) / 256)) / 256)::bigint, greatest(1, (1 << z) // 2) - 1) END AS y
 FROM (SELECT *, lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AS ok FROM {_POINTS}) p) t""")
def _(fx):
    at = _at_levels(fx).withColumn("t", G.tile_of_point_strict(F.col("lon"), F.col("lat"), F.col("z")))
    return at.select("id", "z", *[F.col(f"t.{c}").alias(c) for c in ("x", "y", "left", "right", "top", "bottom")])


@query("tile_of_point_clamped", f"""SELECT id, z, greatest(0, least((1 << z) - 1, trunc((lon + 180) / (360::double / (1 << z) / 256) / 256)::bigint)) AS x,
 greatest(0, least(greatest(1, (1 << z) // 2) - 1, trunc((90 - lat) / (360::double / (1 << z) / 256) / 256)::bigint)) AS y FROM {_POINTS}""")
def _(fx):
    at = _at_levels(fx).withColumn("t", G.tile_of_point_clamped(F.col("lon"), F.col("lat"), F.col("z")))
    return at.select("id", "z", "t.x", "t.y")


@query("pixel_of_point", f"""SELECT id, z, fx // 256 AS x, fy // 256 AS y, fx % 256 AS col, fy % 256 AS row FROM (SELECT id, z,
 trunc((lon + 180) / (360::double / (1 << z) / 256) + 0.5)::bigint AS fx, trunc((90 - lat) / (180::double / ((1 << z) / 2.0::double) / 256) + 0.5)::bigint AS fy FROM {_POINTS}) t""")
def _(fx):
    at = _at_levels(fx).withColumn("t", G.pixel_of_point(F.col("lon"), F.col("lat"), F.col("z")))
    return at.select("id", "z", "t.x", "t.y", "t.col", "t.row")


# ---- extents -------------------------------------------------------------------------------------

_EXT = """SELECT id, grp, try_cast(split_part(ext, ',', 1) AS double) AS l, try_cast(split_part(ext, ',', 2) AS double) AS r,
 try_cast(split_part(ext, ',', 3) AS double) AS t, try_cast(split_part(ext, ',', 4) AS double) AS b FROM fx_extent WHERE len(split(ext, ',')) = 4 AND ext NOT LIKE 'a%'"""


def _extents(fx):
    parsed = fx.extent.withColumn("e", G.parse_extent(F.col("ext"))).where("e.left is not null")
    return parsed.select("id", "grp", "e.left", "e.right", "e.top", "e.bottom")


def _grown(extents, *keep):
    e = G.grow_extent(*[F.col(c) for c in ("left", "right", "top", "bottom")])
    return extents.withColumn("e", e).select(*keep, "e.left", "e.right", "e.top", "e.bottom")


_GROWN = "greatest(-180, l - 0.703125) AS l, least(180, r + 0.703125) AS r, least(90, t + 0.703125) AS t, greatest(-90, b - 0.703125) AS b"


@query("extent_parse_and_grow", f"SELECT id, l AS left, r AS right, t AS top, b AS bottom FROM (SELECT id, {_GROWN} FROM ({_EXT}) e) g")
def _(fx):
    return _grown(_extents(fx), "id")


def _tile_sql(z, size):
    """Tile range of columns l, r, t, b at zoom expression z with tiles of ``size`` pixels."""
    reso = f"(360::double / (1 << {z}) / {size})"
    x = f"least(floor(floor(({{}} + 180) / {reso}) / {size})::bigint, (1 << {z}) - 1)"
    y = f"least(floor(floor((90 - {{}}) / {reso}) / {size})::bigint, greatest(1, (1 << {z}) // 2) - 1)"
    return f"{x.format('l')} AS xmin, {x.format('r')} AS xmax, {y.format('t')} AS ymin, {y.format('b')} AS ymax"


@query("tile_range_of_extent", f"""SELECT id, z, {_tile_sql('z', 256)} FROM ({_EXT}) e CROSS JOIN (VALUES (0), (3), (9), (15)) AS v(z)
WHERE l BETWEEN -180 AND 180 AND r BETWEEN -180 AND 180 AND t BETWEEN -90 AND 90 AND b BETWEEN -90 AND 90""")
def _(fx):
    at = _extents(fx).withColumn("z", F.explode(F.array(*[F.lit(z) for z in (0, 3, 9, 15)])))
    r = G.tile_range(*[F.col(c) for c in ("left", "right", "top", "bottom")], F.col("z"))
    return at.withColumn("t", r).where("t.xmin is not null").select("id", "z", "t.xmin", "t.xmax", "t.ymin", "t.ymax")


@query("tile_range_of_region", f"""SELECT r.roi_id, r.z, xmin, xmax, ymin, ymax, count(t.hcol) AS tiles FROM (SELECT roi_id, 4 AS z, {_tile_sql('4', 8)} FROM (SELECT roi_id, {_GROWN} FROM
 (SELECT roi_id, min(x0) * 2.8125 - 180 AS l, (max(x1) + 1) * 2.8125 - 180 AS r, 90 - min(gy) * 2.8125 AS t, 90 - (max(gy) + 1) * 2.8125 AS b FROM fx_seg GROUP BY roi_id) s) g) r
LEFT JOIN fx_tile t ON t.z = r.z AND t.y BETWEEN r.ymin AND r.ymax AND t.x BETWEEN r.xmin AND r.xmax AND t.band = 0 GROUP BY r.roi_id, r.z, xmin, xmax, ymin, ymax""")
def _(fx):
    """Tile range of each grown region, and how many dated tiles lie in it.

    The tiles of the range are listed and joined by address: the range never becomes a join condition.
    """
    grown = _grown(R.region_extents(fx.seg, 8), "roi_id")
    listed = covering_tiles(grown, lambda a, b, c, d, z: G.tile_range(a, b, c, d, z, 8), [4])
    dated = fx.tile.where("band = 0").groupBy("z", "y", "x").agg(F.count("hcol").alias("n"))
    counted = listed.join(dated, ["z", "y", "x"], "left")
    return counted.groupBy("roi_id", "z").agg(
        F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("tiles"))


@query("pyramid_tiles", f"""WITH e AS ({_EXT}), r AS (SELECT id, z, {_tile_sql('z', 256)} FROM e CROSS JOIN range(0, 5) v(z)
 WHERE l BETWEEN -180 AND 180 AND r BETWEEN -180 AND 180 AND t BETWEEN -90 AND 90 AND b BETWEEN -90 AND 90)
SELECT z, y, x, count(*) AS extents FROM (SELECT z, x, unnest(generate_series(ymin, ymax)) AS y FROM (SELECT *, unnest(generate_series(xmin, xmax)) AS x FROM r) a) b GROUP BY z, y, x""")
def _(fx):
    """All tiles of levels 0 to 4 that any extent meets, with the number of extents."""
    listed = covering_tiles(_extents(fx).select("left", "right", "top", "bottom"), G.tile_range, range(5))
    return listed.groupBy("z", "y", "x").agg(F.count(F.lit(1)).alias("extents"))


@query("extent_intersection", f"""SELECT grp, greatest(-180, l - 0.703125) AS left, least(180, r + 0.703125) AS right, least(90, t + 0.703125) AS top, greatest(-90, b - 0.703125) AS bottom
FROM (SELECT grp, greatest(max(l), -180) AS l, least(min(r), 180) AS r, least(min(t), 90) AS t, greatest(max(b), -90) AS b FROM ({_EXT}) e GROUP BY grp) c""")
def _(fx):
    return _grown(R.common_extent(_extents(fx), ["grp"]), "grp")


@query("tile_bounds", """SELECT DISTINCT z, y, x, hcol, x * 22.5::double - 180 AS left, (x + 1) * 22.5::double - 180 AS right, 90 - y * 22.5::double AS top, 90 - (y + 1) * 22.5::double AS bottom,
 360::double / 128 AS reso FROM fx_tile""")
def _(fx):
    b = G.tile_bounds(F.col("z"), F.col("y"), F.col("x"), 8)
    cells = fx.tile.select("z", "y", "x", "hcol").distinct().withColumn("b", b)
    return cells.select("z", "y", "x", "hcol", "b.left", "b.right", "b.top", "b.bottom", G.resolution(F.col("z"), 8).alias("reso"))
