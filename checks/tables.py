"""Queries over the catalog tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from checks.registry import Registry
from tilewright.functions import text as X
from tilewright.operators import catalog as K
from tilewright.plans.orders import run_query
from tilewright.session import shared_folder
from tilewright.sinks import registry as G
from tilewright.sources.catalog import with_band_info, with_product_info

query = Registry()

# ---- products ------------------------------------------------------------------------------------

_INFO = """SELECT pid, name, userid, source, info->>'proj' AS proj, (info->>'maxZoom')::int AS max_zoom, (info->>'dataType')::int AS data_type,
 (info->>'timeType')::int AS time_type, info->>'hTableName' AS tab, (info->>'styleid')::int AS styleid FROM fx_product"""
_BANDS = """SELECT pid, count(*) AS bands, string_agg(info->>'bName', ',' ORDER BY bindex) AS names FROM fx_band GROUP BY pid"""
_LATEST = """SELECT pid, max(hcol) AS latest_hcol, min(fid) AS latest_fid, min(dt0) AS latest_dt0 FROM fx_item i WHERE hcol = (SELECT max(hcol) FROM fx_item j WHERE j.pid = i.pid) GROUP BY pid"""


def _full_sql(where="true"):
    return f"""SELECT p.pid, p.name, p.proj, p.max_zoom, p.data_type, coalesce(b.bands, 0) AS bands, b.names, s.hfamily, s.hpidbytenum, d.dpid, d.productname, d.visible, d.cat, d.iorder,
 l.latest_hcol, l.latest_fid FROM ({_INFO}) p LEFT JOIN ({_BANDS}) b ON b.pid = p.pid LEFT JOIN fx_store s ON s.htablename = p.tab
 LEFT JOIN fx_display d ON d.pid = p.pid LEFT JOIN ({_LATEST}) l ON l.pid = p.pid WHERE {where}"""


def _full(fx, products):
    full = K.products_full(products, fx.band, fx.store, fx.display, fx.item)
    return full.select("pid", "name", "proj", F.col("maxZoom").alias("max_zoom"), F.col("dataType").alias("data_type"),
                       F.size("bands").alias("bands"), F.array_join(F.transform("bands", lambda b: b["bName"]), ",").alias("names"),
                       "hfamily", "hpidbytenum", "dpid", "productname", "visible", "cat", "iorder", "latest_hcol", "latest_fid")


@query("product_full", _full_sql("p.userid = 0"))
def _(fx):
    return _full(fx, K.system_products(fx.product))


@query("product_by_name", _full_sql("p.name = 'ds/42'"))
def _(fx):
    return _full(fx, K.product_by_name(fx.product, "ds/42"))


@query("product_unknown", _full_sql("p.name = 'ds/none'"))
def _(fx):
    return _full(fx, K.product_by_name(fx.product, "ds/none"))


@query("product_by_id", _full_sql("p.pid = 36"))
def _(fx):
    return _full(fx, K.product_by_id(fx.product, 36))


@query("latest_item", _LATEST)
def _(fx):
    return K.latest_items(fx.item)


@query("item_page", "SELECT fid, hcol FROM fx_item WHERE pid = 7 ORDER BY hcol DESC, fid LIMIT 15 OFFSET 30")
def _(fx):
    return K.item_page(fx.item, 7, 2, 15, ascending=False).select("fid", "hcol")


@query("item_pages_by_seek", "SELECT fid, hcol FROM fx_item WHERE pid = 7 ORDER BY hcol DESC, fid LIMIT 15 OFFSET 30")
def _(fx):
    """The third page, each page starting behind the last row of the one before."""
    last = None
    for _ in range(2):
        last = tuple(K.item_page_after(fx.item, 7, 15, last, ascending=False).select("hcol", "fid").collect()[-1])
    return K.item_page_after(fx.item, 7, 15, last, ascending=False).select("fid", "hcol")


def _shown(pid, text):
    d = "lpad(dt0::varchar, 14, '0')"
    return f"(SELECT {pid} AS pid, fid, hcol, {text.format(y=f'substr({d}, 1, 4)', m=f'substr({d}, 5, 2)', d=f'substr({d}, 7, 2)')} AS label FROM fx_item WHERE pid = {pid} ORDER BY hcol, fid LIMIT 12)"


@query("item_labels", _shown(3, "concat({y}, '年', {m}, '月', {d}, '日')") + " UNION ALL " + _shown(4, "concat({y}, '年', {m}, '月')") + " UNION ALL " + _shown(6, "concat({y}, '年')"))
def _(fx):
    """First items of products whose scale is the day, the month and the year."""
    lists = [K.item_list(fx.item, fx.product, 12, pid=pid).select(F.lit(pid).alias("pid"), "fid", "hcol", "label") for pid in (3, 4, 6)]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


@query("band_info", """SELECT pid, bindex, (info->>'scale')::double AS scale, (info->>'offset')::double AS "offset", (info->>'noData')::double AS no_data FROM fx_band""")
def _(fx):
    return with_band_info(fx.band).select("pid", "bindex", "scale", "offset", F.col("noData").alias("no_data"))


# ---- displays and categories ---------------------------------------------------------------------

@query("category_tree", """SELECT c.itype, c.catid, c.catname, c.iorder AS cat_order, d.dpid, d.pid, d.iorder FROM fx_category c
LEFT JOIN fx_display d ON d.cat = c.catid AND d.visible = 1 WHERE c.visible = 1""")
def _(fx):
    return K.category_tree(fx.category, fx.display)


@query("category_products", "SELECT dpid, cat, iorder FROM fx_display WHERE visible = 1 AND cat = 3")
def _(fx):
    return K.visible_displays(fx.display, 3)


@query("visible_displays", "SELECT dpid, cat, iorder FROM fx_display WHERE visible = 1")
def _(fx):
    return K.visible_displays(fx.display)


@query("categories_with_counts", """SELECT c.catid, c.catname, c.iorder, count(d.dpid) AS n FROM (SELECT * FROM fx_category WHERE itype = 1 AND visible = 1 ORDER BY iorder LIMIT 100) c
LEFT JOIN fx_display d ON d.cat = c.catid GROUP BY c.catid, c.catname, c.iorder""")
def _(fx):
    shown = K.categories(fx.category, itype=1, visible=True, limit=K.CATEGORY_LIMIT)
    counts = K.count_by(fx.display, "cat").withColumnRenamed("cat", "catid")
    return shown.join(counts, "catid", "left").na.fill(0, ["n"]).select("catid", "catname", "iorder", "n")


@query("search_products", """SELECT dpid FROM fx_display WHERE contains(lower(productname), 'brand#1') OR contains(lower(subtitle), 'brand#1')
 OR contains(lower(satellite), 'brand#1') OR contains(lower(sensor), 'brand#1') ORDER BY dpid LIMIT 20""")
def _(fx):
    return K.search_displays(fx.display, "brand#1", K.SEARCH_LIMIT)


@query("search_products_all", """SELECT dpid FROM fx_display WHERE contains(lower(productname), 'brand#1') OR contains(lower(subtitle), 'brand#1')
 OR contains(lower(satellite), 'brand#1') OR contains(lower(sensor), 'brand#1')""")
def _(fx):
    return K.search_displays(fx.display, "brand#1")


_WORDS = ("brand#1", "Steel", "re", "s1", "e", "olish tin", "no such thing")


@query("search_products_indexed", " UNION ALL ".join(f"""SELECT '{w}' AS word, dpid FROM fx_display WHERE contains(lower(productname), lower('{w}')) OR contains(lower(subtitle), lower('{w}'))
 OR contains(lower(satellite), lower('{w}')) OR contains(lower(sensor), lower('{w}'))""" for w in _WORDS))
def _(fx):
    """Several words, by way of an index that is written and read back."""
    columns, path, out = ("productname", "subtitle", "satellite", "sensor"), shared_folder(fx.spark, "grams"), None
    K.write_text_index(K.text_index(fx.display, "dpid", columns), path)
    for word in _WORDS:
        found = K.search_indexed(fx.display, fx.spark.read.parquet(path), "dpid", columns, word).select(F.lit(word).alias("word"), "dpid")
        out = found if out is None else out.unionByName(found)
    return out


@query("categories_all", "SELECT catid, catname, visible, iorder, itype FROM fx_category")
def _(fx):
    return K.categories(fx.category).select("catid", "catname", "visible", "iorder", "itype")


@query("search_layers", """SELECT smid, productname, iorder FROM (SELECT dpid AS smid, productname, iorder FROM fx_display) t WHERE contains(lower(productname), 're')""")
def _(fx):
    found = K.layers(fx.display.withColumnRenamed("dpid", "smid"), "RE")
    return found.select("smid", "productname", "iorder")


_DAY = datetime.date(2024, 3, 3)


def _filled(text, day):
    for back in range(8):
        text = f"replace({text}, '{{{{{{DATE-{back}}}}}}}', '{(day - datetime.timedelta(back)):%Y%m%d}')"
    return f"replace({text}, '{{{{{{DATE}}}}}}', '{day:%Y%m%d}')"


@query("template_fill", f"SELECT dpid, CASE WHEN type = 'xyz' THEN {_filled('params', _DAY)} ELSE params END AS params FROM fx_display")
def _(fx):
    return K.filled_displays(fx.display, F.lit(_DAY)).select("dpid", "params")


@query("meta_lookup", "SELECT pk, theid, metavali, metavalstr FROM fx_meta WHERE metakey = 'PD_GOTS'")
def _(fx):
    return K.metadata(fx.meta, "PD_GOTS").select("pk", "theid", "metavali", "metavalstr")


@query("meta_of_product", "SELECT pk, metavali FROM fx_meta WHERE metakey = 'PD_GOTS' AND theid = 504")
def _(fx):
    return K.metadata(fx.meta, "PD_GOTS", 504).select("pk", "metavali")


# ---- areas and regions ---------------------------------------------------------------------------

@query("area_children", """SELECT id, code, name, parent_code, EXISTS (SELECT 1 FROM fx_area c WHERE c.parent_code = a.code) AS has_children FROM fx_area a""")
def _(fx):
    return K.with_children_flag(fx.area).select("id", "code", "name", "parent_code", "has_children")


@query("areas_below", """SELECT id, name, EXISTS (SELECT 1 FROM fx_area c WHERE c.parent_code = a.code) AS has_children FROM fx_area a WHERE parent_code = 'N3'""")
def _(fx):
    return K.areas_below(fx.area, "N3").select("id", "name", "has_children")


@query("area_leaves", "SELECT id, code FROM fx_area a WHERE NOT EXISTS (SELECT 1 FROM fx_area c WHERE c.parent_code = a.code)")
def _(fx):
    return K.leaf_areas(fx.area).select("id", "code")


def _user_regions(fx):
    return fx.customer.selectExpr("c_custkey AS rid", "c_name AS name", "concat('u/', cast(c_custkey AS string)) AS path", "c_nationkey AS rcid")


@query("region_info_union", """SELECT 'area' AS rtype, id AS rid, name, 'a/' || code AS path FROM fx_area
UNION ALL SELECT 'user', c_custkey, c_name, 'u/' || c_custkey::varchar FROM customer""")
def _(fx):
    areas = fx.area.withColumn("path", F.concat(F.lit("a/"), "code"))
    return K.region_info(areas, _user_regions(fx))


@query("search_regions", "SELECT id AS rid, name FROM fx_area WHERE contains(lower(name), 'on_1') ORDER BY id LIMIT 12")
def _(fx):
    return K.search_regions(fx.area.withColumnRenamed("id", "rid"), "ON_1", 12).select("rid", "name")


@query("region_page", "SELECT c_custkey AS rid, c_name AS name FROM customer WHERE c_nationkey = 3 ORDER BY c_custkey LIMIT 20 OFFSET 20")
def _(fx):
    return K.region_page(_user_regions(fx), 3, 1).select("rid", "name")


@query("roi_count_by_category", "SELECT c_nationkey AS rcid, count(*) AS n FROM customer GROUP BY c_nationkey")
def _(fx):
    return K.count_by(_user_regions(fx), "rcid")


# ---- tasks, scripts, preload lists ---------------------------------------------------------------

@query("task_page", "SELECT ofid, mode, status, tag FROM fx_task WHERE uid = 4 ORDER BY ofid DESC LIMIT 5 OFFSET 5")
def _(fx):
    return K.task_page(fx.task, 4, 1, 5).select("ofid", "mode", "status", "tag")


@query("task_count", "SELECT uid, count(*) AS n FROM fx_task GROUP BY uid")
def _(fx):
    return K.count_by(fx.task, "uid")


@query("task_by_id", "SELECT ofid, mode, uid, status, tag FROM fx_task WHERE ofid = 77")
def _(fx):
    return K.task_by_id(fx.task, 77)


_SCRIPTS = "SELECT o_orderkey AS sid, o_orderpriority AS title, o_orderdate::date::varchar AS utime, o_custkey % 7 AS uid FROM orders"


def _scripts(fx):
    return fx.orders.selectExpr("o_orderkey AS sid", "o_orderpriority AS title", "cast(cast(o_orderdate AS date) AS string) AS utime", "o_custkey % 7 AS uid")


@query("newest_scripts", f"SELECT sid, title, utime FROM ({_SCRIPTS}) s WHERE uid = 2 ORDER BY utime DESC, sid DESC LIMIT 50")
def _(fx):
    return K.newest(_scripts(fx), "utime", "sid", K.SCRIPT_LIMIT, uid=2).select("sid", "title", "utime")


@query("newest_files", "SELECT fid FROM (SELECT p_partkey AS fid, p_brand AS type FROM part) f WHERE type = 'Brand#1' OR type = 'Brand#12' ORDER BY fid DESC LIMIT 100")
def _(fx):
    files = fx.part.selectExpr("p_partkey AS fid", "p_brand AS type")
    return K.newest(files.where(F.col("type").isin("Brand#1", "Brand#12")), "fid", "fid", K.FILE_LIMIT).select("fid")


@query("scripts_as_products", f"""SELECT 'us' || sid::varchar AS displayid, sid AS pid, uid AS userid, title AS productname, utime AS subtitle,
 '{{"sid":' || sid::varchar || '}}' AS params, 12 AS maxZoom, 'us' AS type FROM ({_SCRIPTS}) s""")
def _(fx):
    return K.scripts_as_products(_scripts(fx)).select("displayid", "pid", "userid", "productname", "subtitle", "params", "maxZoom", "type")


@query("preload_or_default", """SELECT u.uid, coalesce(o.id, d.id) AS premapid, CASE WHEN o.id IS NOT NULL THEN o.list ELSE d.list END AS preloadlist
FROM (SELECT DISTINCT c_custkey % 40 AS uid FROM customer) u LEFT JOIN (SELECT uid, max(premapid) AS id, arg_max(preloadlist, premapid) AS list FROM fx_preload GROUP BY uid) o ON o.uid = u.uid
CROSS JOIN (SELECT max(premapid) AS id, arg_max(preloadlist, premapid) AS list FROM fx_preload WHERE uid = 0) d""")
def _(fx):
    users = fx.customer.selectExpr("c_custkey % 40 AS uid").distinct()
    return K.preload_lists(users, fx.preload)


# ---- inputs, keys, parameters --------------------------------------------------------------------

_PAIRS = """SELECT id, split_part(p, ',', 1) AS dsname, try_cast(split_part(p, ',', 2) AS bigint) AS dt FROM (SELECT id, unnest(string_split(pairs, ';')) AS p FROM fx_lineage WHERE id % 11 <> 0) t WHERE p <> ''"""


@query("lineage_parse", _PAIRS)
def _(fx):
    return K.lineage_rows(fx.lineage, "id", "pairs")


@query("lineage_regions", "SELECT id, roi AS roi_id FROM (SELECT id, unnest(string_split(rois, ';')) AS roi FROM fx_lineage) t WHERE roi <> ''")
def _(fx):
    return K.region_names(fx.lineage, "id", "rois")


@query("common_zoom_and_proj", f"""SELECT l.id, count(CASE WHEN p.proj IS NULL THEN 1 END) AS unknown, count(DISTINCT p.proj) = 1 AS same_proj, min(p.max_zoom) AS max_zoom,
 coalesce(arg_min(p.styleid, l.dt) FILTER (WHERE p.styleid > 0), 0) AS styleid FROM ({_PAIRS}) l LEFT JOIN ({_INFO}) p ON p.name = l.dsname GROUP BY l.id""")
def _(fx):
    inputs = K.lineage_rows(fx.lineage, "id", "pairs").withColumnRenamed("dt", "ord")
    return K.common_inputs(inputs, fx.product, "id")


@query("md5_key", "SELECT pid, md5(info) AS key FROM fx_product")
def _(fx):
    return fx.product.select("pid", X.md5_key(F.col("info")).alias("key"))


@query("has_params", """SELECT id, id % 7 <> 6 AND params NOT IN ('', '{}', 'null', 'undefined') AS given FROM (SELECT p_partkey AS id,
 CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '{}' WHEN 2 THEN 'null' WHEN 3 THEN 'undefined' ELSE '{"a":1}' END AS params FROM part) t""")
def _(fx):
    rows = fx.part.selectExpr("p_partkey AS id", """CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '{}' WHEN 2 THEN 'null' WHEN 3 THEN 'undefined' ELSE '{"a":1}' END AS params""",
                              "CASE WHEN p_partkey % 7 = 6 THEN 'let a=1' ELSE 'let sdui={}' END AS script")
    return rows.select("id", X.has_params(F.col("script"), F.col("params")).alias("given"))


@query("params_query", "SELECT pid, count(*) AS n FROM fx_item WHERE hcol >= 19960101000000 AND pid < 20 GROUP BY pid")
def _(fx):
    text = "SELECT pid, count(*) AS n FROM {items} WHERE hcol >= :start AND pid < :top GROUP BY pid"
    return run_query(fx.spark, text, '{"start": 19960101000000, "top": 20}', items=fx.item)


# ---- output rows ---------------------------------------------------------------------------------

@query("output_bands", """SELECT pid, bindex, pid AS hpid, 'B' || (bindex + 1)::varchar AS bname, 1.0::double AS scale, 0.0::double AS "offset", 255.0::double AS valid_max, -19999.0::double AS no_data
FROM (SELECT pid, unnest(range(pid % 4)) AS bindex FROM fx_product) t""")
def _(fx):
    made = fx.product.select("pid", F.col("pid").alias("hpid"), (F.col("pid") % 4).cast("int").alias("nbands"))
    return with_band_info(G.output_bands(made, -19999)).select(
        "pid", "bindex", F.col("hPid").alias("hpid"), F.col("bName").alias("bname"), "scale", "offset",
        F.col("validMax").alias("valid_max"), F.col("noData").alias("no_data"))


@query("output_item", "SELECT pid, fid AS hcol, fid AS dt0, fid + 1 AS dt1, -180.0::double AS left, 180.0::double AS right, 90.0::double AS top, -90.0::double AS bottom FROM fx_item")
def _(fx):
    made = fx.item.select("pid", F.col("fid").alias("hcol"), F.lit(-180.0).alias("left"), F.lit(180.0).alias("right"),
                          F.lit(90.0).alias("top"), F.lit(-90.0).alias("bottom"))
    return G.output_item(made)


@query("output_product", """SELECT pid, name, userid, 'EPSG:4326' AS proj, (pid % 12)::int AS max_zoom, 3 AS data_type, 'out' AS tab, 256 AS side, 'deflate' AS compress, 1 AS styleid FROM fx_product""")
def _(fx):
    made = fx.product.select("pid", "name", "userid", F.lit("EPSG:4326").alias("proj"), (F.col("pid") % 12).cast("int").alias("maxzoom"),
                             F.lit(3).alias("data_type"), F.lit("out").alias("table"), F.lit(1).alias("styleid"))
    return with_product_info(G.output_product(made)).select(
        "pid", "name", "userid", "proj", F.col("maxZoom").alias("max_zoom"), F.col("dataType").alias("data_type"),
        F.col("hTableName").alias("tab"), F.col("tileWid").alias("side"), "compress", "styleid")


@query("replace_rows", """SELECT pid, bindex, CASE WHEN bindex = 2 THEN 'new' ELSE 'old' END AS state FROM fx_band""")
def _(fx):
    old = fx.band.select("pid", "bindex", F.lit("old").alias("state"))
    return G.replace_rows(old, old.where("bindex = 2").withColumn("state", F.lit("new")), ["pid", "bindex"])
