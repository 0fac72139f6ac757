"""Catalog queries: products, displays, categories, areas, regions, tasks.

Each is one plan over the catalog tables. Lists with a limit have a total order, so the same rows
come back every time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.functions.dates import date_label
from tilewright.functions.text import contains_any, fill_template, lineage_pairs, non_empty_parts
from tilewright.operators.sides import fits_broadcast, hinted
from tilewright.sources.catalog import with_band_info, with_product_info

# Limits of the lists (fixed values).
SEARCH_LIMIT, SCRIPT_LIMIT, FILE_LIMIT, CATEGORY_LIMIT, ROI_PAGE = 20, 50, 100, 100, 20
# Visible and system flags (fixed values).
SYSTEM_USER, VISIBLE = 0, 1


# ---- products ------------------------------------------------------------------------------------

def bands_of(bands: DataFrame) -> DataFrame:
    """The bands of each product in order; their number is what one product is made of."""
    one = F.struct("bindex", "hPid", "bsqIndex", "bName", "scale", "offset", "validMin", "validMax", "noData")
    return with_band_info(bands).groupBy("pid").agg(F.array_sort(F.collect_list(one)).alias("bands"))


def latest_items(items: DataFrame) -> DataFrame:
    """Newest item of every product; of several on that date the smallest fid."""
    per_date = items.groupBy("pid", "hcol").agg(F.min("fid").alias("fid"), F.min_by("dt0", "fid").alias("dt0"))
    return per_date.groupBy("pid").agg(F.max("hcol").alias("latest_hcol"), F.max_by("fid", "hcol").alias("latest_fid"),
                                       F.max_by("dt0", "hcol").alias("latest_dt0"))


def products_with_store(products: DataFrame, bands: DataFrame, stores: DataFrame) -> DataFrame:
    """Products with JSON fields, bands and store table; a product without a store row stays."""
    return (with_product_info(products).join(bands_of(bands), "pid", "left")
            .join(stores.withColumnRenamed("htablename", "hTableName"), "hTableName", "left"))


def products_full(products: DataFrame, bands: DataFrame, stores: DataFrame, displays: DataFrame,
                  items: DataFrame, language: str = "zh") -> DataFrame:
    """Products joined to everything known of them, with the label of their latest item's real start."""
    one_display = displays.groupBy("pid").agg(F.min("dpid").alias("dpid"))
    shown = displays.join(one_display, ["pid", "dpid"]).select("pid", "dpid", "productname", "visible", "cat", "iorder")
    latest = F.col("latest_hcol")
    return (products_with_store(products, bands, stores).join(shown, "pid", "left").join(latest_items(items), "pid", "left")
            .withColumn("latest_label", date_label(F.col("latest_dt0"), latest, F.col("timeType"), language)))


def system_products(products: DataFrame) -> DataFrame:
    return products.where(F.col("userid") == SYSTEM_USER)


def product_by_name(products: DataFrame, name: str) -> DataFrame:
    """First product of that name; no row for an unknown one."""
    return products.where(F.col("name") == name).orderBy("pid").limit(1)


def product_by_id(products: DataFrame, pid: int) -> DataFrame:
    return products.where(F.col("pid") == pid)


def item_page(items: DataFrame, pid: int, page: int, size: int, ascending: bool = True) -> DataFrame:
    """Page of a product's items by date."""
    order = F.col("hcol").asc() if ascending else F.col("hcol").desc()
    return items.where(F.col("pid") == pid).orderBy(order, "fid").offset(page * size).limit(size)


def seek(table: DataFrame, order: Sequence[tuple[str, bool]], size: int, after: Sequence | None = None) -> DataFrame:
    """The next ``size`` rows behind the row whose order columns are ``after``; the first ones without it.

    ``order`` lists columns and whether they ascend; together they must name a row, and none may be null. What lies before is cut off by a
    filter that reaches the scan, so a late page costs no more than the first; ``offset`` sorts all rows before it too. Rows
    added meanwhile do not shift the pages.
    """
    if after is not None:
        ahead, same = F.lit(False), F.lit(True)
        for (name, ascending), value in zip(order, after, strict=True):
            ahead = ahead | (same & (F.col(name) > value if ascending else F.col(name) < value))
            same = same & (F.col(name) == value)
        (name, ascending), value = order[0], after[0]
        # the first column's bound alone is what sorted files are skipped by
        table = table.where(F.col(name) >= value if ascending else F.col(name) <= value).where(ahead)
    return table.orderBy(*(F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in order)).limit(size)


def item_page_after(items: DataFrame, pid: int, size: int, after: tuple[int, int] | None = None, ascending: bool = True) -> DataFrame:
    """Page of a product's items by date, behind the item of (hcol, fid)."""
    return seek(items.where(F.col("pid") == pid), [("hcol", ascending), ("fid", True)], size, after)


def item_list(items: DataFrame, products: DataFrame, size: int, after: tuple[int, int] | None = None, ascending: bool = True,
              language: str = "zh", **product) -> DataFrame:
    """A page of one product's items (``pid=`` or ``name=``) with the text shown for each date: (fid, hcol, label)."""
    (column, value), = product.items()
    mine = with_product_info(products.where(F.col(column) == value)).select("pid", "timeType")
    page = seek(items.join(F.broadcast(mine), "pid"), [("hcol", ascending), ("fid", True)], size, after)  # a product is one row
    return page.select("fid", "hcol", date_label(F.col("dt0"), F.col("hcol"), F.col("timeType"), language).alias("label"))


# ---- displays and categories ---------------------------------------------------------------------

def filled_displays(displays: DataFrame, today: Column) -> DataFrame:
    """Display rows with date placeholders filled in; layers of type ``xyz`` only."""
    out = displays
    for c in ("productname", "params"):
        out = out.withColumn(c, F.when(F.col("type") == "xyz", fill_template(F.col(c), today)).otherwise(F.col(c)))
    return out


def visible_displays(displays: DataFrame, category: int | None = None) -> DataFrame:
    shown = displays.where(F.col("visible") == VISIBLE)
    if category is not None:
        shown = shown.where(F.col("cat") == category)
    return shown.select("dpid", "cat", "iorder").orderBy("iorder", "dpid")


def search_displays(displays: DataFrame, word: str, limit: int | None = None) -> DataFrame:
    """Displays whose name, subtitle, satellite or sensor holds the word; all of them unless a limit is asked for."""
    texts = [F.col(c) for c in ("productname", "subtitle", "satellite", "sensor")]
    found = displays.where(contains_any(texts, word)).select("dpid").orderBy("dpid")
    return found if limit is None else found.limit(limit)


GRAM = 3


def _grams(text: Column) -> Column:
    low = F.lower(text)
    return F.when(F.length(low) >= GRAM, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - GRAM + 1), lambda i: F.substring(low, i, F.lit(GRAM)))))


# Bytes of text whose pieces one task holds at once.
INDEX_BYTES = 1024 * 1024


def text_index(table: DataFrame, ident: str, columns: Sequence[str]) -> DataFrame:
    """(gram, ident): the rows that hold each piece of three characters in one of the columns, in lower case.

    To be written sorted by gram (``write_text_index``), so that a search reads few of its row groups. The texts move, about
    ``INDEX_BYTES`` to a task, and their pieces do not: they are told apart where they arise, all of one ident in one task.
    """
    held = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in columns), F.lit(0).cast("long"))
    size = table.agg(F.sum(held)).first()[0] or 0
    texts = table.select(*dict.fromkeys((ident, *columns))).repartition(size // INDEX_BYTES + 1, ident)
    return texts.select(ident, F.explode(F.array(*(_grams(F.col(c)) for c in columns))).alias("g")).select(F.explode("g").alias("gram"), ident).distinct()


def write_text_index(index: DataFrame, path: str) -> None:
    """The index in ranges of gram and ident, so that a gram of very many rows is several tasks' work; as many ranges as it has partitions."""
    parts = max(index.rdd.getNumPartitions(), index.sparkSession.sparkContext.defaultParallelism)
    index.repartitionByRange(parts, *index.columns).sortWithinPartitions(*index.columns).write.mode("overwrite").parquet(path)


def search_indexed(table: DataFrame, index: DataFrame, ident: str, columns: Sequence[str], word: str) -> DataFrame:
    """Rows of ``table`` that hold the word in one of the columns, as ``contains_any`` finds them, by way of the index.

    Candidates are the rows of the word's rarest piece (the driver sees one count a piece of the word); they are then tested as a whole.
    A word of fewer than three characters has no piece: it is looked for in all rows.
    """
    texts, low = [F.col(c) for c in columns], word.lower()
    pieces = {low[i:i + GRAM] for i in range(len(low) - GRAM + 1)}
    if not pieces:
        return table.where(contains_any(texts, word))
    counts = {g: n for g, n in index.where(F.col("gram").isin(*pieces)).groupBy("gram").count().collect()}
    rarest = min(pieces, key=lambda g: (counts.get(g, 0), g))
    return table.join(index.where(F.col("gram") == rarest).select(ident), ident, "left_semi").where(contains_any(texts, word))


def categories(table: DataFrame, itype: int | None = None, visible: bool | None = None,
               limit: int | None = None) -> DataFrame:
    """Categories in their order; all of them unless a limit is asked for."""
    out = table
    if itype is not None:
        out = out.where(F.col("itype") == itype)
    if visible is not None:
        out = out.where(F.col("visible") == int(visible))
    out = out.orderBy("iorder", "catid")
    return out if limit is None else out.limit(limit)


def category_tree(table: DataFrame, displays: DataFrame) -> DataFrame:
    """The tree as rows: level 1 (itype), level 2 (category), product, each with its order.

    One row per leaf keeps a category with very many products from becoming one value. Categories
    without products stay with a null product.
    """
    level2 = table.where(F.col("visible") == VISIBLE).select("itype", "catid", "catname", F.col("iorder").alias("cat_order"))
    leaves = displays.where(F.col("visible") == VISIBLE).select(F.col("cat").alias("catid"), "dpid", "pid", "iorder")
    return level2.join(leaves, "catid", "left").orderBy("itype", "cat_order", "catid", "iorder", "dpid")


def metadata(table: DataFrame, key: str | None = None, theid: int | None = None) -> DataFrame:
    """Key/value rows by key, by id, or both, in value order."""
    out = table
    if key is not None:
        out = out.where(F.col("metakey") == key)
    if theid is not None:
        out = out.where(F.col("theid") == theid)
    return out.orderBy("metavali", "pk")


def layers(table: DataFrame, word: str = "") -> DataFrame:
    """Static map layers in order, all or by name."""
    found = table.where(contains_any([F.col("productname")], word)) if word else table
    return found.orderBy("iorder", "smid")


# ---- areas and regions ---------------------------------------------------------------------------

def with_children_flag(areas: DataFrame) -> DataFrame:
    """Whether an area has areas below it."""
    parents = areas.select(F.col("parent_code").alias("code")).distinct().withColumn("_p", F.lit(True))
    return areas.join(parents, "code", "left").withColumn("has_children", F.coalesce("_p", F.lit(False))).drop("_p")


def areas_below(areas: DataFrame, parent: str) -> DataFrame:
    """Direct children of a parent code, with the flag."""
    return with_children_flag(areas).where(F.col("parent_code") == parent).orderBy("id")


def leaf_areas(areas: DataFrame) -> DataFrame:
    parents = areas.select(F.col("parent_code").alias("code")).distinct()
    return areas.join(parents, "code", "left_anti")


def region_info(areas: DataFrame, user_regions: DataFrame, kind: str | None = None) -> DataFrame:
    """Areas and user regions in one shape (rtype, rid, name, path); ``user_regions`` has rid, name, path."""
    a = areas.select(F.lit("area").alias("rtype"), F.col("id").alias("rid"), "name", "path")
    u = user_regions.select(F.lit("user").alias("rtype"), "rid", "name", "path")
    both = a.unionByName(u)
    return both if kind is None else both.where(F.col("rtype") == kind)


def search_regions(regions: DataFrame, word: str, limit: int) -> DataFrame:
    """Regions by name; ``regions`` has rid and name."""
    return regions.where(contains_any([F.col("name")], word)).orderBy("rid").limit(limit)


def region_page(regions: DataFrame, category: int, page: int, size: int = ROI_PAGE) -> DataFrame:
    return regions.where(F.col("rcid") == category).orderBy("rid").offset(page * size).limit(size)


def count_by(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# ---- tasks, scripts, files -----------------------------------------------------------------------

def task_page(tasks: DataFrame, uid: int, page: int, size: int) -> DataFrame:
    """A user's tasks, newest first."""
    return tasks.where(F.col("uid") == uid).orderBy(F.col("ofid").desc()).offset(page * size).limit(size)


def newest(table: DataFrame, time: str, ident: str, limit: int, **equal) -> DataFrame:
    """Newest rows with the given column values: scripts, files, styles."""
    out = table
    for c, v in equal.items():
        out = out.where(F.col(c) == v)
    return out.orderBy(F.col(time).desc(), F.col(ident).desc()).limit(limit)


def preload_lists(users: DataFrame, preloads: DataFrame) -> DataFrame:
    """Newest preload list of each user, else the newest of user 0. ``users`` has uid."""
    own = preloads.groupBy("uid").agg(F.max("premapid").alias("own_id"))
    default = preloads.where(F.col("uid") == 0).agg(F.max("premapid").alias("def_id"))
    # the default is exactly one row, so this cross join is a broadcast of a constant
    chosen = users.join(own, "uid", "left").crossJoin(F.broadcast(default)).select(
        "uid", F.coalesce("own_id", "def_id").alias("premapid"))
    return chosen.join(preloads.select("premapid", "preloadlist"), "premapid", "left")


def scripts_as_products(scripts: DataFrame) -> DataFrame:
    """User scripts (sid, title, utime, uid) in the shape of a product with its display."""
    # Values a script is listed with (fixed values).
    return scripts.select(
        F.concat(F.lit("us"), F.col("sid").cast("string")).alias("displayid"), F.col("sid").alias("pid"),
        F.lit("").alias("name"), F.col("uid").alias("userid"), F.lit("").alias("proj"), F.lit(0).alias("minZoom"),
        F.lit(12).alias("maxZoom"), F.lit(0).alias("dataType"), F.lit(0).alias("timeType"), F.lit(256).alias("tileWid"),
        F.lit(256).alias("tileHei"), F.lit(0).alias("styleid"), F.col("title").alias("productname"),
        F.col("utime").alias("subtitle"), F.concat(F.lit('{"sid":'), F.col("sid").cast("string"), F.lit("}")).alias("params"),
        F.lit("us").alias("type"))


# ---- inputs of a job -----------------------------------------------------------------------------

def lineage_rows(table: DataFrame, ident: str, text: str) -> DataFrame:
    """Rows (ident, dsname, dt) of lineage texts; a malformed text gives no rows at all."""
    return table.select(ident, F.explode(lineage_pairs(F.col(text))).alias("p")).select(ident, "p.dsname", "p.dt")


def task_by_id(tasks: DataFrame, ident: int) -> DataFrame:
    """One task; no row for an unknown one."""
    return tasks.where(F.col("ofid") == ident)


def region_names(table: DataFrame, ident: str, text: str) -> DataFrame:
    return table.select(ident, F.explode(non_empty_parts(F.col(text))).alias("roi_id"))


def common_inputs(inputs: DataFrame, products: DataFrame, ident: str) -> DataFrame:
    """Per job: how many of its datasets are unknown, whether the known ones share a projection, their lowest max zoom, first style.

    ``inputs`` has ident, dsname and ord (the order in which the datasets are named). Extremes replace
    a distinct count, so the aggregate combines before its shuffle.
    """
    known = with_product_info(products).select(F.col("name").alias("dsname"), "proj", "maxZoom", "styleid")
    known = hinted(known, fits_broadcast(known))  # a popular dataset is one key of many inputs
    used = F.col("styleid") > 0
    return inputs.join(known, "dsname", "left").groupBy(ident).agg(
        F.count_if(F.col("proj").isNull()).alias("unknown"),
        F.coalesce(F.min("proj") == F.max("proj"), F.lit(False)).alias("same_proj"),
        F.min("maxZoom").alias("max_zoom"),
        F.coalesce(F.min_by(F.when(used, F.col("styleid")), F.when(used, F.col("ord"))), F.lit(0)).alias("styleid"))
