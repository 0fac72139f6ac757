"""Fixture views derived from the given tables (see FIXTURES.md).

Text is the same in Spark and DuckDB unless a pair is given.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

_TILE = """SELECT 'mod/vi' AS dsname, 1 AS hpid, b.band, (2019 + cast(floor(di / 12) AS bigint)) * 10000000000 + (1 + di % 12) * 100000000 AS hcol,
 4 AS z, cast(floor(a / 16) AS bigint) AS y, a % 16 AS x, 8 AS width, 8 AS height, 3 AS data_type,
 CASE WHEN vec_id % 37 = 0 THEN 1 ELSE 0 END AS status,
 {dn} AS dn
FROM (SELECT vec_id, embedding, vec_id % 128 AS a, cast(floor(vec_id / 128) AS bigint) AS di FROM embeddings) v
CROSS JOIN (VALUES (0), (1)) AS b(band)"""
_PX = "SELECT dsname, band, hcol, z, y, x, status, pos, v AS dn, x * 8 + pos % 8 AS gx, y * 8 + cast(floor(pos / 8) AS bigint) AS gy FROM "

VIEWS: dict[str, str | tuple[str, str]] = {
    "fx_tile": (
        _TILE.format(dn="""transform(embedding, (e, i) -> CASE WHEN (i + vec_id) % 11 = 0 OR vec_id % 13 = 0 THEN -19999
   ELSE cast(floor(cast(e AS double) * 10000) AS bigint) + b.band * 100 END)"""),
        _TILE.format(dn="""list_transform(embedding, lambda e, i: CASE WHEN (i - 1 + vec_id) % 11 = 0 OR vec_id % 13 = 0 THEN -19999
   ELSE cast(floor(cast(e AS double) * 10000) AS bigint) + b.band * 100 END)"""),
    ),
    "fx_px": (
        _PX + "fx_tile LATERAL VIEW posexplode(dn) t AS pos, v",
        _PX + """(SELECT dsname, band, hcol, z, y, x, status, unnest(range(64)) AS pos, unnest(dn) AS v FROM fx_tile) t""",
    ),
    "fx_seg": """SELECT concat(CASE WHEN n_nationkey % 2 = 1 THEN 'user:' ELSE 'sys:' END, cast(n_nationkey AS varchar(10))) AS roi_id, 4 AS z,
 6 + (n_nationkey % 5) * 12 + o.off AS gy,
 greatest(0, 5 + n_nationkey * 5 - (6 - abs(o.off))) AS x0, least(127, 5 + n_nationkey * 5 + (6 - abs(o.off))) AS x1
FROM nation CROSS JOIN (VALUES (-6),(-5),(-4),(-3),(-2),(-1),(0),(1),(2),(3),(4),(5),(6)) AS o(off)
UNION ALL SELECT * FROM (VALUES ('sys:900', 4, 1, 105, 110), ('sys:901', 4, 2, 105, 108), ('sys:901', 4, 9, 81, 86)) AS e(roi_id, z, gy, x0, x1)""",
    "fx_wide": """SELECT concat('sys:', cast(800 + r_regionkey AS varchar(10))) AS roi_id, 4 AS z, 3 + r_regionkey * 7 + n_nationkey AS gy,
 10 + r_regionkey * 9 AS x0, 60 + r_regionkey * 9 + n_nationkey % 3 AS x1 FROM region CROSS JOIN nation""",
    "fx_tile_item": "SELECT DISTINCT 1 AS pid, hcol AS fid, hcol, hcol AS dt0, hcol + 1 AS dt1 FROM fx_tile",
    "fx_item": """SELECT pid, fid, hcol, hcol AS dt0, (year(d1) * 10000 + month(d1) * 100 + day(d1)) * cast(1000000 AS bigint) AS dt1
FROM (SELECT o_custkey % 50 AS pid, o_orderkey AS fid,
  (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) * cast(1000000 AS bigint) AS hcol,
  cast(o_orderdate AS date) + 1 AS d1 FROM orders) t""",
    "fx_probe": """SELECT l_orderkey, l_linenumber, l_partkey % 50 AS pid,
 (year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)) * cast(1000000 AS bigint) AS dt FROM lineitem""",
    "fx_obs": """SELECT event_id, user_id % 10 AS pid, event_type,
 (year(ts) * 10000 + month(ts) * 100 + day(ts)) * cast(1000000 AS bigint) + hour(ts) * 10000 + minute(ts) * 100 + cast(floor(second(ts)) AS bigint) AS dt,
 cast(floor(value * 100) AS bigint) AS dn FROM events""",
    "fx_point": """SELECT c_custkey AS id, ((c_custkey * 7919) % 5761) / cast(16 AS double) - cast(180 AS double) AS lon,
 cast(90 AS double) - ((c_custkey * 104729) % 2881) / cast(16 AS double) AS lat FROM customer
UNION ALL SELECT -1, cast(-180 AS double), cast(90 AS double) UNION ALL SELECT -2, cast(180 AS double), cast(-90 AS double)
UNION ALL SELECT -3, cast(181 AS double), cast(0 AS double)""",
    "fx_extent": """SELECT c_custkey AS id, c_nationkey AS grp, CASE WHEN c_custkey % 17 = 0 THEN '1,2,3' WHEN c_custkey % 19 = 0 THEN 'a,b,c,d'
 ELSE concat(cast(l AS varchar(10)), ',', cast(l + 150 + c_custkey % 15 AS varchar(10)), ',', cast(t AS varchar(10)), ',', cast(t - 70 - c_custkey % 11 AS varchar(10))) END AS ext
FROM (SELECT c_custkey, c_nationkey, -180 + (c_custkey * 37) % 190 AS l, 90 - (c_custkey * 53) % 90 AS t FROM customer) e""",
    "fx_product": """SELECT p_partkey AS pid, concat('ds/', cast(p_partkey AS varchar(10))) AS name, CASE WHEN p_partkey % 5 = 4 THEN 7 ELSE 0 END AS userid,
 CASE WHEN p_partkey % 2 = 0 THEN 'hbase' ELSE 'file' END AS source,
 concat('{"proj":"', CASE WHEN p_partkey % 9 = 0 THEN 'EPSG:3857' ELSE 'EPSG:4326' END, '","minZoom":0,"maxZoom":', cast(4 + p_size % 8 AS varchar(10)),
  ',"dataType":', cast(1 + p_size % 7 AS varchar(10)), ',"timeType":', cast(1 + p_partkey % 7 AS varchar(10)), ',"hTableName":"tab', cast(p_partkey % 4 AS varchar(10)),
  '","tileWid":256,"tileHei":256,"compress":"deflate","styleid":', cast(p_size % 3 AS varchar(10)), '}') AS info
FROM part""",
    "fx_band": """SELECT p.pid, b.bindex, concat('{"hPid":', cast(p.pid AS varchar(10)), ',"bsqIndex":', cast(b.bindex AS varchar(10)), ',"bName":"B', cast(b.bindex + 1 AS varchar(10)),
 '","scale":0.5,"offset":-10,"validMin":-2000,"validMax":3000,"noData":-19999}') AS info
FROM fx_product p CROSS JOIN (VALUES (0), (1), (2)) AS b(bindex) WHERE b.bindex <= p.pid % 3""",
    "fx_store": """SELECT * FROM (VALUES ('tab0', 'tiles', 1, 2), ('tab1', 'tiles', 4, 2), ('tab2', 'tiles', 4, 4)) AS t(htablename, hfamily, hpidbytenum, hyxbytenum)""",
    "fx_display": """SELECT p_partkey + 500 AS dpid, p_partkey AS pid, p_partkey % 5 AS cat, p_size AS iorder, CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS visible,
 CASE WHEN p_partkey % 4 = 0 THEN 'xyz' ELSE 'pe' END AS type, p_name AS productname, p_type AS subtitle, p_brand AS satellite,
 concat('S', cast(p_size AS varchar(10))) AS sensor, '{"u":"t/{{{DATE}}}/{{{DATE-0}}}/{{{DATE-1}}}/{{{DATE-2}}}/{{{DATE-3}}}/{{{DATE-4}}}/{{{DATE-5}}}/{{{DATE-6}}}/{{{DATE-7}}}"}' AS params FROM part""",
    "fx_category": """SELECT r_regionkey AS catid, r_name AS catname, CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS visible, 9 - r_regionkey AS iorder, 1 + r_regionkey % 2 AS itype FROM region""",
    "fx_meta": """SELECT s_suppkey AS pk, 500 + s_suppkey % 70 AS theid, CASE WHEN s_suppkey % 2 = 0 THEN 'PD_GOTS' ELSE 'CATLVL1' END AS metakey, 100000 - s_suppkey AS metavali, s_name AS metavalstr FROM supplier""",
    "fx_area": """SELECT r_regionkey + 1000000000 AS id, concat('R', cast(r_regionkey AS varchar(10))) AS code, r_name AS name, '0' AS parent_code FROM region
UNION ALL SELECT n_nationkey + 1000000100, concat('N', cast(n_nationkey AS varchar(10))), n_name, concat('R', cast(n_regionkey AS varchar(10))) FROM nation
UNION ALL SELECT s_suppkey, concat('S', cast(s_suppkey AS varchar(10))), s_name, concat('N', cast(s_nationkey AS varchar(10))) FROM supplier""",
    "fx_task": """SELECT o_orderkey AS ofid, 1 + o_orderkey % 5 AS mode, o_custkey AS uid, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS status, o_orderpriority AS tag FROM orders""",
    "fx_preload": """SELECT c_custkey AS premapid, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 20 END AS uid, c_mktsegment AS preloadlist FROM customer""",
    "fx_lineage": """SELECT o_orderkey AS id, concat('ds/', cast(o_custkey % 7 AS varchar(10)), ',', cast(hcol AS varchar(20)), ';;ds/', cast(o_custkey % 5 AS varchar(10)),
 CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat(',', cast(hcol + 1000000 AS varchar(20))) END, ';') AS pairs,
 concat('sys:', cast(o_custkey % 9 AS varchar(10)), ';;user:', cast(o_custkey % 4 AS varchar(10))) AS rois
FROM (SELECT o_orderkey, o_custkey, (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) * cast(1000000 AS bigint) AS hcol FROM orders) t""",
}


def _names_in(text: str) -> list[str]:
    known = "|".join([*VIEWS, *BASE])
    return list(dict.fromkeys(re.findall(rf"\b({known})\b", text)))


def _text(name: str, engine: int) -> str:
    v = VIEWS[name]
    return v if isinstance(v, str) else v[engine]


def needed_views(text: str, engine: int) -> list[str]:
    """Fixture views a text depends on, dependencies first."""
    order: list[str] = []

    def visit(body: str):
        for n in _names_in(body):
            if n in VIEWS and n not in order:
                visit(_text(n, engine))
                order.append(n)

    visit(text)
    return order


def duckdb_sql(query: str) -> str:
    """A self-contained statement: the needed fixture views as CTEs before the query."""
    ctes = ",\n".join(f"{n} AS ({_text(n, 1)})" for n in needed_views(query, 1))
    body = query.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Fixtures:
    """Fixture views over one data directory, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames = spark, sf_dir, {}

    def __getattr__(self, short: str) -> DataFrame:
        return self.table(f"fx_{short}" if f"fx_{short}" in VIEWS else short)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                for dep in _names_in(_text(name, 0)):
                    self.table(dep).createOrReplaceTempView(dep)
                self._frames[name] = self.spark.sql(_text(name, 0))
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]
