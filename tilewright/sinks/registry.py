"""Catalog rows for computed products: bands, dated item and product description."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Values every computed product is registered with (fixed values).
TILE_SIDE, COMPRESS, SOURCE = 256, "deflate", "hbase"


def output_bands(products: DataFrame, fill: float) -> DataFrame:
    """One band row per output band; ``products`` has pid, hpid and nbands."""
    bands = products.withColumn("bindex", F.explode(F.sequence(F.lit(0), F.col("nbands") - 1)))
    info = F.to_json(F.struct(
        F.col("hpid").alias("hPid"), F.col("bindex").alias("bsqIndex"),
        F.concat(F.lit("B"), (F.col("bindex") + 1).cast("string")).alias("bName"),
        F.lit(1).alias("scale"), F.lit(0).alias("offset"), F.lit(0.0).alias("validMin"), F.lit(255.0).alias("validMax"),
        F.lit(float(fill)).alias("noData")))
    return bands.where("nbands > 0").select("pid", "bindex", info.alias("info"))


def output_item(products: DataFrame) -> DataFrame:
    """One dated item per product; ``products`` has pid, hcol, left, right, top and bottom."""
    return products.select("pid", "hcol", F.col("hcol").alias("dt0"), (F.col("hcol") + 1).alias("dt1"),
                           "left", "right", "top", "bottom")


def output_product(products: DataFrame) -> DataFrame:
    """Product rows; ``products`` has pid, name, userid, proj, maxzoom, data_type, table and styleid."""
    info = F.to_json(F.struct(
        "proj", F.lit(0).alias("minZoom"), F.col("maxzoom").alias("maxZoom"),
        F.col("data_type").alias("dataType"), F.lit(0).alias("timeType"), F.col("table").alias("hTableName"),
        F.lit(TILE_SIDE).alias("tileWid"), F.lit(TILE_SIDE).alias("tileHei"), F.lit(COMPRESS).alias("compress"), "styleid"))
    return products.select("pid", "name", "userid", F.lit(SOURCE).alias("source"), info.alias("info"))


def replace_rows(snapshot: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """A catalog snapshot with new rows in place of those sharing their key."""
    kept = snapshot.join(rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)
