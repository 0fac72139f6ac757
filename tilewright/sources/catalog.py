"""Catalog tables: a Parquet snapshot or a JDBC connection, and the JSON columns inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fields of the JSON text in the catalog (fixed values).
PRODUCT_INFO = ("proj string, minZoom int, maxZoom int, dataType int, timeType int, hTableName string, "
                "tileWid int, tileHei int, compress string, styleid int")
BAND_INFO = ("hPid int, bsqIndex int, bName string, scale double, offset double, validMin double, validMax double, "
             "noData double")


def read_catalog_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a snapshot folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


def read_catalog_jdbc(spark: SparkSession, url: str, name: str, split_on: str | None = None, low: int = 0,
                      high: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """One table over JDBC; ``split_on`` reads it in ``parts`` ranges of a numeric column."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if split_on:
        reader = reader.options(partitionColumn=split_on, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def with_product_info(products: DataFrame) -> DataFrame:
    """Product rows with their JSON fields as columns."""
    return products.withColumn("_i", F.from_json("info", PRODUCT_INFO)).select(*products.columns, "_i.*").drop("info")


def with_band_info(bands: DataFrame) -> DataFrame:
    return bands.withColumn("_i", F.from_json("info", BAND_INFO)).select(*bands.columns, "_i.*").drop("info")
