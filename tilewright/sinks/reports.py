"""Result documents and tables of the statistics jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Column order and names of the result table, and field names of the result document (fixed values).
CSV_COLUMNS = {"areakm2": "area_km2", "acnt": "all_cnt", "fcnt": "fill_cnt", "vcnt": "valid_cnt", "vmin": "valid_min",
               "vmax": "valid_max", "sum": "sum", "sqsum": "sq_sum", "mean": "mean", "stddev": "stddev"}
JSON_FIELDS = {"sum": "sum", "sq_sum": "sq_sum", "validCnt": "valid_cnt", "validMin": "valid_min", "validMax": "valid_max",
               "areakm2": "area_km2", "allCnt": "all_cnt", "fillCnt": "fill_cnt"}


def bands_side_by_side(stats: DataFrame, n_bands: int, keys: Sequence[str] = ("key",)) -> DataFrame:
    """One row per key and region, the statistics of every band next to each other and named by band."""
    known = F.col("band").between(0, n_bands - 1)
    stats = stats.withColumn("band", F.when(known, F.col("band")).otherwise(
        F.raise_error(F.concat(F.lit(f"a result has {n_bands} bands, so none is "), F.col("band").cast("string"))).cast("int")))
    values = [F.first(c).alias(n) for n, c in CSV_COLUMNS.items()]
    wide = stats.groupBy(*keys, "roi_id").pivot("band", list(range(n_bands))).agg(*values)
    named = [F.col(f"`{b}_{n}`").alias(f"{n}_b{b + 1}") for b in range(n_bands) for n in CSV_COLUMNS]
    return wide.select(*keys, "roi_id", *named)


def write_csv(stats: DataFrame, path: str, n_bands: int, keys: Sequence[str] = ("key",)) -> None:
    """Rows by key as text, then region; the header names every band."""
    bands_side_by_side(stats, n_bands, keys).orderBy(*keys, "roi_id").write.mode("overwrite").option("header", True).csv(path)


def result_json(stats: DataFrame, key: str = "key", message: str = "success") -> DataFrame:
    """One document per region: state, data by ascending text key with one entry per band, message.

    The entries of a document are the keys of one region, at most one per date.
    """
    one_band = F.struct("band", F.struct(*[F.col(c).cast("double").alias(n) for n, c in JSON_FIELDS.items()]).alias("s"))
    per_key = stats.groupBy("roi_id", key).agg(F.array_sort(F.collect_list(one_band)).alias("b")).select(
        "roi_id", F.struct(F.col(key).alias("key"), F.transform("b", lambda b: b["s"]).alias("data")).alias("entry"))
    documents = per_key.groupBy("roi_id").agg(F.array_sort(F.collect_list("entry")).alias("data"))
    return documents.select("roi_id", F.to_json(F.struct(
        F.lit(0).alias("state"), "data", F.lit(message).alias("message"))).alias("document"))


def write_json(stats: DataFrame, path: str, key: str = "key") -> None:
    """One line per region's document."""
    result_json(stats, key).select("document").write.mode("overwrite").text(path)


def tile_job_json(product: DataFrame, message: str = "success") -> DataFrame:
    """Result document of a tile job per product id."""
    return product.select(F.to_json(F.struct(F.lit(0).alias("state"), F.col("pid").alias("mypid"),
                                             F.lit(message).alias("message"))).alias("document"))
