"""Writing tile tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tilewright.functions.dates import MONTH, int_div
from tilewright.operators.sides import fits_broadcast, hinted
from tilewright.sources.tiles import CELL, newest

PARTITIONS = ("dsname", "z", "ym")
# Failed tiles of a job lie beside the table, under its path with this ending.
FAILED = "_failed"
# Numbers of blocks a tile and month, likewise.
COUNTS = "_counts"


# Tiles this many rows and columns apart are written together.
NEIGHBOURS = 16


def _laid_out(tiles: DataFrame) -> DataFrame:
    """Partition columns and order of the table.

    Tiles are gathered by month and neighbourhood, so files cover small areas and a scan of an area
    skips the others. The rebalance hint lets Spark split a neighbourhood that is too large for one task.
    """
    n = NEIGHBOURS
    placed = tiles.withColumn("ym", int_div(F.col("hcol"), MONTH)).withColumn("_ny", int_div(F.col("y"), n)).withColumn(
        "_nx", int_div(F.col("x"), n))
    return placed.hint("rebalance", *PARTITIONS, "_ny", "_nx").drop("_ny", "_nx").sortWithinPartitions(
        *PARTITIONS, "y", "x", "hcol")


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Replace the (dsname, z, month) partitions present in ``tiles``, leave all others.

    Whole partitions are staged and swapped at job commit, so a lost executor leaves the old data. Afterwards the number of blocks of each
    tile is counted anew for these partitions, from the written files' address columns, and kept under ``path`` + COUNTS. The write
    itself reports which partitions it touched, so ``tiles`` is computed once. Counts serve plans, never results.
    """
    seen = Observation()
    laid_out = _laid_out(tiles).observe(seen, F.collect_set(F.struct(*PARTITIONS)).alias("touched"))
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path)
    touched = seen.get["touched"]  # as many as partition folders
    if not touched:
        return
    months: dict[tuple, list] = {}
    for dsname, z, ym in touched:
        months.setdefault((dsname, z), []).append(ym)
    chosen = F.lit(False)
    for (dsname, z), ym in months.items():
        chosen = chosen | (F.col("dsname").eqNullSafe(dsname) & F.col("z").eqNullSafe(z) & F.col("ym").isin(ym))
    counts = tiles.sparkSession.read.parquet(path).where(chosen).groupBy(*PARTITIONS, "y", "x").agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(path.rstrip("/") + COUNTS)


def tile_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """(dsname, z, ym, y, x, n) of a tile table as kept by ``write_tiles``; None where a table has none."""
    kept = path.rstrip("/") + COUNTS
    return spark.read.parquet(kept) if exists(spark, kept) else None


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


@contextmanager
def staged(tiles: DataFrame, path: str, seen: Observation | None = None, *metrics: Column) -> Iterator[DataFrame]:
    """``tiles`` computed once, in a folder beside the table that goes again at the end.

    ``metrics`` are aggregates over the rows as they are written, given by ``seen``: no pass of their own. They are taken in the
    tasks that write, whose results count once however often a task is tried.
    """
    spark = tiles.sparkSession
    folder = f"{path.rstrip('/')}_staged-{uuid.uuid4().hex}"
    try:
        (tiles.observe(seen, *metrics) if seen is not None else tiles).write.parquet(folder)
        yield spark.read.schema(tiles.schema).parquet(folder)
    finally:
        system, at = _file_system(spark, folder)
        system.delete(at, True)


def upsert_tiles(tiles: DataFrame, path: str, keys: Sequence[str] = CELL, version: str | None = None) -> None:
    """Write cells into a table: an existing cell is replaced, all other cells stay. A missing table is made.

    Of several new rows for one cell the one of the largest ``version`` counts; without such a column they are an error.
    Only the partitions the new cells fall into are read and rewritten.
    """
    # the new cells are needed several times and may come from a costly function
    with staged(tiles.drop("ym"), path) as new:
        merge_cells(newest(new, keys, version) if version is not None else new, path, keys, checked=version is not None)


def merge_cells(new: DataFrame, path: str, keys: Sequence[str] = CELL, checked: bool = False) -> None:
    """The work of ``upsert_tiles`` for cells that are stored elsewhere; one that occurs twice is an error and changes nothing."""
    spark = new.sparkSession
    if not checked and (twice := new.groupBy(*keys).count().where("count > 1").first()) is not None:
        raise ValueError(f"several rows for the cell {twice.asDict()}")
    if not exists(spark, path):
        write_tiles(new, path)
        return
    touched = new.withColumn("ym", int_div(F.col("hcol"), MONTH)).select(*PARTITIONS).distinct()
    cells = new.select(*keys).distinct()
    old = spark.read.parquet(path).join(hinted(touched, fits_broadcast(touched)), list(PARTITIONS), "left_semi")
    kept = old.join(hinted(cells, fits_broadcast(cells)), list(keys), "left_anti").drop("ym")
    write_tiles(kept.unionByName(new.select(kept.columns)), path)


def write_bucketed(tiles: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """A tile table bucketed by tile address: joins per tile need no shuffle of the blocks."""
    writer = tiles.write.mode("overwrite").bucketBy(buckets, "z", "y", "x").sortBy("z", "y", "x").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
