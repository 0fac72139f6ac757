"""Tiles kept as files ``root/table/hpid/date/tile_z_y_x``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tilewright.functions.dates import has_parts

# Path layout (fixed value): hpid, date, then zoom, row and column in the file name.
TILE_PATH = r"/(\d+)/(\d+)/tile_(\d+)_(\d+)_(\d+)$"
_PARTS = (("hpid", "int"), ("hcol", "long"), ("z", "int"), ("y", "int"), ("x", "int"))


def date_folders(spark: SparkSession, root: str, table: str, hpid: int | None = None) -> DataFrame:
    """(hpid, hcol) of the date folders of a tree: one listing a store block, none of the folders themselves."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}/{'*' if hpid is None else hpid}/*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = [f.getPath().toString().rsplit("/", 2)[1:] for f in found or [] if f.isDirectory()]
    rows = [(int(h), int(d)) for h, d in folders if h.isdigit() and d.isdigit()]  # a few numbers a date the tree covers
    return spark.createDataFrame(rows, "hpid int, hcol long")


def read_tile_files(spark: SparkSession, root: str, table: str, hpid: int | None = None, hcol: int | Sequence[int] | None = None,
                    z: int | None = None, y: int | None = None, x: int | None = None) -> DataFrame:
    """Rows (hpid, hcol, z, y, x, data) of the matching files; none when nothing matches.

    Given parts become part of the path pattern, so only their folders are listed; file contents are
    read only where ``data`` is used. Spark lists many folders in a distributed job.
    """
    if hcol is not None and not isinstance(hcol, int) and not hcol:
        return _empty(spark)
    dates = "*" if hcol is None else _any_of([hcol] if isinstance(hcol, int) else hcol)
    return _read(spark, [f"{root.rstrip('/')}/{table}/{_any(hpid)}/{dates}"], f"tile_{_any(z)}_{_any(y)}_{_any(x)}")


def read_tile_files_in(spark: SparkSession, root: str, table: str, folders: DataFrame, **place: int) -> DataFrame:
    """Files of chosen ``folders`` (hpid, hcol), a selection of ``date_folders``. No other folder is opened."""
    dates: dict[int, list[int]] = {}
    for hpid, hcol in folders.select("hpid", "hcol").distinct().collect():  # no more than the tree has date folders
        dates.setdefault(hpid, []).append(hcol)
    if not dates:
        return _empty(spark)
    paths = [f"{root.rstrip('/')}/{table}/{hpid}/{_any_of(sorted(part))}" for hpid, d in sorted(dates.items()) for part in _parts_of(d)]
    return _read(spark, paths, "tile_" + "_".join(_any(place.get(k)) for k in ("z", "y", "x")))


def read_tile_files_between(spark: SparkSession, root: str, table: str, start: int, stop: int, hpid: int | None = None,
                            parts: dict[str, int] | None = None, **place: int) -> DataFrame:
    """Files of a date range with the given date parts (see ``has_parts``)."""
    folders = date_folders(spark, root, table, hpid).where(F.col("hcol").between(start, stop) & has_parts(F.col("hcol"), **(parts or {})))
    return read_tile_files_in(spark, root, table, folders, **place)


def read_tile_files_on(spark: SparkSession, root: str, table: str, candidates: DataFrame, hpid: int | None = None, **place: int) -> DataFrame:
    """Files whose date is among generated candidate dates (column ``dt``)."""
    folders = date_folders(spark, root, table, hpid).join(candidates.select(F.col("dt").alias("hcol")), "hcol", "left_semi")
    return read_tile_files_in(spark, root, table, folders, **place)


def _any(v: int | None) -> str:
    return "*" if v is None else str(v)


def _any_of(values: Sequence[int]) -> str:
    return "{" + ",".join(map(str, values)) + "}" if len(values) > 1 else str(values[0])


def _parts_of(dates: list[int], most: int = 200) -> Iterator[list[int]]:
    """Dates in groups, so that no path pattern gets very long."""
    yield from (dates[at:at + most] for at in range(0, len(dates), most))


def _read(spark: SparkSession, folders: list[str], file: str) -> DataFrame:
    try:
        files = spark.read.format("binaryFile").load([f"{folder}/{file}" for folder in folders])
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return _empty(spark)
        raise
    parts = [F.regexp_extract("path", TILE_PATH, i + 1).cast(kind).alias(name) for i, (name, kind) in enumerate(_PARTS)]
    return files.where(F.col("path").rlike(TILE_PATH)).select(*parts, F.col("content").alias("data"))


def with_shape(files: DataFrame, width: int, height: int, nbands: int, data_type: int) -> DataFrame:
    """Add the shape columns a block needs; files carry none, the catalog knows it."""
    return files.select("*", F.lit(width).alias("width"), F.lit(height).alias("height"), F.lit(nbands).alias("nbands"),
                        F.lit(data_type).alias("data_type"), F.lit(0).alias("status"))


def _empty(spark: SparkSession) -> DataFrame:
    schema = T.StructType.fromDDL("hpid int, hcol long, z int, y int, x int, data binary")
    return spark.createDataFrame([], schema)
