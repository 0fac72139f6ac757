"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators.sides import fits_broadcast
from tilewright.session import shared_folder

# White space that separates words, as the inside of a character class.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept in the folder of ``spark.checkpoint.dir``, so that lost executors cost no recomputation.

    The folder is taken from the session; a temporary one serves only where none is set and the master is local.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession, "cuts"))
    return df.checkpoint()


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that ``cut`` made and that nothing reads any more. A failed job skips this, so its files stay."""
    for df in frames:
        spark = df.sparkSession
        kept = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if kept.isDefined():
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept.get())
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels must not be learned; a null id is not held out, and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) for training: one row an id, the larger label where rows disagree; null labels and held-out ids left out."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))


def small(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint if its measured size is under 64 MB (``fits_broadcast``); else the join shuffles both sides."""
    return F.broadcast(df) if fits_broadcast(df) else df


def small_batches(spark: SparkSession) -> None:
    """Texts are large rows: unless the session says otherwise, hand Python BATCH_ROWS of them at a time, not ten thousand.

    Both sides of the pipe hold a batch in memory beside the heap, for each core of an executor.
    """
    key, usual = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, usual) == usual:
        spark.conf.set(key, str(BATCH_ROWS))


def per_row(df: DataFrame, fn: Callable, schema: str, columns: list[str]) -> DataFrame:
    """Apply ``fn(*values) -> iterable of tuples`` to each row of ``columns`` in Arrow batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # small slices, so that texts of one batch are not all Python objects at once
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows = [r for values in zip(*(part.column(c).to_pylist() for c in columns)) for r in fn(*values)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        pa.default_memory_pool().release_unused()

    small_batches(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names, types = arrow.names, arrow.types
    return df.select(*columns).mapInArrow(run, schema)
