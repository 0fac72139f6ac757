"""Series that grow: new tiles are folded into kept partial composites, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tilewright.operators.blocks import TILE, block_stats, composite_schema, composite_start, merged_parts, tile_parts
from tilewright.operators.pixels import good_tiles
from tilewright.operators.regions import Regions
from tilewright.operators.zonal import merge_stats

KEYED = ("key", *TILE)


class GrowingSeries:
    """Composites per key and tile that take in tiles as they come, kept under ``path``.

    A batch leaves one partial composite a tile it touched, in a folder of its own named by its number: a batch that is replayed replaces
    what it left, so nothing counts twice. ``compact`` puts the folders of all batches so far into one. ``key_of`` maps the date column to
    the key of its series; dates without one are left out, as are failed tiles. A tile must come in one batch only.
    """

    def __init__(self, spark: SparkSession, path: str, method: str, low: float, high: float, fill: float, key_of: Callable[[Column], Column]):
        self.spark, self.path, self.key_of = spark, path.rstrip("/"), key_of
        self.range, self.start = (low, high, fill), composite_start(method, low, high, fill)

    def _numbers(self, kind: str) -> list[int]:
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def fold(self, tiles: DataFrame, batch: int) -> None:
        """Take in the tiles of batch number ``batch`` (from 0)."""
        if batch <= max(self._numbers("base"), default=-1):
            return  # a replay of what has been compacted
        keyed = good_tiles(tiles).withColumn("key", self.key_of(F.col("hcol")).cast("string")).where("key IS NOT NULL")
        parts = merged_parts(tile_parts(keyed, self.start, KEYED), self.start, KEYED, None)
        parts.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def follow(self, tiles: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Fold every micro-batch of a stream of tiles; ``trigger`` as for ``DataStreamWriter.trigger``."""
        writer = tiles.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(**trigger) if trigger else writer).start()

    def _folders(self) -> list[str]:
        base = max(self._numbers("base"), default=-1)
        return [f"{self.path}/base={base}"] * (base >= 0) + [f"{self.path}/batch={b}" for b in self._numbers("batch") if b > base]

    def parts(self) -> DataFrame:
        """All partials that count: several a tile where several batches had dates of it."""
        folders = self._folders()
        if not folders:
            raise ValueError(f"no batch has been folded under {self.path!r}")
        return self.spark.read.parquet(*folders)

    def compact(self) -> None:
        """Merge the partials of all batches so far; a reader sees either the folders or what they became."""
        done, folders = self._numbers("batch"), self._folders()
        if len(folders) < 2:
            return
        merged_parts(self.parts(), self.start, KEYED, None, two_steps=False).write.mode("overwrite").parquet(f"{self.path}/base={done[-1]}")
        for folder in folders:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def composites(self) -> DataFrame:
        """The composite of each key and tile over all dates so far, as blocks."""
        parts = self.parts()
        return merged_parts(parts, self.start, KEYED, composite_schema(parts, KEYED), two_steps=False)

    def statistics(self, regions: Regions, merge: str = "reference") -> DataFrame:
        """Statistics per key, region and band over all dates so far: rows of ``series_stats_blocks``."""
        return merge_stats(block_stats(self.composites(), regions, *self.range, ("key",)), ("key",), merge)
