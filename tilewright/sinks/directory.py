"""Tiles written as files ``root/table/hpid/date/tile_z_y_x``."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F


def write_tile_files(tiles: DataFrame, root: str, table: str) -> int:
    """One file a tile (hpid, hcol, z, y, x, data), replaced if it is there; failed tiles have none. Gives the number of files.

    Tasks write through Arrow's file systems (local, hdfs, s3, gs), under another name first, so that a task that is tried again or
    beside itself leaves whole files. Files are counted by their addresses.
    """
    base = f"{root.rstrip('/')}/{table}"

    def write(batches):
        system, top = fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(base))
        for batch in batches:
            address = list(zip(*(batch.column(c).to_pylist() for c in ("hpid", "hcol", "z", "y", "x"))))
            for (hpid, hcol, z, y, x), data in zip(address, batch.column("data")):
                folder = f"{top}/{hpid}/{hcol}"
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data.as_buffer())
                system.move(part, f"{folder}/tile_{z}_{y}_{x}")
            yield pa.RecordBatch.from_arrays([pa.array([len(address)], pa.int64())], names=["n"])

    rows = tiles.where("data IS NOT NULL").select("hpid", "hcol", "z", "y", "x", "data")
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
