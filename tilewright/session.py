"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Tile blocks are large rows: keep Arrow batches small enough for a Python worker.
TILE_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings tile jobs rely on to an existing session and send it this package."""
    for k, v in TILE_CONF.items():
        spark.conf.set(k, v)
    ship(spark, str(Path(__file__).resolve().parent))
    return spark


_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Send package folders to the Python workers, once per application.

    Functions over blocks run in workers, which do not see the driver's import path. Not needed
    where the package is installed on every executor.
    """
    for package in map(Path, packages):
        mark = (spark.sparkContext.applicationId, str(package))
        if mark in _shipped:
            continue
        archive = Path(tempfile.mkdtemp(prefix="tilewright-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(mark)


def local_session(name: str = "tilewright", cores: str | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    n = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{n}]").appName(name)
    for k, v in {
        "spark.sql.shuffle.partitions": n, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        # recording the call site of every column expression costs more than planning small queries
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset, as in tests, a temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tilewright-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
