"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> int:
    """Rough width of a row as Spark itself estimates it, plus the row header."""
    return 16 + sum(_field_bytes(f.dataType) for f in df.schema.fields)


def _field_bytes(kind) -> int:
    fixed = {"tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "boolean": 8, "date": 8}
    return fixed.get(kind.simpleString(), 64)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Count the rows, stopping just past the limit, with the longest text of each string column. Only for flat rows."""
    most = limit // row_bytes(df)
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    rows, *longest = df.limit(most + 1).agg(F.count(F.lit(1)), *(F.max(F.octet_length(F.col(f"`{c}`"))) for c in texts)).first()
    return rows * (row_bytes(df) + sum(n or 0 for n in longest)) <= limit


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Without the hint the join falls back to a shuffle, which bucketed tile tables avoid too."""
    return F.broadcast(df) if small else df
