"""Store row keys: ``bucket(1) pid(1|4) z(1) y(2|4) x(2|4)``, big-endian."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUCKETS = 10


def bucket_of(y: Column, x: Column) -> Column:
    return ((x + y) % BUCKETS).cast("int")


def _bytes(value: Column, width: int) -> Column:
    low = value.cast("long").bitwiseAND(F.lit((1 << (8 * width)) - 1).cast("long"))
    return F.unhex(F.lpad(F.hex(low), 2 * width, "0"))


def encode_key(pid: Column, z: Column, y: Column, x: Column, pid_bytes: int, yx_bytes: int,
               bucket: Column | None = None) -> Column:
    """Row key as binary. Numbers wider than their field wrap, as in the store."""
    _check_widths(pid_bytes, yx_bytes)
    head = bucket_of(y, x) if bucket is None else bucket
    return F.concat(_bytes(head, 1), _bytes(pid, pid_bytes), _bytes(z, 1), _bytes(y, yx_bytes), _bytes(x, yx_bytes))


def decode_key(key: Column, pid_bytes: int, yx_bytes: int) -> Column:
    """Struct of bucket, pid, z, y, x (signed numbers); null when the length does not fit."""
    _check_widths(pid_bytes, yx_bytes)
    fields, at = [], 1
    for name, width in (("bucket", 1), ("pid", pid_bytes), ("z", 1), ("y", yx_bytes), ("x", yx_bytes)):
        raw = F.conv(F.hex(F.substring(key, at, width)), 16, 10).cast("long")
        half = 1 << (8 * width - 1)
        fields.append(F.when(raw >= half, raw - 2 * half).otherwise(raw).cast("int").alias(name))
        at += width
    return F.when(F.length(key) == at - 1, F.struct(*fields))


def _check_widths(pid_bytes: int, yx_bytes: int) -> None:
    if pid_bytes not in (1, 4) or yx_bytes not in (2, 4):
        raise ValueError("pid takes 1 or 4 bytes, y and x take 2 or 4")
