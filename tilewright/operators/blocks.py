"""Binary pixel blocks: one row per (product, date, tile), band-sequential little-endian data.

Spark partitions, joins and shuffles the rows; numpy works inside a task on one block at a time.
Blocks travel whole, so a composite sends one row per tile instead of one per pixel and date.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tilewright.functions.grid import pixel_of_point
from tilewright.functions.pixels import BYTE_WIDTHS, PIXEL_TYPES, byte_width
from tilewright.operators.composite import check_method
from tilewright.operators.pixels import at_pixels, pixel_lists
from tilewright.operators.regions import Regions, cut_to_tiles
from tilewright.operators.sides import BROADCAST_BYTES, fits_broadcast, hinted

SHAPE = ("width", "height", "nbands", "data_type")
TILE = ("z", "y", "x")
# Type of ave and sum results: 32-bit float (fixed value).
FLOAT_TYPE = 6
# Columns of a computed tile after its address.
RESULT = "width int, height int, nbands int, data_type int, status int, log string, data binary"
# Pixels handed on in one Arrow batch, and bytes of partial composites a task holds before it sends them.
BATCH_PIXELS = 4_000_000
HELD_BYTES = 128 * 1024 * 1024
# Blocks of one tile beyond which a composite spreads them over several reducers first.
HEAVY_TILE = 4096


def _schema(fields: Sequence[T.StructField], added: str = "") -> T.StructType:
    """Given fields, nullable, followed by those of a DDL text."""
    kept = [T.StructField(f.name, f.dataType, True) for f in fields]
    return T.StructType(kept + (T.StructType.fromDDL(added).fields if added else []))


def pixels_of(buffer, data_type: int, nbands: int, height: int, width: int) -> np.ndarray:
    """Block bytes as an array [band, row, column]."""
    if data_type not in PIXEL_TYPES:
        raise ValueError(f"unknown pixel type {data_type}")
    expected = nbands * height * width * BYTE_WIDTHS[data_type]
    if len(buffer) != expected:
        raise ValueError(f"block has {len(buffer)} bytes, expected {expected}")
    return np.frombuffer(buffer, dtype=PIXEL_TYPES[data_type][0]).reshape(nbands, height, width)


def fill_value(fill: float, kind) -> float:
    """``fill`` if the pixel type can hold it; anything else would come out as some valid-looking pixel."""
    kind = np.dtype(kind)
    if kind.kind in "iu" and not (float(fill).is_integer() and np.iinfo(kind).min <= fill <= np.iinfo(kind).max):
        raise ValueError(f"fill value {fill} does not fit pixels of type {kind}")
    return fill


def _block_arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray | None]:
    """Pixels of each row's block; None for a failed tile, which has no data."""
    shape = [batch.column(n).to_pylist() for n in ("data_type", "nbands", "height", "width")]
    for data, (kind, nb, h, w) in zip(batch.column("data"), zip(*shape)):
        yield pixels_of(data.as_buffer(), kind, nb, h, w) if data.is_valid else None


def decode_blocks(blocks: DataFrame, kind: str = "long") -> DataFrame:
    """One row per tile and band with the pixels as ``dn array<kind>``."""
    rest = [f for f in blocks.schema.fields if f.name != "data"]
    schema = _schema(rest, f"band int, dn array<{kind}>")
    names = [f.name for f in rest]
    numpy_kind = {"short": "i2", "int": "i4", "long": "i8", "float": "f4", "double": "f8"}[kind]

    def decode(batches):
        for batch in batches:
            meta = batch.select(names)
            at, bands, lengths, parts = [], [], [0], []

            def flush():
                dn = pa.ListArray.from_arrays(np.cumsum(lengths, dtype="i4"), pa.array(np.concatenate(parts)))
                return pa.RecordBatch.from_arrays(
                    [*meta.take(pa.array(at)).columns, pa.array(bands, pa.int32()), dn], [*names, "band", "dn"])

            held = 0
            for i, block in enumerate(_block_arrays(batch)):
                for b in range(0 if block is None else block.shape[0]):
                    flat = block[b].reshape(-1).astype(numpy_kind)
                    at.append(i), bands.append(b), lengths.append(flat.size), parts.append(flat)
                    held += flat.size
                if held >= BATCH_PIXELS:
                    yield flush()
                    at, bands, lengths, parts, held = [], [], [0], [], 0
            if at:
                yield flush()

    return blocks.mapInArrow(decode, schema)


def encode_tiles(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Blocks from rows per tile and band (``band``, ``dn`` array, width, height, data_type).

    The bands of one tile are brought together; their number is the product's band count.
    """
    stacked = tiles.groupBy(*keys, "width", "height", "data_type").agg(
        F.array_sort(F.collect_list(F.struct("band", "dn"))).alias("_bands"))
    stacked = stacked.select("*", F.size("_bands").alias("nbands"),
                             F.flatten(F.transform("_bands", lambda b: b["dn"])).alias("_flat")).drop("_bands")
    rest = [f for f in stacked.schema.fields if f.name != "_flat"]
    names = [f.name for f in rest]

    def encode(batches):
        for batch in batches:
            flat = batch.column("_flat")
            data = [np.asarray(flat[i].values).astype(PIXEL_TYPES[kind][0]).tobytes()
                    for i, kind in enumerate(batch.column("data_type").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(data, pa.binary())], [*names, "data"])

    return stacked.mapInArrow(encode, _schema(rest, "data binary"))


def select_block_bands(blocks: DataFrame, bands: DataFrame, keys: Sequence[str], wanted: Sequence[int] = ()) -> DataFrame:
    """Blocks holding the chosen bands in the asked order (an empty list means all).

    ``bands`` has (pid, bindex, hpid, bsq_index): which store block and which slice of it holds a band.
    ``keys`` names the block columns to keep; they include pid and the tile address, not hpid.
    Tiles where any wanted band is missing are left out. Slices are cut on the JVM side.

    The band table says which blocks hold all wanted bands of their product; those are cut where they lie. Only products whose
    bands are spread over several blocks have their slices brought together by ``keys``, without an exchange where the tiles are
    bucketed by (z, y, x). One small job over the band table finds out whether there are any.
    """
    if wanted:
        places = F.posexplode(F.array(*[F.lit(b) for b in wanted])).alias("place", "_b")
        use = bands.select("*", places).where(F.col("bindex") == F.col("_b"))
    else:
        use = bands.withColumn("place", F.col("bindex"))
    need = use.groupBy("pid").agg(F.count(F.lit(1)).alias("need"))
    if wanted:
        need = need.where(F.col("need") == len(wanted))
    cuts = use.groupBy("pid", "hpid").agg(F.array_sort(F.collect_list(F.struct("place", "bsq_index"))).alias("cuts")).join(need, "pid")
    # a row a store block of the band table, which the catalog keeps; one job tells its size and what it asks for
    rows = cuts.collect()
    spread = any(len(r.cuts) < r.need for r in rows)
    cuts = blocks.sparkSession.createDataFrame(rows, cuts.schema)
    work = blocks.join(hinted(cuts, len(rows) * 64 + sum(len(r.cuts) for r in rows) * 16 <= BROADCAST_BYTES), ["pid", "hpid"])
    size = F.col("width") * F.col("height") * byte_width(F.col("data_type"))
    slices = F.transform("cuts", lambda c: F.struct(c["place"].alias("place"), F.substring(F.col("data"), c["bsq_index"] * size + 1, size).alias("slice")))
    joined = lambda s: F.aggregate(s, F.unhex(F.lit("")), lambda a, x: F.concat(a, x["slice"]))
    shape = lambda n, data: [*keys, "width", "height", n.cast("int").alias("nbands"), "data_type", data.alias("data")]
    alone = work.where(F.size("cuts") == F.col("need")).select(*shape(F.col("need"), joined(slices)))
    if not spread:
        return alone
    some = work.where(F.size("cuts") < F.col("need")).select(*keys, "width", "height", "data_type", "need", slices.alias("slices"))
    tiles = some.groupBy(*keys, "width", "height", "data_type").agg(F.array_sort(F.flatten(F.collect_list("slices"))).alias("s"), F.max("need").alias("need"))
    met = tiles.where(F.size("s") == F.col("need")).select(*shape(F.col("need"), joined(F.col("s"))))
    return met if all(len(r.cuts) < r.need for r in rows) else alone.unionByName(met)


# ---- regions -------------------------------------------------------------------------------------

REGIONS_PER_ROW = 64


def cuts_per_tile(cuts: DataFrame, small: bool, per_row: int = REGIONS_PER_ROW) -> DataFrame:
    """Runs gathered per region and the regions per tile: ``cuts array<(roi_id, runs)>``, broadcast if ``small``.

    A small set gives one array per tile. Otherwise the number of regions in a tile has no bound, and
    they are spread over as many rows as needed, about ``per_row`` regions to a row; one region
    has at most a tile's pixels in a tile.
    """
    runs = F.collect_list(F.struct("row", "c0", "c1", "pixel_km2")).alias("runs")
    per_region = cuts.groupBy(*TILE, "roi_id").agg(runs)
    gathered = F.collect_list(F.struct("roi_id", "runs")).alias("cuts")
    if small:
        return F.broadcast(per_region.groupBy(*TILE).agg(gathered))
    counts = cuts.groupBy(*TILE, "roi_id").agg(F.count(F.lit(1)).alias("_c")).groupBy(*TILE).agg(
        F.count(F.lit(1)).alias("_n"))
    part = F.pmod(F.xxhash64("roi_id"), F.ceil(F.col("_n") / per_row).cast("long"))
    return per_region.join(counts, list(TILE)).withColumn("part", part).groupBy(*TILE, "part").agg(gathered).drop("part")


def _flat_index(row, c0, c1, width):
    """Pixel positions of many runs, run by run, and the run each belongs to."""
    length = c1 - c0 + 1
    run = np.repeat(np.arange(length.size), length)
    first = np.cumsum(length) - length
    return (row * width + c0)[run] + np.arange(run.size) - first[run], run


def _run_reducer(begin, end):
    """Reduce an array over each [begin, end): pixels of a run lie side by side, so none is copied."""
    bounds = np.stack([begin, end], axis=1).reshape(-1)

    def reduce(ufunc, values):
        # one more element, because a run may end with the array; results at odd places are gaps
        return ufunc.reduceat(np.append(values, values[:1]), bounds)[::2]

    return reduce


def block_stats(blocks: DataFrame, regions: Regions, low: float, high: float, fill: float,
                keys: Sequence[str] = ()) -> DataFrame:
    """Per-tile zonal statistics straight from blocks; same rows as the pixel-row form.

    No pixel leaves its task: the join carries each block to its regions' runs and the shuffle after
    it carries eight numbers per tile, region and band.
    """
    keys = list(keys)
    return stats_of_cuts(blocks, cuts_per_tile(regions.cuts, regions.small), low, high, fill, keys)


def stats_of_cuts(blocks: DataFrame, cuts: DataFrame, low: float, high: float, fill: float, keys: Sequence[str] = ()) -> DataFrame:
    """Statistics of each tile, band and region of ``cuts`` (see ``cuts_per_tile``)."""
    store = ["hpid"] if "hpid" in blocks.columns and "hpid" not in keys else []
    work = blocks.join(cuts, list(TILE)).select(*keys, *TILE, *store, *SHAPE, "data", "cuts")
    schema = _schema([work.schema[k] for k in (*keys, *TILE, *store)],
                     "roi_id string, band int, sum double, sq_sum double, valid_cnt long, valid_min double, "
                     "valid_max double, area_km2 double, all_cnt long, fill_cnt long")
    names = [*keys, *TILE, *store]

    def stats(batches):
        for batch in batches:
            at, out = [], []
            cuts = batch.column("cuts")
            for i, block in enumerate(_block_arrays(batch)):
                if block is None:
                    continue
                tile_cuts = cuts[i].values
                ids, lists = tile_cuts.field("roi_id").to_pylist(), tile_cuts.field("runs")
                runs, lengths = lists.flatten(), np.asarray(lists.value_lengths())
                starts = np.cumsum(lengths) - lengths
                row, c0, c1, km2 = (np.asarray(runs.field(n)) for n in ("row", "c0", "c1", "pixel_km2"))
                over_runs = _run_reducer(row * block.shape[2] + c0, row * block.shape[2] + c1 + 1)
                counts = np.add.reduceat((c1 - c0 + 1).astype("i8"), starts)
                for band in range(block.shape[0]):
                    v = block[band].reshape(-1).astype("f8")
                    is_fill = np.isnan(v) if np.isnan(fill) else v == fill
                    ok = ~is_fill & (v >= low) & (v <= high)
                    valid = over_runs(np.add, ok.astype("i8"))
                    some = np.add.reduceat(valid, starts)
                    vv = np.where(ok, v, 0.0)
                    least = np.minimum.reduceat(over_runs(np.minimum, np.where(ok, v, np.inf)), starts)
                    most = np.maximum.reduceat(over_runs(np.maximum, np.where(ok, v, -np.inf)), starts)
                    out.append((ids, np.full(len(ids), band, "i4"), np.add.reduceat(over_runs(np.add, vv), starts),
                                np.add.reduceat(over_runs(np.add, vv * vv), starts), some, np.where(some > 0, least, 0.0),
                                np.where(some > 0, most, 0.0), np.add.reduceat(valid * km2, starts), counts,
                                np.add.reduceat(over_runs(np.add, is_fill.astype("i8")), starts)))
                    at.extend([i] * len(ids))
            if at:
                columns = [pa.array([r for o in out for r in o[0]], pa.string())]
                columns += [pa.array(np.concatenate([o[k] for o in out])) for k in range(1, 10)]
                yield pa.RecordBatch.from_arrays([*batch.select(names).take(pa.array(at)).columns, *columns],
                                                 [f.name for f in schema.fields])

    return work.mapInArrow(stats, schema)


def clip_blocks(blocks: DataFrame, run_segments: DataFrame, fill: float, width: int, height: int) -> DataFrame:
    """Fill every pixel outside the disjoint runs; blocks without any become all fill, failed ones stay."""
    cuts = cut_to_tiles(run_segments.select("z", "gy", "x0", "x1"), width, height)
    # a tile has at most its own pixels in disjoint runs
    per_tile = cuts.groupBy(*TILE).agg(F.collect_list(F.struct("row", "c0", "c1")).alias("_cuts"))
    work = blocks.join(per_tile, list(TILE), "left").select(*blocks.columns, "_cuts")
    names = blocks.columns

    def cut(batches):
        for batch in batches:
            runs, data = batch.column("_cuts"), []
            for i, block in enumerate(_block_arrays(batch)):
                if block is None:
                    data.append(None)
                    continue
                out = np.full(block.shape, fill_value(fill, block.dtype), dtype=block.dtype)
                if runs[i].is_valid:
                    r = runs[i].values
                    index, _ = _flat_index(*(np.asarray(r.field(n)) for n in ("row", "c0", "c1")), block.shape[2])
                    flat = block.reshape(block.shape[0], -1)
                    out.reshape(block.shape[0], -1)[:, index] = flat[:, index]
                data.append(out.tobytes())
            columns = [pa.array(data, pa.binary()) if n == "data" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return work.mapInArrow(cut, _schema(blocks.schema.fields))


def mask_blocks(blocks: DataFrame, mask: DataFrame, low: float, high: float, fill: float, keys: Sequence[str] = TILE) -> DataFrame:
    """Keep pixels where the mask block's pixel is valid, else fill; band by band, or the mask's one band for all.

    ``mask`` has one block a tile. Tiles without a mask block, and failed ones on either side, are dropped. Blocks stay binary.
    """
    keys, names = list(keys), blocks.columns
    other = mask.where("data IS NOT NULL").select(*keys, *[F.col(c).alias(f"_m_{c}") for c in (*SHAPE, "data")])
    work = blocks.where("data IS NOT NULL").join(other, keys).select(*names, *[f"_m_{c}" for c in (*SHAPE, "data")])

    def run(batches):
        for batch in batches:
            data = []
            masks = batch.select([f"_m_{c}" for c in (*SHAPE, "data")]).rename_columns([*SHAPE, "data"])
            for block, m in zip(_block_arrays(batch), _block_arrays(masks)):
                if m.shape[1:] != block.shape[1:] or m.shape[0] not in (1, block.shape[0]):
                    raise ValueError(f"a mask of {m.shape} does not fit a block of {block.shape}")
                v = m.astype("f8")
                ok = (v >= low) & (v <= high) & ~(np.isnan(v) if np.isnan(fill) else v == fill)
                data.append(np.where(ok, block, fill_value(fill, block.dtype)).astype(block.dtype).tobytes())
            columns = [pa.array(data, pa.binary()) if n == "data" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return work.mapInArrow(run, _schema(blocks.schema.fields))


def lookup_points_blocks(points: DataFrame, blocks: DataFrame, z: int, width: int, height: int, per_row: int = 4096) -> DataFrame:
    """(id, hcol, band, value) at lon/lat points (id, lon, lat), read from the blocks; points without a tile have no rows.

    A block is decoded once and gives the pixels that have a point, however many; the points of a pixel are gathered, at most
    ``per_row`` to a row, and meet its values there (``at_pixels``).
    """
    at = points.withColumn("_p", pixel_of_point(F.col("lon"), F.col("lat"), z, width, height)).where("_p.y IS NOT NULL").select(
        F.col("id").cast("long").alias("id"), F.col("_p.y").alias("y"), F.col("_p.x").alias("x"), (F.col("_p.row") * width + F.col("_p.col")).alias("at"))
    pixels = pixel_lists(at, ("y", "x", "at"), per_row)
    # a list is no longer than a tile has pixels, but for pixels with more than per_row points
    asked = F.collect_list(F.struct("at", F.col("_part").alias("part"))).alias("_at")
    wanted = hinted(pixels.groupBy(F.col("y").alias("_y"), F.col("x").alias("_x")).agg(asked), fits_broadcast(pixels))
    work = blocks.where((F.col("z") == z) & F.col("data").isNotNull()).join(
        wanted, (F.col("y") == F.col("_y")) & (F.col("x") == F.col("_x"))).select("_y", "_x", "hcol", *SHAPE, "data", "_at")

    def run(batches):
        for batch in batches:
            addresses, lists = zip(*(batch.column(c).to_pylist() for c in ("_y", "_x", "hcol"))), batch.column("_at")
            for i, (block, address) in enumerate(zip(_block_arrays(batch), addresses)):
                place, part = (np.asarray(lists[i].values.field(c)) for c in ("at", "part"))
                nbands, n = len(block), len(place)
                y, x, date = (np.full(nbands * n, v, k) for v, k in zip(address, ("i4", "i4", "i8")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (y, x, np.tile(place, nbands), np.tile(part, nbands), date, np.repeat(np.arange(nbands, dtype="i4"), n),
                                           block.reshape(nbands, -1)[:, place].reshape(-1).astype("f8"))],
                    ["y", "x", "at", "_part", "hcol", "band", "value"])

    values = work.mapInArrow(run, "y int, x int, at int, _part long, hcol long, band int, value double")
    return at_pixels(at, values, ("y", "x", "at"), ["id"], per_row).select("id", "hcol", "band", "value")


# ---- composite -----------------------------------------------------------------------------------

MIXED = "tiles of several store blocks (hpid) of one dataset: choose bands first"


class _Composite:
    """Running composite of one tile: value and number of valid dates of each pixel.

    ``pack`` writes it no wider than needed: the pixel type and one bit a pixel where that says all
    (min, max, or a single date), else sums and counts wide enough for the number of dates.
    """

    START = {"min": np.inf, "max": -np.inf, "ave": 0.0, "sum": 0.0}
    JOIN = {"min": np.minimum, "max": np.maximum, "ave": np.add, "sum": np.add}

    def __init__(self, method: str, low: float, high: float, fill: float, key: tuple):
        width, height, nbands, self.data_type = key[-4:]
        self.method, self.low, self.high, self.fill, self.dates = method, low, high, fill, 0
        self.value = np.full(width * height * nbands, self.START[method])
        self.count = np.zeros(self.value.size, "i4")

    @property
    def nbytes(self) -> int:
        return self.value.nbytes + self.count.nbytes

    def _add(self, value, count, dates):
        self.JOIN[self.method](self.value, value, out=self.value, where=count > 0)
        self.count += count
        self.dates += dates

    def add_block(self, block, date):
        v = block.reshape(-1).astype("f8")
        is_fill = np.isnan(v) if np.isnan(self.fill) else v == self.fill
        self._add(v, ~is_fill & (v >= self.low) & (v <= self.high), 1)

    def _layout(self, dates):
        """Types of packed values and counts; None for one bit a pixel."""
        if self.method in ("min", "max") or dates == 1:
            return PIXEL_TYPES[self.data_type][0], None
        exact_in_32_bits = self.data_type in (1, 2, 3) and dates < 32768
        return "<i4" if exact_in_32_bits else "<f8", "<u1" if dates < 256 else "<u2" if dates < 65536 else "<u4"

    def pack(self) -> tuple[int, bytes, bytes]:
        kind, count_kind = self._layout(self.dates)
        some = self.count > 0
        value = np.where(some, self.value, 0).astype(kind).tobytes()
        return self.dates, value, (np.packbits(some) if count_kind is None else self.count.astype(count_kind)).tobytes()

    def add_packed(self, dates, value, count):
        kind, count_kind = self._layout(dates)
        v = np.frombuffer(value, kind).astype("f8")
        c = np.frombuffer(count, "u1" if count_kind is None else count_kind)
        self._add(v, np.unpackbits(c, count=v.size) if count_kind is None else c.astype("i4"), dates)

    def finish(self, key: tuple) -> tuple:
        v = self.value / np.maximum(self.count, 1) if self.method == "ave" else self.value
        kind = self.data_type if self.method in ("min", "max") else FLOAT_TYPE
        data = np.where(self.count > 0, v, fill_value(self.fill, PIXEL_TYPES[kind][0])).astype(PIXEL_TYPES[kind][0]).tobytes()
        return (*key[:-1], kind, data)


PARTS = "salt int, store int, dates int, value binary, count binary"


def tile_parts(blocks: DataFrame, start: Callable, keys: Sequence[str], spread: int = 16, date: str | None = None) -> DataFrame:
    """Partial results of each tile, one for every task that holds some of its dates.

    ``start(key)`` makes a partial of a key (``keys`` and shape); it has ``add_block(pixels, date)``, ``pack()``, ``add_packed(...)``,
    ``finish(key)`` and ``nbytes``. A task hands its partials on when they hold more than HELD_BYTES. Failed tiles are left out.
    """
    ident = [*keys, *SHAPE]
    by_store = "hpid" in blocks.columns and "hpid" not in keys
    stamp = F.col(date).cast("long") if date else F.lit(None).cast("long")
    work = blocks.where("data IS NOT NULL").select(*ident, (F.col("hpid") if by_store else F.lit(None)).cast("int").alias("_store"), stamp.alias("_dt"), "data")
    schema = _schema([work.schema[n] for n in ident], PARTS)

    def combine(batches):
        context = TaskContext.get()
        salt = context.partitionId() % spread if context else 0
        held, stores, used = {}, {}, 0

        def packed():
            return _batch_of(schema, [(*key, salt, stores[key], *part.pack()) for key, part in held.items()])

        for batch in batches:
            ids = zip(*(batch.column(n).to_pylist() for n in ident))
            for key, store, dt, block in zip(ids, batch.column("_store").to_pylist(), batch.column("_dt").to_pylist(), _block_arrays(batch)):
                if stores.setdefault(key, store) != store:
                    raise ValueError(MIXED)
                if key not in held:
                    held[key] = start(key)
                    used += held[key].nbytes
                before = held[key].nbytes
                held[key].add_block(block, dt)
                used += held[key].nbytes - before  # a user's state may grow
                if used >= HELD_BYTES:
                    yield packed()
                    held, stores, used = {}, {}, 0
        if held:
            yield packed()

    return work.mapInArrow(combine, schema)


def merged_parts(parts: DataFrame, start: Callable, keys: Sequence[str], out: T.StructType | None, two_steps: bool = True) -> DataFrame:
    """Results of the partials of ``tile_parts``: brought together by tile, in two steps by salt first unless no tile has many.

    Without a schema of results there is one partial a tile, to be kept and merged with others later. Reducers read their partition
    sorted by tile and hold one tile at a time. The result is the same either way.
    """
    ident = [*keys, *SHAPE]

    def each_tile(batches):
        """(key, store block, partial) of every tile of a partition sorted by tile."""
        current, held, part = None, None, None
        for batch in batches:
            ids = zip(*(batch.column(n).to_pylist() for n in ident))
            stores, dates, values, counts = batch.column("store").to_pylist(), batch.column("dates").to_pylist(), batch.column("value"), batch.column("count")
            for i, key in enumerate(ids):
                if key != current:
                    if current is not None and key[:-4] == current[:-4] and key[-4:] != current[-4:]:
                        raise ValueError(f"blocks of one tile differ in size, bands or type: {current} and {key}")
                    if part is not None:
                        yield current, held, part
                    current, held, part = key, stores[i], start(key)
                if stores[i] != held:
                    raise ValueError(MIXED)
                part.add_packed(dates[i], values[i].as_buffer(), counts[i].as_buffer())
        if part is not None:
            yield current, held, part

    def in_batches(schema, row_of):
        def run(batches):
            rows, used = [], 0
            for key, held, part in each_tile(batches):
                rows.append(row_of(key, held, part))
                used += part.nbytes
                if used >= 8 * BATCH_PIXELS:
                    yield _batch_of(schema, rows)
                    rows, used = [], 0
            if rows:
                yield _batch_of(schema, rows)

        return run

    gather = in_batches(parts.schema, lambda key, held, part: (*key, 0, held, *part.pack()))
    if two_steps:
        parts = parts.repartition(*ident, "salt").sortWithinPartitions(*ident).mapInArrow(gather, parts.schema)
    # by tile, not shape, so that blocks of another shape meet and are seen
    met = parts.repartition(*keys).sortWithinPartitions(*ident)
    if out is None:
        return met.mapInArrow(gather, parts.schema)
    return met.mapInArrow(in_batches(out, lambda key, held, part: part.finish(key)), out)


def any_heavy(counts: DataFrame, keys: Sequence[str] = TILE, heavy: int = HEAVY_TILE) -> bool:
    """Whether some tile has more than ``heavy`` blocks, by the counts ``n`` that are kept beside a tile table (``tile_counts``)."""
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") > heavy).first() is not None


def composite_blocks(blocks: DataFrame, method: str, low: float, high: float, fill: float, keys: Sequence[str] = TILE, spread: int = 16,
                     two_steps: bool = True) -> DataFrame:
    """Composite of blocks over dates per ``keys`` (which include the tile address).

    Tasks first combine the dates of a tile they hold. Partials then come together in two steps, the first spread over ``spread``
    reducers a tile, so that a tile with a third of all dates is not sent to one task. ``two_steps=False`` saves the first
    exchange where no tile has many dates; ``any_heavy`` tells that from the counts kept beside a table, without reading tiles. The
    input is read once. Blocks of several store blocks (``hpid``) under one key are an error.
    """
    start = composite_start(method, low, high, fill)
    parts = tile_parts(blocks, start, keys, spread)
    return merged_parts(parts, start, keys, composite_schema(parts, keys), two_steps and spread > 1)


def composite_start(method: str, low: float, high: float, fill: float) -> Callable:
    """What ``tile_parts`` and ``merged_parts`` need for a composite by one of the named methods."""
    check_method(method)
    return lambda key: _Composite(method, low, high, fill, key)


def composite_schema(parts: DataFrame, keys: Sequence[str]) -> T.StructType:
    return _schema([parts.schema[n] for n in (*keys, *SHAPE)], "data binary")


def _batch_of(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    arrow = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], names=arrow.names)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# ---- classes -------------------------------------------------------------------------------------

def class_counts(blocks: DataFrame, ranges: Sequence[tuple[float, float]], low: float, high: float, fill: float, keys: Sequence[str] = ()) -> DataFrame:
    """(``keys``, band, class, n): how many valid pixels fall in each class, the first closed range that holds them; null in none.

    A task counts into one array of classes for each key and band it meets, so what is sent is a few numbers a key, never pixels.
    Classes without pixels have no row.
    """
    keys = list(keys)
    work = blocks.where("data IS NOT NULL").select(*keys, *SHAPE, "data")
    schema = _schema([work.schema[k] for k in keys], "band int, counts array<long>")

    def count(batches):
        held: dict[tuple, np.ndarray] = {}

        def rows():
            return _batch_of(schema, [(*key, c.tolist()) for key, c in held.items()])

        for batch in batches:
            heads = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            for head, block in zip(heads, _block_arrays(batch)):
                for band in range(block.shape[0]):
                    values, n = np.unique(block[band], return_counts=True)
                    v = values.astype("f8")
                    ok = ~(np.isnan(v) if np.isnan(fill) else v == fill) & (v >= low) & (v <= high)
                    of = np.full(v.size, len(ranges))
                    for i in reversed(range(len(ranges))):
                        of[(v >= ranges[i][0]) & (v <= ranges[i][1])] = i
                    counts = np.bincount(of[ok], n[ok], len(ranges) + 1).astype("i8")
                    key = (*head, band)
                    held[key] = held[key] + counts if key in held else counts
            if len(held) > 100_000:
                yield rows()
                held = {}
        if held:
            yield rows()

    each = work.mapInArrow(count, schema).select(*keys, "band", F.posexplode("counts").alias("class", "n"))
    total = each.groupBy(*keys, "band", "class").agg(F.sum("n").alias("n")).where("n > 0")
    return total.withColumn("class", F.when(F.col("class") < len(ranges), F.col("class")))


# ---- user functions ------------------------------------------------------------------------------

Inputs = dict[tuple[str, int], np.ndarray]
TileFunction = Callable[[dict, Inputs], np.ndarray]
StackFunction = Callable[[dict, Iterator[tuple[int, np.ndarray]]], np.ndarray]


def _type_of(array: np.ndarray) -> int:
    for code, (kind, _) in PIXEL_TYPES.items():
        if np.dtype(kind) == array.dtype:
            return code
    raise ValueError(f"no pixel type for {array.dtype}")


def _as_block(out: np.ndarray) -> np.ndarray:
    """A function may return one band as [row, col]."""
    out = np.ascontiguousarray(out)
    return out[None] if out.ndim == 2 else out


def map_tiles(blocks: DataFrame, fn: TileFunction, inputs: Sequence[tuple[str, int]], keys: Sequence[str] = TILE) -> DataFrame:
    """One result tile per address from the named inputs: ``fn(address, {(dsname, date): pixels}) -> pixels``.

    ``inputs`` lists the (dataset, date) pairs the function reads; pixels are [band, row, col]. A tile
    that lacks some of them is given those it has; one with several blocks for an input is an error. One input needs no shuffle, so there
    it is an error if a task meets two store blocks, and ``merge_cells`` refuses a cell given twice by different tasks. Several inputs
    bring the blocks of a tile together, at most one per input. A failing tile becomes a row with status 1 and the
    error text in ``log``; it does not stop the job.
    """
    keys = list(keys)
    one = F.struct("dsname", "hcol", *SHAPE, "data")
    named = F.lit(False)
    for dsname, date in inputs:
        named = named | ((F.col("dsname") == dsname) & (F.col("hcol") == date))
    chosen = blocks.where(named)
    store = F.col("hpid") if "hpid" in blocks.columns else F.lit(None)
    single = len(set(inputs)) == 1
    if single:
        work = chosen.select(*keys, F.array(one).alias("inputs"), store.cast("int").alias("_store"))
    else:
        work = chosen.groupBy(*keys).agg(F.collect_list(one).alias("inputs"))
        names = F.transform("inputs", lambda i: F.struct(i["dsname"], i["hcol"]))
        once = F.size(F.array_distinct(names)) == F.size(names)
        work = work.withColumn("inputs", F.when(once, F.col("inputs")).otherwise(F.raise_error(
            F.lit("a tile has several blocks of one dataset and date: choose bands first")).cast(work.schema["inputs"].dataType)))
    schema = _schema([work.schema[k] for k in keys], RESULT)

    def computed(head, given):
        try:
            shapes = zip(*(given.field(n).to_pylist() for n in ("dsname", "hcol", "data_type", "nbands", "height", "width")))
            tiles = {(ds, date): pixels_of(data.as_buffer(), kind, nb, h, w)
                     for (ds, date, kind, nb, h, w), data in zip(shapes, given.field("data"))}
            out = _as_block(fn(head, tiles))
            return out.shape[2], out.shape[1], out.shape[0], _type_of(out), 0, None, out.tobytes()
        except Exception as error:  # noqa: BLE001 - a bad tile is data, not a failed job
            return 0, 0, 0, 0, 1, f"{type(error).__name__}: {error}", None

    def run(batches):
        stores = set()
        for batch in batches:
            if single and len(stores := stores | set(batch.column("_store").to_pylist())) > 1:
                raise ValueError(MIXED)
            heads = [dict(zip(keys, r)) for r in zip(*(batch.column(k).to_pylist() for k in keys))]
            rows = [computed(head, given.values) for head, given in zip(heads, batch.column("inputs"))]
            if rows:
                tail = [pa.array(list(c)) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([*batch.select(keys).columns, *tail], schema.fieldNames()).cast(_arrow(schema))

    return work.mapInArrow(run, schema)


@dataclass(frozen=True)
class Fold:
    """A user function over dates in four parts, so that dates may be taken in any order and number.

    ``start(address)`` gives a state (any picklable value, arrays best), ``add(state, date, pixels)`` and ``merge(state, state)`` a
    state, ``finish(state)`` pixels [band, row, col]. Adding must not depend on the order of dates.
    """

    start: Callable[[dict], object]
    add: Callable[[object, int, np.ndarray], object]
    merge: Callable[[object, object], object]
    finish: Callable[[object], np.ndarray]


def _size(state) -> int:
    """About how many bytes a user's state holds."""
    if isinstance(state, np.ndarray):
        return state.nbytes
    if isinstance(state, dict):
        return sum(map(_size, state.values()))
    return sum(map(_size, state)) if isinstance(state, (tuple, list)) else sys.getsizeof(state)


class _Folded:
    """Running state of a user's fold; an error takes its place and fails the tile."""

    def __init__(self, fold: Fold, names: Sequence[str], key: tuple):
        self.fold, self.dates, self.error, self.state, self.empty = fold, 0, None, None, True
        self.begin = lambda: fold.start(dict(zip(names, key)))

    @property
    def nbytes(self) -> int:
        return _size(self.state)

    def _try(self, step, *given):
        if self.error is None:
            try:
                return step(*given)
            except Exception as error:  # noqa: BLE001 - a bad tile is data, not a failed job
                self.error = f"{type(error).__name__}: {error}"
        return None

    def add_block(self, block, date):
        if self.empty:
            self.state, self.empty = self._try(self.begin), False
        self.state = self._try(self.fold.add, self.state, date, block)
        self.dates += 1

    def pack(self):
        return self.dates, pickle.dumps((self.error, None if self.error else self.state), protocol=5), b""

    def add_packed(self, dates, value, count):
        error, state = pickle.loads(value)
        self.error, self.dates = self.error or error, self.dates + dates
        self.state, self.empty = state if self.empty else self._try(self.fold.merge, self.state, state), False

    def finish(self, key):
        out = self._try(lambda: _as_block(self.fold.finish(self.state)))
        row = self._try(lambda: (out.shape[2], out.shape[1], out.shape[0], _type_of(out), 0, None, out.tobytes()))
        return (*key[:-4], *(row or (0, 0, 0, 0, 1, self.error, None)))


def fold_blocks(blocks: DataFrame, fold: Fold, keys: Sequence[str], date: str = "hcol", spread: int = 16, two_steps: bool = True) -> DataFrame:
    """A user's ``Fold`` over all dates of each key: one result tile a key, failed ones with status 1 and the error text.

    Dates are added in the task that reads them and states merged in two steps (see ``composite_blocks``), so neither a hot tile nor a
    long list of dates is one task's work, whatever the function does with neighbouring pixels. ``apply_to_stack`` serves functions that
    need the dates in order.
    """
    keys = list(keys)
    start = lambda key: _Folded(fold, keys, key)
    out = _schema([blocks.schema[k] for k in keys], RESULT)
    return merged_parts(tile_parts(blocks, start, keys, spread, date), start, keys, out, two_steps and spread > 1)


def apply_to_stack(blocks: DataFrame, fn: StackFunction, keys: Sequence[str], strips: int = 1,
                   date: str = "hcol") -> DataFrame:
    """Apply a user function to all dates of a key: ``fn(address, dates) -> pixels[band, row, col]``.

    ``dates`` yields (date, pixels) in ascending order and is read as a stream, so a long stack is never
    held whole unless the function does so. With ``strips`` > 1 a tile's rows are split into
    that many groups, for functions that work pixel by pixel: a tile with most of the dates is then
    shared among tasks. The result has one row per key and strip; ``join_strips`` puts tiles together.
    """
    keys = list(keys)
    work = blocks.select(*keys, F.col(date).alias("_dt"), *SHAPE, "data")
    if strips > 1:
        work = _split_rows(work, strips)
    else:
        work = work.withColumn("strip", F.lit(0))
    group = [*keys, "strip"]
    # Same hash partitioning as the grouping and a finer sort: Spark adds neither again, and the
    # dates of a group arrive in order.
    work = work.repartition(*group).sortWithinPartitions(*group, "_dt")
    schema = _schema([work.schema[k] for k in group], RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        head = {k: first.column(k)[0].as_py() for k in group}

        def dates():
            batch = first
            while batch is not None:
                yield from zip(batch.column("_dt").to_pylist(), _block_arrays(batch))
                batch = next(batches, None)

        stack = dates()
        try:
            out = _as_block(fn(head, stack))
            row = (out.shape[2], out.shape[1], out.shape[0], _type_of(out), 0, None, out.tobytes())
        except Exception as error:  # noqa: BLE001 - a bad tile is data, not a failed job
            row = (0, 0, 0, 0, 1, f"{type(error).__name__}: {error}", None)
        for _ in stack:  # Spark expects the group to be read to its end
            pass
        columns = [pa.array([v]) for v in (*head.values(), *row)]
        yield pa.RecordBatch.from_arrays(columns, schema.fieldNames()).cast(_arrow(schema))

    return work.groupBy(*group).applyInArrow(run, schema)


def _split_rows(blocks: DataFrame, strips: int) -> DataFrame:
    """Each block as ``strips`` blocks of consecutive rows (fewer when the tile is lower)."""
    rest = [f for f in blocks.schema.fields if f.name not in ("height", "data")]
    schema = _schema(rest, "strip int, height int, data binary")
    names = [f.name for f in rest]

    def split(batches):
        for batch in batches:
            at, strip, height, data = [], [], [], []
            for i, block in enumerate(_block_arrays(batch)):
                if block is None:
                    continue
                for s, rows in enumerate(np.array_split(np.arange(block.shape[1]), strips)):
                    if rows.size:
                        at.append(i), strip.append(s), height.append(rows.size)
                        data.append(np.ascontiguousarray(block[:, rows[0]:rows[-1] + 1]).tobytes())
            if at:
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(names).take(pa.array(at)).columns, pa.array(strip, pa.int32()),
                     pa.array(height, pa.int32()), pa.array(data, pa.binary())], [*names, "strip", "height", "data"])

    return blocks.mapInArrow(split, schema)


def join_strips(stripped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole tiles from the strips of ``apply_to_stack``; a failed strip fails its tile."""
    keys = list(keys)
    gathered = stripped.groupBy(*keys).agg(
        F.max("status").alias("status"), F.max("log").alias("log"), F.max("width").alias("width"),
        F.sum("height").cast("int").alias("height"), F.max("nbands").alias("nbands"), F.max("data_type").alias("data_type"),
        F.array_sort(F.collect_list(F.struct("strip", "height", "data"))).alias("_s"))
    rest = [f for f in gathered.schema.fields if f.name != "_s"]
    names = [f.name for f in rest]

    def join(batches):
        for batch in batches:
            data = []
            for i, s in enumerate(batch.column("_s")):
                if batch.column("status")[i].as_py() != 0:
                    data.append(None)
                    continue
                kind, nb, w = (batch.column(n)[i].as_py() for n in ("data_type", "nbands", "width"))
                strips = [pixels_of(d.as_buffer(), kind, nb, h, w)
                          for h, d in zip(s.values.field("height").to_pylist(), s.values.field("data"))]
                data.append(np.concatenate(strips, axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(data, pa.binary())], [*names, "data"])

    return gathered.mapInArrow(join, _schema(rest, "data binary"))
