"""Quality of texts: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, labelled, per_row

_WORD = re.compile(r"\S+")
_CLASS = np.zeros((256, 6))
for _name, _k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (".,;:'\"-", 3), ("!?", 4), ("#*$%&|<>@^~=+_\\/[]{}", 5)):
    _CLASS[[ord(c) for c in _name], _k] = 1
STATISTICS = 17


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all are rates or logarithms and finite for any text."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    size = max(1, len(data))
    words = _WORD.findall(text)
    n = max(1, len(words))
    kinds = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = (counts[:, None] * _CLASS).sum(0) / size
    p = counts[counts > 0] / size
    lengths = Counter(map(len, words))
    mean = sum(k * c for k, c in lengths.items()) / n
    spread = math.sqrt(sum(c * (k - mean) ** 2 for k, c in lengths.items()) / n)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return [*share.tolist(), counts[128:].sum() / size, math.log1p(len(words)), mean, spread, len(kinds) / n,
            max(kinds.values(), default=0) / n, repeats / n, len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))),
            -float((p * np.log(p)).sum()), sum(c for w, c in kinds.items() if w[-1:] in "#*$%&!|") / n]


class Kernel:
    """Standardised statistics mapped to cosines whose inner products approximate a Gaussian kernel."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, width: float, size: int):
        rng = np.random.default_rng(7)
        self.mean, self.scale = mean, scale
        self.slope = rng.normal(size=(len(mean), size)) / width
        self.phase = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -5, 5)
        z = np.cos(x @ self.slope + self.phase) * math.sqrt(2 / len(self.phase))
        return np.hstack([np.ones((len(x), 1)), x / 10, z])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS)


def normal_equations(rows: DataFrame, kernel: Kernel, partitions: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over (stats, y): one partial sum of fixed size leaves each of ``partitions`` tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = cross = None
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                if part.num_rows:
                    z, y = kernel(_matrix(part.column("stats"))), part.column("y").to_numpy(zero_copy_only=False).astype(float)
                    square = z.T @ z if square is None else square + z.T @ z
                    cross = z.T @ y if cross is None else cross + z.T @ y
        if square is not None:
            yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()]), pa.array([cross.tobytes()])], names=["square", "cross"])

    parts = rows.select("stats", "y").repartition(partitions).mapInArrow(run, "square binary, cross binary").collect()
    cross = sum(np.frombuffer(c, float) for _, c in parts)
    return sum(np.frombuffer(s, float).reshape(len(cross), len(cross)) for s, _ in parts), cross


def isotonic(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (x, sum of y, weight): the knots of a rising curve through block means."""
    blocks: list[list[float]] = []
    for x, y, w in sorted(points):
        blocks.append([x * w, y, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _scored(rows: DataFrame, kernel: Kernel, weights: np.ndarray, curve=None) -> DataFrame:
    """Adds ``score``: the ridge value, or its place on the calibration curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                value = kernel(_matrix(part.column("stats"))) @ weights if part.num_rows else np.zeros(0)
                if curve is not None:
                    value = np.clip(np.interp(value, *curve), 0, 1)
                keep = [n for n in part.schema.names if n != "stats"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(value)], names=[*keep, "score"])

    kinds = [(c, t) for c, t in rows.dtypes if c != "stats"]
    return rows.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kinds) + ", score double")


def score_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", size: int = 300, ridge: float = 1e-3,
                  threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted for each row of (doc_id, text), from (doc_id, label) rows that are not held out.

    Statistics of every text are computed once and kept. Means, spreads and normal equations are sums over all labelled rows;
    a quarter of them, chosen by a hash, is left for the calibration, which sees counts by thousandths of the ridge value.

    Null and empty texts have the statistics of an empty text. Null labels and ids are not learned from; an id with both
    labels counts as 1; repeated rows are scored each. With no labels every score is ``threshold``, with labels of one kind
    that kind's share. An empty table gives no rows; other columns are ignored.
    """
    rows = cut(per_row(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), lambda i, t: [(i, statistics(t))],
                       "doc_id long, stats array<double>", ["doc_id", "text"]))
    calibrates = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)) == 0
    known = cut(rows.join(labelled(labels, label), "doc_id").withColumn("calibrates", calibrates))
    kinds = {(c, y): n for c, y, n in known.groupBy("calibrates", "y").count().collect()}
    if len({y for c, y in kinds if not c}) < 2:
        total = sum(kinds.values())
        score = F.lit(sum(n for (_, y), n in kinds.items() if y) / total if total else float(threshold))
        return rows.select("doc_id", score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
    fit = known.where("not calibrates")
    rest = known.where("calibrates") if len({y for c, y in kinds if c}) == 2 else known
    mean, spread = (np.array(fit.agg(*(f(F.col("stats")[k]) for k in range(STATISTICS))).first(), float) for f in (F.avg, F.stddev_pop))
    kernel = Kernel(mean, np.maximum(spread, 1e-6), math.sqrt(STATISTICS), size)
    square, cross = normal_equations(fit, kernel)
    n = square[0, 0]
    weights = np.linalg.solve(square + ridge * n * np.diag([0.0] + [1.0] * (len(cross) - 1)) / len(cross) + 1e-9 * n * np.eye(len(cross)), cross)
    bins = (_scored(rest.select("y", "stats"), kernel, weights).groupBy(F.round("score", 3).alias("x"))
            .agg(F.sum("y").alias("y"), F.count("*").alias("w")).collect())
    curve = isotonic([(x, float(y), float(w)) for x, y, w in bins])
    score = F.col("score")
    return _scored(rows, kernel, weights, curve).select("doc_id", "score", (score >= threshold).cast("int").alias("predicted"))
