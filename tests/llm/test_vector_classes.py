"""Near vectors where ids repeat, and lists of many blocks."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tilewright.llm import vectors as V


def test_rows_of_one_id_keep_their_own_links(spark):
    rng = np.random.default_rng(8)
    a, b, c = rng.normal(size=(3, 24))
    near = lambda x, s: (x + rng.normal(size=24) * s).tolist()
    rows = [(1, a.tolist(), 0), (1, b.tolist(), 0), (2, near(a, 0.01), 0), (3, near(b, 0.01), 0), (4, near(b, 0.01), 0), (5, c.tolist(), 0),
            (9, c.tolist(), 0), (9, near(c, 0.01), 0), (7, near(a, 0.01), 1)]
    got = V.near_vectors(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, unit string, id int, raw int"))
    assert Counter(map(tuple, got.collect())) == Counter(
        [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False), (5, 2, 5, True), (9, 2, 5, False), (9, 2, 5, False), (7, 0, 7, True)])


def test_lists_of_many_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 40)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(5, 16)).astype(np.float32)
    rows = [(k, (centres[min(k % 9, 4)] + rng.normal(size=16).astype(np.float32) * np.float32(0.04)).tolist(), 1) for k in range(700)]
    got = {r.vec_id: r.n_links for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    x = np.array([np.array(v, np.float32) for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = ((x @ x.T >= 0.98).sum(1) - 1).tolist()
    assert [got[k] for k in range(700)] == want and sum(want) > 10_000


def test_single_precision_is_kept_only_where_it_is_exact(spark):
    frame = spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.1, 2.0]), (3, [1e300, 1.0]), (4, [0.0, 0.0]), (5, None)], "vec_id long, embedding array<double>")
    rows = {r.vec_id: r for r in V._units(frame.withColumn("label", F.lit("a"))).collect()}
    assert [len(rows[k].raw) for k in (1, 2, 3)] == [8, 16, 16] and rows[4].raw is None and rows[5].unit is None
