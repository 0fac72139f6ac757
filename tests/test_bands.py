"""Pixels with what the catalog knows of their band."""

import __spark_entry__ as entry
from checks.compare import duck, rows_of
from test_named_dates import dates_folder
from tilewright.operators import pixels as P


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pixels_do_not_move_to_meet_their_band(spark):
    """By band all pixels would come to as many tasks as there are bands, whatever Spark guesses of the sizes."""
    path = dates_folder(6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = entry.queries()["physical_values"](spark, path)
        assert "Exchange hashpartitioning" not in plan_of(got)
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    con = duck(entry.SMOKE_DIR)
    for t in ("embeddings", "part"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()["physical_values"])
    assert rows_of(got.columns, rows) == rows_of([d[0] for d in want.description], want.fetchall()) and rows


def test_too_many_bands_to_copy_join_the_tiles(spark, monkeypatch):
    tiles = spark.createDataFrame([(b, [0, 1] if b == 0 else [1, 2]) for b in (0, 1, 1, 5, None)], "band int, dn array<long>")
    bands = spark.createDataFrame([(0, 0.5), (1, 2.0), (1, 3.0), (None, 4.0)], "band int, scale double")
    want = [(0, [0, 1], 0.5)] + [(1, [1, 2], s) for s in (2.0, 2.0, 3.0, 3.0)]
    for fits in (True, False):
        monkeypatch.setattr(P, "fits_broadcast", lambda df, fits=fits: fits)
        assert sorted(map(tuple, P.with_bands(tiles, bands).collect())) == want
