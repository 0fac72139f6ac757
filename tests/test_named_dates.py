"""Datasets by name over more dates than the fixtures have."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry
from checks.compare import rows_of
from test_tiles import scratch


def dates_folder(months):
    """Tables of one tile (1, 3) a month from January 2019 on, and one product."""
    path = scratch("dates")
    ids = [m * 128 + 19 for m in range(months)]
    vectors = pa.array([[0.01 * (k % 7) + 0.001 * i for i in range(64)] for k in ids], pa.list_(pa.float32()))
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": vectors}), f"{path}/embeddings.parquet")
    part = {"p_partkey": [1], "p_name": ["n"], "p_brand": ["b"], "p_type": ["t"], "p_size": [3], "p_retailprice": [1.0]}
    pq.write_table(pa.table(part), f"{path}/part.parquet")
    return path


def test_capped_query_keeps_more_than_two_dates(spark):
    path = dates_folder(30)
    con = duckdb.connect()
    for t in ("embeddings", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    got = entry.queries()["dataset_between_capped"](spark, path)
    want = con.execute(entry.oracle_sql()["dataset_between_capped"])
    rows = got.collect()
    assert rows_of(got.columns, rows) == rows_of([d[0] for d in want.description], want.fetchall())
    # February 2019 to December 2020 without the tile of bad status (12 * 128 + 19) and those of the range's ends
    good = {2019 * 10**10 + 10**8 * (1 + m) if m < 12 else 2020 * 10**10 + 10**8 * (m - 11) for m in range(1, 24) if (m * 128 + 19) % 37}
    assert {r.hcol for r in rows} == good and len(good) > 20
