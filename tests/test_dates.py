"""Hand-made cases for date collections and nearest items."""

import pytest

from tilewright.functions.dates import CollectionSpec, Period
from tilewright.operators import collections as C, nearest as N


def items(spark, dates):
    return spark.createDataFrame([(1, i, d, d, d + 1) for i, d in enumerate(dates)],
                                 "pid int, fid long, hcol long, dt0 long, dt1 long")


def keyed(df):
    return sorted((r.key, r.hcol) for r in df.collect())


def test_monthly_cuts_both_ends_to_the_month_start(spark):
    src = items(spark, [20200100000000, 20200115000000, 20200215000000, 20200300000000, 20200310000000])
    every_day = Period(0, 31235959)
    # an exclusive start leaves the day-00 date out but still admits dated items of that month;
    # the stop falls on the month's start, so dated items of the last month are out
    spec = CollectionSpec(Period(20200110000000, 20200320000000, start_inclusive=False), "m", every_day)
    assert keyed(C.build_collections(src, spec)) == [
        ("202001", 20200115000000), ("202002", 20200215000000), ("202003", 20200300000000)]


def test_yearly_windows_overlap_and_empty_years_are_left_out(spark):
    src = items(spark, [20190700000000, 20200200000000, 20220200000000])
    spec = CollectionSpec(Period(20180000000000, 20220000000000), "y", Period(600000000, 800000000), stop_in_next_year=1)
    assert keyed(C.build_collections(src, spec)) == [
        ("2018", 20190700000000), ("2019", 20190700000000), ("2019", 20200200000000), ("2021", 20220200000000)]


def test_yearly_exclusive_ends_move_the_years(spark):
    src = items(spark, [20180500000000, 20190500000000, 20200500000000])
    spec = CollectionSpec(Period(20180000000000, 20200000000000, False, False), "y", Period(0, 1231235959))
    assert keyed(C.build_collections(src, spec)) == [("2019", 20190500000000)]


@pytest.mark.parametrize("kind", ["m", "y"])
def test_no_match_gives_no_rows(spark, kind):
    src = items(spark, [20200101000000])
    spec = CollectionSpec(Period(20100000000000, 20110000000000), kind, Period(0, 1231235959))
    assert C.build_collections(src, spec).count() == 0


def test_daily_repeat_is_rejected():
    with pytest.raises(ValueError):
        CollectionSpec(Period(0, 1), "d", Period(0, 1))


def test_dates_listed_twice_appear_once_with_their_number(spark):
    src = items(spark, [20200101000000, 20200101000000])
    rows = C.build_collections(src, CollectionSpec(Period(0, 99999999999999))).collect()
    assert [(r.key, r.n_items) for r in rows] == [("", 2)]


def test_times_of_a_day_share_a_key(spark):
    src = items(spark, [20200101060000, 20200101180000, 20200102000000])
    got = keyed(C.daily_series(src, Period(0, 99999999999999)))
    assert [k for k, _ in got] == ["20200101", "20200101", "20200102"]


def test_candidate_dates(spark):
    span = spark.createDataFrame([(20200215000000, 20210110000000)], "a long, b long")
    dts = [r.dt for r in C.candidate_dates(span, "a", "b", month=-1, day=31, hour=0, minute=0, second=0).orderBy("dt").collect()]
    # no calendar check: day 31 exists in every month
    assert dts[:2] == [20200231000000, 20200331000000] and dts[-1] == 20201231000000
    with pytest.raises(ValueError):
        C.candidate_dates(span, "a", "b", month=-1, day=-1, hour=0, minute=0, second=0)


def nearest(spark, dates, probe, after):
    src = items(spark, dates)
    keys = spark.createDataFrame([(1, p) for p in probe], "pid int, dt long")
    return {r.dt: (r.fid, r.dt0) for r in N.nearest_keys(keys, src, after=after).collect()}


def test_nearest_edges(spark):
    d = [20200110000000, 20200110000000, 20200520000000]
    before = nearest(spark, d, [20200109000000, 20200110000000, 20200401000000, 20210101000000], False)
    assert before == {20200109000000: (None, None), 20200110000000: (0, d[0]), 20200401000000: (0, d[0]), 20210101000000: (2, d[2])}
    after = nearest(spark, d, [20191231000000, 20200110000000, 20200520000000], True)
    assert after == {20191231000000: (0, d[0]), 20200110000000: (2, d[2]), 20200520000000: (None, None)}


def test_nearest_does_not_depend_on_slices(spark):
    d = [20200100000000 + i * 37_000_000 for i in range(40)]
    probes = [20191200000000 + i * 13_000_000 for i in range(300)]
    src = items(spark, d)
    keys = spark.createDataFrame([(1, p) for p in probes], "pid int, dt long")
    for after in (False, True):
        runs = [sorted((r.dt, -1 if r.fid is None else r.fid) for r in N.nearest_keys(keys, src, after=after, slice_unit=u).collect())
                for u in (1_000_000, 100_000_000, 10_000_000_000)]
        assert runs[0] == runs[1] == runs[2]
        brute = []
        for p in probes:
            ok = [(x, i) for i, x in enumerate(d) if (x > p if after else x <= p)]
            brute.append((p, (min(ok) if after else max(ok))[1] if ok else -1))
        assert runs[0] == sorted(brute)


def test_missing_item_keeps_probe_row(spark):
    src = items(spark, [20200101000000])
    probes = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 7, "c")], "pid int, dt long, tag string")
    rows = N.nearest_before(probes, src).collect()
    assert sorted((r.pid, r.tag, r.fid) for r in rows) == [(1, "a", None), (1, "b", None), (2, "c", None)]
