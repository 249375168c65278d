"""Properties: merging is idempotent and independent of input
order, explode counts equal the array sizes, page offsets are contiguous and
below the total, adaptive slices partition the records."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartloom.operators import merge as M
from cartloom.operators import slicing as SL
from cartloom.schemas import CUSTOMER_LADDER

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
                             st.integers(0, 50)), min_size=0, max_size=25)


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, t int")


@SETTINGS
@given(rows=rows_st, seed=st.integers(0, 1000))
def test_merge_idempotent_and_order_free(spark, rows, seed):
    import random

    shuffled = list(rows)
    random.Random(seed).shuffle(shuffled)
    a, b = _df(spark, rows), _df(spark, shuffled)
    first = lambda df: {tuple(r) for r in M.dedup_first(df, ["k"], [("t", True)]).collect()}
    assert first(a) == first(b)
    once = M.dedup_all(a)
    assert {tuple(r) for r in M.dedup_all(M.union_by_name(once, a)).collect()} == \
        {tuple(r) for r in once.collect()}


@SETTINGS
@given(sizes=st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=12))
def test_explode_counts_equal_array_sizes(spark, sizes):
    data = [(i, None if n is None else list(range(n))) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(data, "id int, arr array<int>")
    assert df.select(F.explode("arr")).count() == sum(n or 0 for n in sizes)
    assert df.select(F.explode_outer("arr")).count() == sum(max(1, n or 0) for n in sizes)


@SETTINGS
@given(ns=st.lists(st.integers(0, 700), min_size=1, max_size=6), page=st.integers(1, 250))
def test_page_offsets_contiguous_and_below_total(spark, ns, page):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(ns)], "k int, n long")
    got = {}
    for r in SL.page_offsets(df, "n", page, keep=["k"]).collect():
        got.setdefault(r["k"], []).append((r["page_no"], r["start"]))
    for k, n in enumerate(ns):
        pages = sorted(got.get(k, []))
        assert [s for _, s in pages] == list(range(0, n, page))
        assert [p for p, _ in pages] == list(range(len(pages)))


@SETTINGS
@given(offsets=st.lists(st.integers(0, 2 * 86400 - 1), min_size=1, max_size=40),
       cap=st.integers(1, 6))
def test_adaptive_slices_cover_each_record_once(spark, offsets, cap):
    base = dt.datetime(2024, 3, 10)
    df = spark.createDataFrame([(i, base + dt.timedelta(seconds=o)) for i, o in enumerate(offsets)],
                               "id long, ts timestamp_ntz")
    s = SL.adaptive_slices(df, "ts", CUSTOMER_LADDER, cap=cap).collect()
    assert sum(r["n"] for r in s) == len(offsets)
    for r in s:
        assert r["n"] < cap or r["level_seconds"] == 1
        inside = [o for o in offsets
                  if r["slice_start"] <= base + dt.timedelta(seconds=o) < r["slice_end"]]
        assert len(inside) == r["n"]
