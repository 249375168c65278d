"""Slicing and paging properties: adaptive slices cover every record once, refine
only over-full slices, compat loses exactly the reference's tails, skew-safe row
numbers equal a window row_number even when one group spans many tasks."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.operators import slicing as SL
from cartloom.schemas import CUSTOMER_LADDER, ORDER_LADDER
from tests.conftest import SF01


@pytest.fixture(scope="module")
def events(spark):
    df = spark.read.parquet(f"{SF01}/events.parquet").cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("ladder", [ORDER_LADDER, CUSTOMER_LADDER])
def test_adaptive_slices_partition_the_records(events, ladder):
    cap = 3
    s = SL.adaptive_slices(events, "ts", ladder, cap=cap).cache()
    assert s.agg(F.sum("n")).first()[0] == events.count()
    # a chosen slice is under the cap unless it is a single second
    assert s.filter((F.col("n") >= cap) & (F.col("level_seconds") != ladder[-1])).count() == 0
    # slices are disjoint: every record falls into exactly one chosen slice
    joined = events.join(s, (F.col("ts") >= F.col("slice_start")) & (F.col("ts") < F.col("slice_end")))
    assert joined.count() == events.count()
    assert joined.select("event_id").distinct().count() == events.count()
    # every level of the ladder below the top occurs at cap 3
    levels = {r[0] for r in s.select("level_seconds").distinct().collect()}
    assert set(ladder[1:]) <= levels


def test_adaptive_default_cap_never_refines_small_days(events):
    s = SL.adaptive_slices(events, "ts", ORDER_LADDER, cap=200)
    assert {r[0] for r in s.select("level_seconds").distinct().collect()} == {900}


def _stamps(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, ts timestamp_ntz")


def test_compat_tail_and_day_end_losses(spark):
    d = dt.datetime(2024, 3, 10)
    at = lambda h, m, s, us=0: d + dt.timedelta(hours=h, minutes=m, seconds=s, microseconds=us)
    values = [at(23, 46, 0), at(23, 47, 0), at(23, 51, 0), at(23, 56, 0), at(23, 59, 59),
              at(23, 59, 59, 500000), at(1, 0, 0)]
    df = _stamps(spark, values)
    kept = {r["id"] for r in SL.compat_capture(df, "ts", ORDER_LADDER, cap=3, cut_seconds=False)
            .collect()}
    # last slice 23:45-23:59:59 holds 5 (>= 3): refined into two 5-min parts, so
    # 23:55:00 onwards is lost; 23:59:59.5 is lost by the closed day end anyway.
    assert kept == {0, 1, 2, 6}
    s = SL.adaptive_slices(df, "ts", ORDER_LADDER, cap=3, compat=True)
    assert s.agg(F.sum("n")).first()[0] == 4
    full = SL.adaptive_slices(df, "ts", ORDER_LADDER, cap=3)
    assert full.agg(F.sum("n")).first()[0] == 7


def test_compat_cuts_a_full_second(spark):
    t = dt.datetime(2024, 3, 10, 12, 0, 0)
    df = _stamps(spark, [t] * 5)
    kept = SL.compat_capture(df, "ts", ORDER_LADDER, cap=3, sort=["ts", "id"])
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2]
    s = SL.adaptive_slices(df, "ts", ORDER_LADDER, cap=3, compat=True, cut_seconds=True).first()
    assert (s["level_seconds"], s["n"], s["n_captured"]) == (1, 5, 3)
    paged = SL.adaptive_slices(df, "ts", ORDER_LADDER, cap=3, page_size=2).first()
    assert (paged["n_captured"], paged["n_pages"]) == (5, 3)


def test_sub_slices_truncate_like_the_reference(spark):
    s = dt.datetime(2024, 3, 10, 23, 45)
    spans = spark.createDataFrame([(s, s + dt.timedelta(seconds=899)),
                                   (s - dt.timedelta(minutes=15), s),
                                   (s, s)], "a timestamp_ntz, b timestamp_ntz")
    parts = SL.sub_slices(spans, "a", "b", 300)
    got = sorted((r["a"].hour, r["n_parts"], r["part_no"]) for r in parts.collect())
    assert got == [(23, 2, 0), (23, 2, 1), (23, 3, 0), (23, 3, 1), (23, 3, 2)]


def test_page_offsets(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 200), (4, 401)], "k int, n long")
    got = {}
    for r in SL.page_offsets(df, "n", 200, keep=["k"]).collect():
        got.setdefault(r["k"], []).append(r["start"])
    assert got == {2: [0], 3: [0], 4: [0, 200, 400]}


def test_row_numbers_match_window_with_a_hot_group(spark):
    # one group holds 90 % of the rows and spans every task of the range exchange
    rows = [(("hot" if i % 10 else f"g{i % 7}"), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = SL.row_numbers(df, ["g"], ["v"], "rn")
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v")))
        a = {(r["g"], r["v"], r["rn"]) for r in got.collect()}
        b = {(r["g"], r["v"], r["rn"]) for r in want.collect()}
        assert a == b
        assert max(r for g, _, r in a if g == "hot") == 4500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cap_per_group(spark, events):
    e = events.withColumn("day", F.to_date("ts"))
    capped = SL.cap_per_group(e, ["day"], ["ts", "event_id"], 5)
    assert capped.groupBy("day").count().agg(F.max("count")).first()[0] == 5
    assert capped.count() == 5 * e.select("day").distinct().count()


def test_fixed_slices_and_grid(spark, events):
    s = SL.fixed_slices(events, "ts", 3600)
    assert s.agg(F.sum("n")).first()[0] == events.count()
    days = spark.createDataFrame([(dt.date(2024, 3, 10),)], "day date")
    grid = SL.slice_grid(days, "day", 900, closed_day_end=True).orderBy("slice_no").collect()
    assert len(grid) == 96
    assert grid[-1]["slice_end"] == dt.datetime(2024, 3, 10, 23, 59, 59)


def test_assign_slices_pages_an_overfull_second(spark):
    t = dt.datetime(2024, 3, 10, 12, 0, 0)
    other = dt.datetime(2024, 3, 10, 13, 0, 0)
    df = _stamps(spark, [t] * 7 + [other])
    got = SL.assign_slices(df, "ts", ORDER_LADDER, cap=3, sort=["ts", "id"], page_size=2)
    rows = sorted((r["id"], r["level_seconds"], r["page_no"]) for r in got.collect())
    assert rows == [(0, 1, 0), (1, 1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 2), (5, 1, 2), (6, 1, 3),
                    (7, 900, 0)]


def test_page_offsets_cross_chunks(spark):
    n = SL.PAGE_CHUNK * 2 * 3 + 5                      # three pages per record block
    df = spark.createDataFrame([(1, n)], "k int, n long")
    got = SL.page_offsets(df, "n", 2, keep=["k"])
    rows = sorted((r["page_no"], r["start"]) for r in got.collect())
    assert len(rows) == (n + 1) // 2
    assert rows[0] == (0, 0) and rows[-1] == ((n + 1) // 2 - 1, ((n + 1) // 2 - 1) * 2)
    assert [p for p, _ in rows] == list(range(len(rows)))


def test_compat_capture_per_field_is_independent(spark):
    d = dt.datetime(2024, 3, 10)
    at = lambda h, m, s: d + dt.timedelta(hours=h, minutes=m, seconds=s)
    busy = [("a", at(23, 46, 0)), ("a", at(23, 47, 0)), ("a", at(23, 51, 0)), ("a", at(23, 56, 0))]
    quiet = [("b", at(23, 46, 0)), ("b", at(23, 56, 0))]
    df = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(busy + quiet)],
                               "id long, field string, ts timestamp_ntz")
    kept = SL.compat_capture(df, "ts", ORDER_LADDER, cap=3, by=["field"], cut_seconds=False)
    got = sorted((r["field"], r["id"]) for r in kept.collect())
    # field a: last slice holds 4 >= 3, refined, 23:56 lost; field b: 2 < 3, kept whole
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 4), ("b", 5)]
    s = SL.adaptive_slices(df, "ts", ORDER_LADDER, cap=3, by=["field"], compat=True)
    per = {r["field"]: 0 for r in s.collect()}
    for r in s.collect():
        per[r["field"]] += r["n"]
    assert per == {"a": 3, "b": 2}
