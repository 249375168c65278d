"""Merge rules, day counts with missing stamps, reconcile modes, gate, markers."""

import datetime as dt

from pyspark.sql import functions as F

from cartloom.operators import merge as M
from cartloom.operators import quality as Q

D = dt.date(2024, 3, 10)
T = lambda d, h=0: dt.datetime(d.year, d.month, d.day, h)


def test_dedup_first_prefers_latest_modification(spark):
    df = spark.createDataFrame(
        [("1", "a", T(D, 1)), ("1", "a", T(D, 5)), ("1", "b", T(D, 3)), ("2", "x", None)],
        "no string, v string, m timestamp_ntz")
    got = M.dedup_first(df, ["no"], [("m", True)]).orderBy("no").collect()
    assert [(r["no"], r["v"], r["m"]) for r in got] == [("1", "a", T(D, 5)), ("2", "x", None)]
    asc = M.dedup_first(df, ["no"], ["v"]).filter(F.col("no") == "1").first()
    assert (asc["v"], asc["m"]) == ("a", T(D, 1))


def test_dedup_all_and_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(1, 2.0)], "k int, b double")
    u = M.union_by_name(a, b, a)
    assert u.columns == ["k", "a", "b"] and u.count() == 3
    assert M.dedup_all(u).count() == 2


def test_change_feed_emits_each_day_once(spark):
    df = spark.createDataFrame([("1", T(D), T(D, 5)), ("2", T(D), T(D + dt.timedelta(1))),
                                ("3", T(D), None)], "no string, c timestamp_ntz, m timestamp_ntz")
    got = sorted((r["run_date"], r["no"]) for r in M.change_feed(df, "c", "m").collect())
    assert got == [(D, "1"), (D, "2"), (D, "3"), (D + dt.timedelta(1), "2")]


def test_day_counts_null_semantics(spark):
    rows = spark.createDataFrame(
        [(D, "1", T(D), T(D)), (D, "2", None, T(D)), (D, "3", T(D - dt.timedelta(2)), T(D)),
         (D, None, T(D), None)],
        "run_date date, no string, c timestamp_ntz, m timestamp_ntz")
    r = Q.day_counts(rows, "run_date", "no", "c", "m").first()
    # a missing creation stamp is "not created today" but not "created on or before"
    assert (r["total"], r["created"], r["modified"], r["total_modified"]) == (3, 2, 2, 2)


def test_reconcile_modes_and_gate(spark):
    src = spark.createDataFrame([(D, 5, 3), (D + dt.timedelta(1), 2, 2)],
                                "run_date date, total_created long, total_modified long")
    files = spark.createDataFrame([(D, 5, 1), (D + dt.timedelta(1), 1, 1)],
                                  "run_date date, created long, total_modified long")
    verdict = lambda mode: {r["run_date"]: r["passed"]
                            for r in Q.reconcile(src, files, mode=mode).collect()}
    assert verdict("or") == {D: False, D + dt.timedelta(1): False}
    assert verdict("and") == {D: True, D + dt.timedelta(1): False}
    assert verdict("created") == {D: True, D + dt.timedelta(1): False}
    rows = spark.createDataFrame([(D, "a"), (D + dt.timedelta(1), "b")], "run_date date, x string")
    gated = Q.publish_gate(rows, Q.reconcile(src, files, mode="and"))
    assert [r["x"] for r in gated.collect()] == ["a"]


def test_markers_for_empty_and_passing_days_only(spark):
    totals = spark.createDataFrame([(D, 4), (D + dt.timedelta(1), 0), (D + dt.timedelta(2), 3)],
                                   "run_date date, total_records long")
    verdicts = spark.createDataFrame([(D, True), (D + dt.timedelta(2), False)],
                                     "run_date date, passed boolean")
    got = sorted((r["run_date"], r["total"], r["state"])
                 for r in Q.trigger_rows(totals, verdicts).collect())
    assert got == [(D, 4, "published"), (D + dt.timedelta(1), 0, "empty")]


def test_source_totals_count_twice_when_created_and_modified(spark):
    df = spark.createDataFrame([(T(D), T(D, 3)), (T(D), T(D + dt.timedelta(1)))],
                               "c timestamp_ntz, m timestamp_ntz")
    got = {r["run_date"]: (r["total_created"], r["total_modified"], r["total_records"],
                           r["total_distinct"]) for r in Q.source_totals(df, "c", "m").collect()}
    assert got == {D: (2, 1, 3, 2), D + dt.timedelta(1): (0, 1, 1, 1)}


def test_dedup_first_has_no_sort_aggregate(spark):
    from cartloom.plans.queries import spark_queries
    from tests.conftest import SF001

    for name in ("dedup_subset", "orders_day_table"):
        plan = spark_queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan, name
