"""Deep pages, files united by name, log counts by run, number text, key drift, closed bounds."""

import datetime as dt
import os
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.metrics import read_run_metrics
from cartloom.operators import drift
from cartloom.operators import slicing as SL
from cartloom.operators.conform import as_text
from cartloom.schemas import CUSTOMER_LADDER, ORDER_DOCUMENT, ORDER_LADDER
from cartloom.sources import search as SE
from cartloom.sources.flatfiles import read_pipe_csv_by_name, write_pipe_csv


def test_deep_pages_read_few_ranges(spark, monkeypatch):
    monkeypatch.setattr(SE, "DEEP", 10)
    monkeypatch.setattr(SE, "RANGE", 100)
    rows = [(i % 5, i) for i in range(1000)] + [(None, 7)] * 3 + [(9, 1)] * 500     # ties, nulls, equal rows
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is not None, r))
    for start in (11, 990, 1003, 1400, 1500, 2000):
        page = SE.search(df, None, sort=("a", "b"), start=start, count=7)
        got = [tuple(r) for r in page.collect()]
        assert got == [(*r, len(rows)) for r in order[start:start + 7]], start
    # Only the files of the ranges that hold the page are read.
    plan = SE.deep_page(df, ["a", "b"], 1400, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "_range" in plan.split("PushedFilters")[1]
    assert SE.deep_page(df.limit(0), ["a"], 20, 5).collect() == []


def test_files_with_other_headers_are_united_by_name(spark, tmp_path):
    first = spark.createDataFrame([(1, "a|b", 1.5), (2, "line\nbreak", None)], "no int, text string, v double")
    write_pipe_csv(first.coalesce(1), f"{tmp_path}/day=1")
    write_pipe_csv(spark.createDataFrame([("x", 3)], "text string, no int").coalesce(1), f"{tmp_path}/day 2 [a]")
    write_pipe_csv(spark.createDataFrame([(4, "new", 2.5)], "no int, `added.key` string, v double").coalesce(1), f"{tmp_path}/day=3")
    schema = T.StructType.fromDDL("no int, text string, v double, w date")
    got = read_pipe_csv_by_name(spark, str(tmp_path), schema)
    assert got.columns == ["no", "text", "v", "w", "added.key"] and got.schema["w"].dataType == T.DateType()
    assert sorted(map(tuple, got.collect())) == [
        (1, "a|b", 1.5, None, None), (2, "line\nbreak", None, None, None), (3, "x", None, None, None), (4, None, 2.5, None, "new")]
    assert read_pipe_csv_by_name(spark, str(tmp_path), schema, extra=False).columns == ["no", "text", "v", "w"]
    assert read_pipe_csv_by_name(spark, str(tmp_path), schema, "*.none").collect() == []


def test_log_counts_of_the_last_run_win(spark, tmp_path):
    def log(name, text, age):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (time.time() - age, time.time() - age))

    log("orders_20240310_a.log", "begin\ntotal_records : 5\nstate : run\ntotal_records : 6\nold_count : 1\n", 100)
    log("orders_20240310_b.log", "total_records : 8\nnoise\n", 50)          # the re-run of the day
    log("orders_20240311.log", "total_records : 7\n", 10)
    log("free.log", "total_records : 1\n", 0)
    got = {(r["run"].rsplit("/", 1)[-1], r["metric"]): (r["value"], r["n_values"]) for r in read_run_metrics(spark, str(tmp_path)).collect()}
    assert got == {("20240310", "total_records"): (8, 3), ("20240310", "old_count"): (1, 1),
                   ("20240311", "total_records"): (7, 1), ("free.log", "total_records"): (1, 1)}


def test_numbers_print_without_exponent(spark):
    rows = [(Decimal("12345678.50"), 12345678.5), (Decimal("100.00"), 100.0), (Decimal("0.10"), 0.00025), (Decimal("-7.25"), -1e15),
            (None, None), (Decimal("99999999999.99"), 0.1 + 0.2), (Decimal("0.00"), 0.0), (Decimal("1.00"), 123456789.125)]
    df = spark.createDataFrame(rows, "d decimal(18,2), f double").withColumn("i", F.lit(5))
    got = [tuple(r) for r in as_text(df, ["d", "f", "i"]).collect()]
    assert got == [(None if d is None else repr(float(d)), None if f is None else (repr(f) if abs(f) < 1e16 else None), "5") for d, f in rows]


def test_drift_names_unknown_and_retyped_keys(spark, tmp_path):
    import json

    docs = [{"order_no": "1", "status": "new", "order_total": 5, "payment_instruments": [{"amount": 1.5}, {"amount": "2", "c_x": True}]},
            {"order_no": "2", "status": None, "order_total": 5.25, "c_more": {"deep": 1}, "customer_info": "text", "weird.key": [1]},
            {"order_no": 3, "shipments": {"a": 1}, "payment_instruments": []}]
    (tmp_path / "r.json").write_text("\n".join(json.dumps({"total": 3, "hits": [{"data": d}]}) for d in docs) + '\n{"cut')
    keys = drift.document_keys(drift.read_variants(spark, str(tmp_path)))
    got = sorted((r["path"], r["problem"], r["found"], r["n"]) for r in drift.key_drift(keys, ORDER_DOCUMENT).collect())
    assert got == [("c_more", "unknown", "OBJECT", 1), ("customer_info", "retyped", "STRING", 1), ("order_no", "retyped", "BIGINT", 1),
                   ("payment_instruments.[].amount", "retyped", "VARIANT", 1), ("payment_instruments.[].c_x", "unknown", "BOOLEAN", 1),
                   ("shipments", "retyped", "OBJECT", 1), ("weird.key", "unknown", "ARRAY", 1)]


def test_schema_text_is_taken_apart():
    text = "OBJECT<a: DECIMAL(3,1), b: ARRAY<OBJECT<`c.d``:>`: BIGINT, e: ARRAY<VOID>>>, f: OBJECT<>, g: TIMESTAMP_NTZ>"
    assert drift.schema_paths(text) == [
        ("", "OBJECT", "a", "DECIMAL"), ("b.[]", "OBJECT", "b.[].c.d`:>", "BIGINT"), ("b.[].e", "ARRAY", "b.[].e.[]", "VOID"),
        ("b.[]", "OBJECT", "b.[].e", "ARRAY"), ("b", "ARRAY", "b.[]", "OBJECT"), ("", "OBJECT", "b", "ARRAY"),
        ("", "OBJECT", "f", "OBJECT"), ("", "OBJECT", "g", "TIMESTAMP_NTZ")]
    assert drift.schema_paths("STRING") == [] and drift.schema_paths("VOID") == []


def request_loop(stamps, ladder, cap, cut=True):
    """The reference's loop over one day in closed ranges: [(width, start, sorted stamps returned)]."""
    day = dt.datetime(2024, 3, 10)
    at = lambda s: day + dt.timedelta(seconds=s)
    out = []

    def ask(level, start, end):
        found = sorted(t for t in stamps if at(start) <= t <= at(end))
        if not found:
            return
        last = level == len(ladder) - 1
        if len(found) < cap or last:
            out.append((ladder[level], at(start), found[:cap] if cut and last else found))
        else:
            for i in range(int((end - start) / ladder[level + 1])):
                ask(level + 1, start + i * ladder[level + 1], start + (i + 1) * ladder[level + 1])

    for start in range(0, 86400, ladder[0]):
        ask(0, start, min(start + ladder[0], 86399))
    return out


@pytest.mark.parametrize("ladder,seed", [(ORDER_LADDER, 1), (CUSTOMER_LADDER, 2), (ORDER_LADDER, 3)])
def test_closed_decisions_equal_the_request_loop(spark, ladder, seed):
    rng, day = random.Random(seed), dt.datetime(2024, 3, 10)
    edges = [0, 900, 1800, 3600, 300, 60, 61, 59, 86399, 86100, 85500, 84600, 82800, 43200, 43500, 43201]
    stamps = [day + dt.timedelta(seconds=s) for s in edges for _ in range(rng.randint(0, 4))]
    stamps += [day + dt.timedelta(seconds=43200 + rng.randint(0, 900), microseconds=rng.choice([0, 0, 500_000])) for _ in range(60)]
    stamps += [day + dt.timedelta(seconds=rng.choice([85499, 85500, 86099, 86100, 86101, 86399]), microseconds=rng.choice([0, 1])) for _ in range(12)]
    df = spark.createDataFrame(list(enumerate(stamps)), "id long, ts timestamp_ntz").repartition(3)
    want = request_loop(stamps, ladder, 3)
    got = SL.adaptive_slices(df, "ts", ladder, cap=3, compat=True, closed=True, cut_seconds=True).collect()
    assert sorted((r["level_seconds"], r["slice_start"], r["n_captured"]) for r in got) == sorted((w, s, len(f)) for w, s, f in want)
    rows = SL.closed_capture(df, "ts", ladder, cap=3, sort=["ts", "id"]).collect()
    assert sorted((r["level_seconds"], r["slice_start"], r["ts"]) for r in rows) == sorted((w, s, t) for w, s, f in want for t in f)
    twice = [r["id"] for r in rows]
    assert len(twice) > len(set(twice))


def test_cap_per_group_is_a_group_limit(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    plan = SL.cap_per_group(df, ["g"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_log_scan_takes_the_run_from_its_folder(spark, tmp_path, monkeypatch):
    """A scratch folder whose name looks like a day is not the run."""
    from cartloom.plans import queries
    from tests.conftest import SF001

    days = queries.spark_queries()["log_metrics_scan"](spark, SF001).select("run").distinct().count()
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/a4281-9434/{name}")
    found = [r["run"] for r in queries.spark_queries()["log_metrics_scan"](spark, SF001).select("run").distinct().collect()]
    assert len(found) == days > 1 and all(run.endswith("-01-01") for run in found)
