"""Search requests, pushdown into the scan, slice writer, flat-file round trip."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cartloom.functions.labels import path_part_from_end, slice_label, substitute_run_date
from cartloom.functions.metrics import metric_lines, metric_name, metric_value
from cartloom.sinks.publish import write_slices
from cartloom.sources.calendar import day_spine
from cartloom.sources.flatfiles import read_pipe_csv
from cartloom.sources.search import range_filter, search
from tests.conftest import SF01


def test_search_match_all_and_range(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    page = search(e, None, sort=("ts", "event_id"), start=0, count=200)
    rows = page.collect()
    assert len(rows) == 200 and rows[0]["total"] == e.count()
    assert [r["ts"] for r in rows] == sorted(r["ts"] for r in rows)
    closed = range_filter(e, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00", closed=True)
    half = range_filter(e, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00")
    assert closed.count() >= half.count() > 0
    last = search(e, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00", sort=("ts",),
                  start=10_000, count=200)
    assert last.count() == 0


def test_range_filter_reaches_the_parquet_scan(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    q = range_filter(e, "ts", "2024-01-10 00:00:00", "2024-01-11 00:00:00").select("event_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_write_slices_and_read_back(spark, tmp_dir):
    df = spark.createDataFrame(
        [("creation_date", dt.datetime(2024, 3, 10, 0, 15), "1", "007"),
         ("last_modified", dt.datetime(2024, 3, 10, 0, 30), "2", "042")],
        "extraction_field string, slice_start timestamp_ntz, order_no string, customer_no string")
    path = os.path.join(tmp_dir, "slices")
    write_slices(df, path)
    folders = sorted(f for f in os.listdir(path) if f.startswith("extraction_field="))
    assert folders == ["extraction_field=creation_date", "extraction_field=last_modified"]
    back = read_pipe_csv(spark, path, df.select("order_no", "customer_no").schema)
    assert sorted((r["order_no"], r["customer_no"]) for r in back.collect()) == \
        [("1", "007"), ("2", "042")]


def test_labels_paths_and_metrics(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 23, 45), dt.datetime(2024, 3, 10, 23, 59, 59),
                                 "/a/b/c.csv", "20240310")],
                               "s timestamp_ntz, e timestamp_ntz, p string, d string")
    r = df.select(slice_label("orders", "creation_date", F.col("s"), F.col("e")).alias("l"),
                  path_part_from_end("p", 1).alias("f"), path_part_from_end("p", 2).alias("g"),
                  path_part_from_end(F.lit("x"), 2).alias("none"),
                  substitute_run_date(F.lit("out/RUN_DATE/x_RUN_DATE.csv"), F.col("d")).alias("t")
                  ).first()
    assert r["l"] == "orders_on_creation_date_2024-03-10_23_45_00_to_23_59_59.csv"
    assert (r["f"], r["g"], r["none"]) == ("c.csv", "b", None)
    assert r["t"] == "out/20240310/x_20240310.csv"
    counts = spark.createDataFrame([("d1", 5, 2)], "day string, total_orders_today long, total_modified long")
    lines = metric_lines(counts, ["day"], ["total_orders_today", "total_modified"])
    got = sorted((r["m"], r["v"]) for r in lines.select(metric_name("line").alias("m"),
                                                        metric_value("line").alias("v")).collect())
    assert got == [("total_modified", 2), ("total_orders_today", 5)]


def test_day_spine(spark):
    days = [r["day"] for r in day_spine(spark, "2024-06-01", "2024-06-17").collect()]
    assert len(days) == 17 and days[0] == dt.date(2024, 6, 1)


def test_metric_lines_scanned_from_log_text(spark, tmp_dir):
    from cartloom.functions.metrics import read_metric_lines

    path = os.path.join(tmp_dir, "run.log")
    with open(path, "w") as fh:
        fh.write("starting\ntotal_orders_today : 12\norders_created_today : 7\n"
                 "state : complete\ntotal_modified : 3\n")
    got = sorted((r["metric"], r["value"]) for r in read_metric_lines(spark, path).collect())
    assert got == [("orders_created_today", 7), ("total_modified", 3), ("total_orders_today", 12)]


def test_page_label(spark):
    from cartloom.functions.labels import page_label

    df = spark.createDataFrame([("customers_on_creation_date_2024-03-10_10_00_00_to_10_00_01.csv", 3)],
                               "l string, p int")
    assert df.select(page_label("l", "p").alias("x")).first()["x"] == \
        "customers_on_creation_date_2024-03-10_10_00_00_to_10_00_01_P3.csv"


def test_flat_files_keep_line_breaks_and_check_headers(spark, tmp_dir):
    from cartloom.sources.flatfiles import write_pipe_csv

    rows = [("1", 'a "quoted"\nline | pipe'), ("2", "cr\r\nlf"), ("3", "back\\slash"), ("4", None)]
    df = spark.createDataFrame(rows, "no string, text string")
    path = os.path.join(tmp_dir, "flat")
    write_pipe_csv(df, path)
    back = {tuple(r) for r in read_pipe_csv(spark, path, df.schema).collect()}
    assert {no: t and t.replace("\r\n", "\n") for no, t in back} == \
        {no: t and t.replace("\r\n", "\n") for no, t in rows}
    wrong = spark.createDataFrame([], "text string, no string").schema
    try:
        read_pipe_csv(spark, path, wrong).collect()
    except Exception as error:  # noqa: BLE001 - Spark's own error class varies
        assert "header" in str(error).lower()
    else:
        raise AssertionError("a wrong header must fail the scan")


def test_a_second_slice_run_replaces_the_first(spark, tmp_dir):
    df = spark.createDataFrame([("creation_date", "00_15_00", "1")],
                               "extraction_field string, slice_start string, order_no string")
    path = os.path.join(tmp_dir, "again")
    write_slices(df, path)
    write_slices(df, path)
    assert read_pipe_csv(spark, path, df.select("order_no").schema).count() == 1


def test_submitted_settings_stay(tmp_path):
    import subprocess
    import sys

    code = ("from cartloom.session import build_session\n"
            "s = build_session('local[1]')\n"
            "print('N', s.conf.get('spark.sql.shuffle.partitions'))")
    env = dict(os.environ, PYTHONPATH=os.getcwd(),
               PYSPARK_SUBMIT_ARGS="--conf spark.sql.shuffle.partitions=4000 pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "N 4000" in out.stdout, out.stderr[-500:]
