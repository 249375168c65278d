"""Time functions: UTC parsing, Pacific conversion on both sides of DST,
offset text, run-date forms, epoch helpers."""

import datetime as dt

from pyspark.sql import functions as F

from cartloom.functions import timefmt as TF


def one(spark, expr_fn, value, ddl="s string"):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr_fn(F.col(df.columns[0])).alias("x")).first()["x"]


def test_parse_utc_and_dst_edges(spark):
    parse = TF.parse_utc
    assert one(spark, parse, "2024-03-10T09:59:59.000Z") == dt.datetime(2024, 3, 10, 9, 59, 59)
    pst = lambda c: TF.to_pacific(TF.parse_utc(c))
    assert one(spark, pst, "2024-03-10T09:59:59.000Z") == dt.datetime(2024, 3, 10, 1, 59, 59)
    assert one(spark, pst, "2024-03-10T10:00:00.000Z") == dt.datetime(2024, 3, 10, 3, 0, 0)
    assert one(spark, pst, "2024-11-03T08:59:59Z") == dt.datetime(2024, 11, 3, 1, 59, 59)
    assert one(spark, pst, "2024-11-03T09:00:00Z") == dt.datetime(2024, 11, 3, 1, 0, 0)


def test_offset_text(spark):
    txt = lambda c: TF.pacific_text(TF.parse_utc(c))
    assert one(spark, txt, "2024-03-10T09:59:59.000Z") == "2024-03-10 01:59:59-08:00"
    assert one(spark, txt, "2024-03-10T10:00:00.000Z") == "2024-03-10 03:00:00-07:00"
    assert one(spark, txt, "2024-03-10T23:59:59.500Z") == "2024-03-10 16:59:59.500000-07:00"
    assert one(spark, txt, None) is None


def test_run_date_forms(spark):
    assert one(spark, TF.parse_run_date, "20240630") == dt.date(2024, 6, 30)
    assert one(spark, TF.parse_run_date, "2024-06-30") is None
    d = spark.createDataFrame([(dt.date(2024, 6, 30),)], "d date")
    r = d.select(TF.run_date_text("d").alias("a"), TF.day_text("d").alias("b")).first()
    assert (r["a"], r["b"]) == ("20240630", "2024-06-30")


def test_default_run_date_is_yesterday(spark):
    got = spark.range(1).select(TF.default_run_date().alias("d")).first()["d"]
    assert got == dt.date.today() - dt.timedelta(days=1) or got == dt.date.today()


def test_epoch_helpers_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = dt.datetime(2024, 3, 10, 2, 30, 0)  # a wall clock missing in New York
        df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
        r = df.select(TF.floor_to("t", 900).alias("f"), TF.add_seconds("t", 60).alias("a"),
                      TF.epoch_seconds("t").alias("e")).first()
        assert r["f"] == dt.datetime(2024, 3, 10, 2, 30)
        assert r["a"] == dt.datetime(2024, 3, 10, 2, 31)
        assert r["e"] == int((ts - dt.datetime(1970, 1, 1)).total_seconds())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_utc_offsets_and_malformed_text(spark):
    parse = TF.parse_utc
    assert one(spark, parse, "2024-03-10T09:00:00-07:00") == dt.datetime(2024, 3, 10, 16)
    assert one(spark, parse, "2024-03-10T09:00:00.250+0530") == dt.datetime(2024, 3, 10, 3, 30, 0, 250000)
    assert one(spark, parse, "2024-03-10T09:00:00+00:00") == dt.datetime(2024, 3, 10, 9)
    assert one(spark, parse, "2024-03-10") == dt.datetime(2024, 3, 10)
    for bad in ("yesterday", "2024-13-45T99:00:00Z", ""):
        assert one(spark, parse, bad) is None and one(spark, TF.bad_stamp, bad) is True
    assert one(spark, TF.bad_stamp, None) is False


def test_default_run_date(spark):
    assert one(spark, TF.default_run_date, "2024-03-01") == dt.date(2024, 2, 29)
