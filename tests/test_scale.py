"""What the large tables need: plain lines move once, wide columns are built after the shuffles,
whole documents are landed compressed, and a day's documents are read from the whole once."""

import contextlib
import datetime as dt
import glob
import io
import re

from pyspark.sql import functions as F

from cartloom.plans import documents as D
from cartloom.plans import pipelines as P
from cartloom.plans import queries as Q
from cartloom.plans.pipelines import order_tables
from cartloom.session import ensure_checkpoint_dir, local_path
from tests.conftest import SF001


def _plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def _scratch(spark, name):
    return set(glob.glob(f"{local_path(ensure_checkpoint_dir(spark))}/cartloom/{name}-*"))


def _tables(spark):
    return [spark.read.parquet(f"{SF001}/{name}.parquet") for name in ("orders", "lineitem")]


def test_lines_move_once_and_as_plain_rows(spark):
    plan = _plan(D.order_documents(*[t.hint("merge") for t in _tables(spark)]))
    by_order = re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?, \d+\)", plan)
    assert len(by_order) == 2  # the partial counts, for the lines and for the orders
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?, doc_part", plan)) == 1


def test_small_parts_hold_every_line_and_no_empty_document(spark):
    orders, lines = _tables(spark)
    whole, parts = D.order_documents(orders, lines), D.order_documents(orders, lines, max_items=2)
    item = lambda docs: docs.select("order_no", "last_modified", F.explode("product_items").alias("item"))
    assert item(whole).exceptAll(item(parts)).count() == 0 == item(parts).exceptAll(item(whole)).count()
    assert parts.filter("doc_parts > 1 and product_items is null").count() == 0
    without = "product_items is null"
    assert parts.filter(without).count() == whole.filter(without).count() > 0


def test_orders_are_told_apart_by_narrow_rows(spark):
    plan = _plan(order_tables(D.landed_order_documents(spark, SF001), sep="_")["orders"])
    window = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    for name in ("file_name", "customer_emails", "order_notes", "order_taxation"):
        assert name not in window


def test_drifted_documents_are_landed_compressed(spark):
    before = _scratch(spark, "drifted-responses")
    Q.spark_queries()["key_drift"](spark, SF001)
    (path,) = _scratch(spark, "drifted-responses") - before
    assert glob.glob(f"{path}/*/*.json.gz") and not glob.glob(f"{path}/*/*.json")


def test_rerun_reads_the_days_documents_only(spark):
    before = _scratch(spark, "rerun-documents")
    Q._published_twice(spark, D.landed_order_documents(spark, SF001))
    (path,) = _scratch(spark, "rerun-documents") - before
    days = spark.read.parquet(path).select(F.date_format("creation_date", "yyyy-MM-dd").isin(*Q.RERUN_DAYS)
                                           | F.coalesce(F.date_format("last_modified", "yyyy-MM-dd").isin(*Q.RERUN_DAYS), F.lit(False)))
    assert {r[0] for r in days.collect()} <= {True}


def _with_repeated_lines(spark):
    """Documents of which some repeat: whole, a line in one document, lines in two documents of one
    order, and lines that differ only in what is not published; each beside one that does not."""
    item = "struct<_type:string,item_id:string,product_id:string,price:double,c_personalizationJson:string,unpublished:string,option_items:array<struct<item_id:string,price:double>>>"
    line = lambda n, price=1.0, text="a", other="x", option=2.0: ("product_item", f"i{n}", f"p{n}", price, text, other, [("o", option)])
    day, next_day = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("1", day, next_day, [line(1), line(2)]), ("1", day, next_day, [line(1), line(2)]),  # twice
            ("2", day, None, [line(1), line(1), line(3)]),
            ("3", day, day, [line(1), line(2)]), ("3", day, next_day, [line(2), line(4)]),
            ("4", day, next_day, [line(1, text="b"), line(1, text="c"), line(2, other="y"), line(2, other="z")]),
            ("5", day, next_day, [line(1, 0.0), line(1, -0.0)]), ("6", day, next_day, [line(1), line(1, option=3.0)]),
            ("7", day, next_day, [line(1), line(2)]), ("8", day, next_day, None), (None, day, day, [line(1)]), (None, day, day, [line(1)])]
    docs = spark.createDataFrame(rows, f"order_no string, creation_date timestamp_ntz, last_modified timestamp_ntz, product_items array<{item}>")
    rest = {"payment_instruments": "payment_instrument_id", "shipments": "shipment_id", "shipping_items": "item_id"}
    return docs.select("*", *[F.array(F.struct(F.lit("x").alias(v))).alias(k) for k, v in rest.items()])


def test_product_lines_are_distinct_whatever_repeats(spark, monkeypatch):
    docs = _with_repeated_lines(spark)
    lines = docs.select("*", F.explode("product_items").alias("i"))
    days = lines.select("*", F.explode(F.array_distinct(F.array_compact(F.array(F.to_date("creation_date"), F.to_date("last_modified"))))).alias("run_date"))
    want = sorted(map(str, days.select("run_date", "order_no", "i.item_id", "i.product_id", F.col("i.price") + 0.0, F.to_json("i.option_items")).distinct().collect()))
    assert len(want) == 4 + 2 + 5 + 4 + 2 + 4 + 4 + 1
    for words in (P.REPEAT_WORDS, 1):  # one word: most orders share a bit with one that repeats
        monkeypatch.setattr(P, "REPEAT_WORDS", words)
        got = order_tables(docs, sep="_")["products"]
        assert {r[0] for r in got.select("product_item_c_personalizationJson").collect()} == {"NAN"}
        assert got.filter("file_name != concat('products_data_', date_format(run_date, 'yyyyMMdd'), '.csv')").count() == 0
        found = got.select("run_date", "order_order_no", "product_item_item_id", "product_item_product_id", F.col("product_item_price") + 0.0,
                           "product_item_option_items").collect()
        assert sorted(str(r).replace("order_order_no", "order_no").replace("product_item_", "") for r in found) == \
            sorted(w.replace("to_json(i.option_items)", "option_items").replace("(i.price", "(price") for w in want)


def test_product_lines_of_single_orders_are_not_shuffled(spark):
    plan = _plan(order_tables(D.landed_order_documents(spark, SF001), sep="_")["products"])
    assert "Union" in plan
    (moved,) = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "run_date" in line]
    assert "file_name" not in moved and "product_item_option_items" in plan
    whole, parts = (D.order_documents(*_tables(spark), max_items=n) for n in (D.MAX_ITEMS, 2))
    assert whole.filter(P._may_repeat_lines(whole)).count() == 0
    again, counts = parts.filter(P._may_repeat_lines(parts)), parts.groupBy("order_no").count()
    several = counts.filter("count > 1").count()
    assert 0 < several <= again.select("order_no").distinct().count() < counts.count()
    assert again.join(counts.filter("count > 1"), "order_no").select("order_no").distinct().count() == several
