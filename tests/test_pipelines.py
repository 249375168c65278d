"""Day pipelines end to end on landed golden documents: entity tables, merge
rules, counts, reconcile, gated publish, markers, manifest, flat-file round trip."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from cartloom import schemas
from cartloom.operators import flatten as FL
from cartloom.plans import pipelines as P
from cartloom.sinks.publish import manifest
from cartloom.sources.envelope import documents, read_customer_envelopes, read_order_envelopes
from cartloom.sources.flatfiles import read_pipe_csv
from tests import golden

D = dt.date(2024, 3, 10)


@pytest.fixture(scope="module")
def order_docs(spark, tmp_path_factory):
    folder = golden.write_envelopes(str(tmp_path_factory.mktemp("orders")),
                                    golden.order_documents())
    return documents(read_order_envelopes(spark, folder))


def test_order_tables_shapes_and_rules(order_docs):
    t = P.order_tables(order_docs)
    orders = t["orders"]
    assert orders.columns == ["run_date"] + schemas.ORDER_COLUMNS
    assert t["products"].columns == ["run_date"] + schemas.PRODUCT_COLUMNS
    assert t["option_items"].columns == ["run_date"] + schemas.OPTION_ITEM_COLUMNS
    assert t["payments"].columns == ["run_date"] + schemas.PAYMENT_COLUMNS
    # the same order twice, only last_modified differing: the latest survives
    o12 = orders.filter(F.col("order_order_no") == "12").collect()
    assert len(o12) == 1 and o12[0]["order_last_modified"] == dt.datetime(2024, 3, 10, 12)
    o1 = orders.filter(F.col("order_order_no") == "1").first()
    assert o1["order_creation_pst_date"] == dt.datetime(2024, 3, 10, 1, 59, 59)
    assert o1["order_last_modified_pst_date"] == dt.datetime(2024, 3, 10, 3, 0, 0)
    assert o1["file_name"] == "orders_data_20240310.csv"
    # version 2's two equal lines merge into one; version 1's i1 differs (it has
    # option items), so it stays; personalisation text is NAN
    p12 = t["products"].filter(F.col("order_order_no") == "12").collect()
    assert sorted(r["product_item_item_id"] for r in p12) == ["i1", "i1", "i2"]
    assert {r["product_item_c_personalizationJson"] for r in p12} == {"NAN"}
    # products without an id are dropped
    assert t["products"].filter(F.col("product_item_product_id").isNull()).count() == 0


def test_run_orders_publishes_passing_day_with_marker(spark, order_docs, tmp_dir):
    source = P.source_totals_of(order_docs.filter(F.col("order_no") != "5"))
    run = P.run_orders(order_docs, source, out=tmp_dir, run_dates=[D])
    verdict = {r["run_date"]: r["passed"] for r in run.verdicts.collect()}
    assert verdict == {D: True}
    assert [r["order_no"] for r in run.quarantined.collect()] == ["5"]
    for entity in ("orders", "products", "option_items", "payments"):
        assert os.path.isdir(os.path.join(tmp_dir, entity, "run_date=2024-03-10"))
    marks = spark.read.parquet(os.path.join(tmp_dir, "_markers")).collect()
    assert [(m["entity"], m["run_date"], m["state"]) for m in marks] == [("orders", D, "published")]
    assert spark.read.parquet(os.path.join(tmp_dir, "_quarantine/orders/documents/*")).count() == 1
    files = manifest(spark, os.path.join(tmp_dir, "orders"))
    assert {(r["run_date"], r["folder_name"]) for r in files.collect()} == {(D, f"version={run.version}")}
    assert all(r["n_bytes"] == os.path.getsize(r["file_path"].removeprefix("file:")) for r in files.collect())
    from pyspark.sql import types as T

    text_schema = T.StructType([T.StructField(f.name, T.StringType() if "date" in f.name
                                              else f.dataType)
                                for f in run.tables["orders"].drop("run_date").schema.fields])
    back = read_pipe_csv(spark, os.path.join(tmp_dir, "orders"), text_schema)
    assert back.count() == run.tables["orders"].count()
    nos = {r["order_customer_info.customer_no"] for r in back.collect()}
    assert "007" in nos
    o1 = back.filter(F.col("order_order_no") == "1").first()
    assert o1["order_creation_date"] == "2024-03-10T09:59:59.000Z"
    assert o1["order_creation_pst_date"] == "2024-03-10 01:59:59-08:00"
    assert o1["order_last_modified_pst_date"] == "2024-03-10 03:00:00-07:00"


def test_run_orders_withholds_a_mismatched_day(spark, order_docs, tmp_dir):
    source = P.source_totals_of(order_docs).withColumn("total_created", F.lit(99).cast("long")) \
        .withColumn("total_modified", F.lit(99).cast("long"))
    run = P.run_orders(order_docs, source, out=tmp_dir, run_dates=[D])
    assert [r["passed"] for r in run.verdicts.collect()] == [False]
    assert not os.path.exists(os.path.join(tmp_dir, "orders", "run_date=2024-03-10"))
    assert not os.path.exists(os.path.join(tmp_dir, "_markers", "entity=orders"))


def published(folder):
    """Bytes of all files below a folder, without checksums and commit marks."""
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read()
            for d, _, files in os.walk(folder) for f in files if not f.startswith((".", "_"))}


def test_a_later_run_leaves_earlier_days_as_they_are(spark, tmp_path):
    """An order of day 1 changes on day 2: the second run writes day 2 only."""
    day2 = dt.date(2024, 3, 12)
    docs = [d for d in golden.order_documents() if d["order_no"] != "5"]
    first = documents(read_order_envelopes(spark, golden.write_envelopes(str(tmp_path / "1"), docs)))
    out = str(tmp_path / "out")
    P.run_orders(first, P.source_totals_of(first), out, run_dates=[D])
    before = {e: published(f"{out}/{e}/run_date={D}") for e in ("orders", "products", "payments")}
    marker = published(f"{out}/_markers/entity=orders/run_date={D}")
    assert all(before.values()) and marker
    changed = dict(docs[0], last_modified="2024-03-12T08:00:00.000Z")
    second = documents(read_order_envelopes(spark, golden.write_envelopes(str(tmp_path / "2"), [changed])))
    source = P.source_totals_of(second).filter(F.col("run_date") == day2)
    run = P.run_orders(second, source, out, run_dates=[day2, dt.date(2024, 3, 13)])
    assert {r["run_date"]: r["passed"] for r in run.verdicts.collect()}[day2]
    assert {e: published(f"{out}/{e}/run_date={D}") for e in before} == before
    assert published(f"{out}/_markers/entity=orders/run_date={D}") == marker
    marks = {(m["run_date"], m["total"], m["state"]) for m in spark.read.parquet(f"{out}/_markers").collect()}
    assert (day2, 1, "published") in marks and (dt.date(2024, 3, 13), 0, "empty") in marks
    assert published(f"{out}/orders/run_date={day2}")


@pytest.mark.parametrize("damage", ["missing hit", "cut page", "none"])
def test_a_run_over_broken_responses_passes_no_day(spark, tmp_path, damage):
    import json as _json

    docs = [d for d in golden.order_documents() if d["order_no"] != "5"]
    folder = golden.write_envelopes(str(tmp_path / "landing"), docs)
    path = os.path.join(folder, "responses.json")
    lines = open(path).read().splitlines()
    if damage == "missing hit":
        page = _json.loads(lines[0])
        page["hits"] = page["hits"][:-1]
        lines[0] = _json.dumps(page)
    elif damage == "cut page":
        lines[-1] = lines[-1][:len(lines[-1]) // 2]
    open(path, "w").write("\n".join(lines) + "\n")
    envelopes = read_order_envelopes(spark, folder)
    found = documents(envelopes)
    out = str(tmp_path / "out")
    # Totals counted from the documents themselves would agree: the audit must not.
    run = P.run_orders(found, P.source_totals_of(found), out, run_dates=[D], envelopes=envelopes)
    assert [r["passed"] for r in run.verdicts.collect()] == [damage == "none"]
    assert os.path.exists(os.path.join(out, "orders", f"run_date={D}")) == (damage == "none")
    kept = spark.read.parquet(f"{out}/_quarantine/orders/responses/*").count()
    assert kept == (damage == "cut page")


def test_publishing_needs_run_dates(order_docs, tmp_dir):
    with pytest.raises(ValueError):
        P.run_orders(order_docs, P.source_totals_of(order_docs), out=tmp_dir)


def test_customers_defaults_and_pacific_columns(spark, tmp_path):
    folder = golden.write_envelopes(str(tmp_path), golden.customer_documents())
    docs = documents(read_customer_envelopes(spark, folder))
    table = P.customer_table(docs)
    assert table.columns == ["run_date"] + schemas.CUSTOMER_COLUMNS
    rows = {(r["run_date"], r["customer_id"]): r for r in table.collect()}
    full = rows[(D, "k1")]
    assert full["customer_no"] == "00042" and full["phone_home"] == "0123"
    assert full["creation_date_pst"] == dt.datetime(2024, 3, 10, 1, 59, 59)
    assert full["last_login_time_pst"] == dt.datetime(2024, 3, 10, 3, 0, 0)
    only = rows[(D, "k2")]
    assert only["email"] is None and only["gender"] is None
    assert math.isnan(only["c_pointsBalance"])
    # created the day before, modified on D: one row per day
    assert (dt.date(2024, 3, 9), "k3") in rows and (D, "k3") in rows
    assert rows[(D, "k3")]["last_login_time_pst"] is None
    run = P.run_customers(docs, P.source_totals_of(docs, key="customer_id"))
    assert {r["run_date"]: r["passed"] for r in run.verdicts.collect()} == \
        {dt.date(2024, 3, 9): True, D: True}


def test_backfill_payments_range(order_docs):
    pays = P.backfill_payments(order_docs, "2024-03-10", "2024-03-10")
    assert pays.columns == ["run_date"] + schemas.PAYMENT_COLUMNS
    assert pays.filter(F.col("order_order_no") == "1").count() == 2
    assert {r["file_name"] for r in pays.collect()} == {"payment_details_data_20240310.csv"}
    assert P.backfill_payments(order_docs, "2024-03-11", "2024-03-12").count() == 0


def test_extract_to_slice_files_then_merge_matches_direct_tables(spark, order_docs, tmp_dir):
    out = os.path.join(tmp_dir, "extract")
    valid = FL.valid_documents(order_docs)
    for field in P.ORDER_FIELDS:
        P.extract_day(valid, "2024-03-10", out, field, cap=3)
    folders = os.listdir(os.path.join(out, "orders", "run_date=2024-03-10"))
    assert {"extraction_field=creation_date", "extraction_field=last_modified"} <= set(folders)
    merged = P.merge_day_files(spark, out, "2024-03-10", P.slice_schemas(valid))
    direct = P.order_tables(order_docs)
    for entity in ("orders", "products", "option_items", "payments"):
        a = {tuple(r) for r in merged[entity].collect()}
        b = {tuple(r) for r in direct[entity].filter(F.col("run_date") == D).collect()}
        assert a == b, entity


def test_customer_slice_files_then_merge_matches_direct_table(spark, tmp_path):
    folder = golden.write_envelopes(str(tmp_path / "landing"), golden.customer_documents())
    docs = documents(read_customer_envelopes(spark, folder))
    out = str(tmp_path / "extract")
    for field in ("creation_date", "last_modified"):
        P.extract_customers_day(docs, "2024-03-10", out, field, cap=2, page_size=1)
    parts = os.listdir(os.path.join(out, "customers", "run_date=2024-03-10"))
    assert "extraction_field=creation_date" in parts
    merged = P.merge_customer_files(spark, out, "2024-03-10")
    direct = P.customer_table(docs).filter(F.col("run_date") == D)

    def norm(df):
        return {tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)
                for r in df.collect()}

    assert norm(merged) == norm(direct)
    assert merged.filter(F.col("customer_no") == "00042").count() == 1


def test_merge_of_a_day_without_files_is_empty_and_typed(spark, order_docs, tmp_dir):
    out = os.path.join(tmp_dir, "extract")
    valid = FL.valid_documents(order_docs)
    P.extract_day(valid, "2024-03-10", out, "creation_date", cap=3)
    merged = P.merge_day_files(spark, out, "2024-03-11", P.slice_schemas(valid))
    assert merged["orders"].count() == 0
    assert merged["orders"].columns == ["run_date"] + schemas.ORDER_COLUMNS


def test_command_line_orders_job(spark, tmp_path):
    from cartloom.__main__ import main

    landing = tmp_path / "landing" / "20240310"
    docs = [d for d in golden.order_documents() if d["order_no"] != "5"]  # no quarantine
    golden.write_envelopes(str(landing), docs)
    out = str(tmp_path / "published")
    totals = P.source_totals_of(documents(read_order_envelopes(spark, str(landing)))).collect()
    for r in totals:
        for field, n in (("creation_date", r["total_created"]), ("last_modified", r["total_modified"])):
            folder = tmp_path / "probes" / f"field={field}" / f"run_date={r['run_date']}"
            folder.mkdir(parents=True)
            (folder / "response.json").write_text(f'{{"total": {n}, "count": 1}}\n')
    summary = main(["orders", "--landing", str(tmp_path / "landing"), "--out", out, "--date", "20240310",
                    "--per-day-folders", "--probes", str(tmp_path / "probes")])
    assert summary["verdict"][0]["passed"] is True
    assert os.path.isdir(os.path.join(out, "orders", "run_date=2024-03-10"))
    assert os.path.isdir(os.path.join(out, "_markers"))


def test_probe_totals_feed_the_reconciliation(spark, order_docs, tmp_path):
    import json as _json

    from cartloom.sources.envelope import read_probe_totals

    for field, total in (("creation_date", 10), ("last_modified", 10)):
        folder = tmp_path / "probes" / f"field={field}" / "run_date=2024-03-10"
        folder.mkdir(parents=True)
        (folder / "response.json").write_text(_json.dumps({"total": total, "count": 200}) + "\n")
    source = read_probe_totals(spark, str(tmp_path / "probes"))
    r = source.first()
    assert (r["run_date"], r["total_created"], r["total_modified"], r["total_records"]) == \
        (D, 10, 10, 20)
    run = P.run_orders(order_docs, source)
    assert [v["passed"] for v in run.verdicts.collect()] == [True]


def test_command_line_payments_backfill(spark, tmp_path):
    from cartloom.__main__ import main

    landing = tmp_path / "landing"
    golden.write_envelopes(str(landing), golden.order_documents())
    out = str(tmp_path / "backfill")
    main(["payments", "--landing", str(landing), "--out", out,
          "--first", "2024-03-10", "--last", "2024-03-10"])
    back = spark.read.option("header", "true").option("sep", "|").csv(os.path.join(out, "payments"))
    assert back.filter(F.col("order_order_no") == "1").count() == 2
    assert {r["run_date"] for r in back.select("run_date").collect()} == {D}
