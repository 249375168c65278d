"""Flattening golden order documents: every optional array absent / empty / one /
many, null e-mail, leading zeros, dotted names, strict vs default."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cartloom.operators import flatten as FL
from cartloom.sources.envelope import documents, explode_hits, read_order_envelopes
from tests import golden


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    folder = golden.write_envelopes(str(tmp_path_factory.mktemp("landing")),
                                    golden.order_documents())
    df = documents(read_order_envelopes(spark, folder)).cache()
    yield df
    df.unpersist()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_envelope_scan_keeps_totals(spark, tmp_path):
    folder = golden.write_envelopes(str(tmp_path), golden.order_documents(), page_size=5)
    hits = explode_hits(read_order_envelopes(spark, folder))
    counts = {(r["total"], r["count"]) for r in hits.select("total", "count").collect()}
    assert counts == {(12, 5), (12, 2)}
    assert hits.count() == 12


def test_quarantine_reports_absent_required_arrays(docs):
    assert rows(FL.quarantine(docs), "order_no", "reason") == [("5", "shipments absent")]


def test_order_rows_default_keeps_orders_with_empty_arrays(docs):
    out = FL.order_rows(docs, sep=".")
    nos = {r["order_order_no"] for r in out.collect()}
    assert nos == {"1", "2", "3", "4", "6", "7", "8", "9", "10", "12"}
    assert len(out.columns) == 32
    assert "order_customer_info.customer_id" in out.columns


def test_order_rows_strict_drops_orders_with_an_empty_array(docs):
    nos = {r["order_order_no"] for r in FL.order_rows(docs, strict=True).collect()}
    assert nos == {"1", "2", "7", "8", "9", "10", "12"}


def test_customer_number_keeps_leading_zeros(docs):
    out = FL.order_rows(docs, sep="_").filter(F.col("order_order_no") == "1")
    assert out.first()["order_customer_info_customer_no"] == "007"


def test_email_hash_null_stays_null_and_compat_hashes_nan(docs):
    default = dict(rows(FL.order_rows(docs), "order_order_no", "customer_emails"))
    compat = dict(rows(FL.order_rows(docs, compat=True), "order_order_no", "customer_emails"))
    nan = hashlib.sha256(b"nan").hexdigest()
    assert default["8"] is None and default["9"] is None
    assert compat["8"] == nan and compat["9"] == nan
    assert default["1"] == hashlib.sha256(b"a@example.com").hexdigest()


def test_personal_fields_are_dropped(docs):
    cols = FL.order_rows(docs, sep=".").columns
    for c in ("order_customer_name", "order_order_token", "order_customer_info.email",
              "order_billing_address.phone"):
        assert c not in cols


def test_product_rows_outer_semantics(docs):
    out = FL.product_rows(docs, sep="_")
    per = {}
    for r in out.collect():
        per.setdefault(r["order_order_no"], []).append(r["product_item_product_id"])
    assert sorted(per["1"]) == ["prod-1", "prod-2"]
    assert per["2"] == [None]          # absent -> one null row
    assert per["3"] == [None]          # empty, default mode keeps the order
    assert "5" not in per              # quarantined
    strict = {r["order_order_no"] for r in FL.product_rows(docs, strict=True).collect()}
    assert "3" not in strict and "2" in strict
    assert len(out.columns) == 28


def test_option_items_carry_parent_keys(docs):
    out = FL.option_item_rows(docs, sep="_").filter(F.col("order_no") == "1")
    got = rows(out, "product_items_product_id", "product_item_item_id", "option_items_option_id",
               "option_items_tax_basis")
    assert got == [("prod-1", "i1", "opt-a", "1.25"), ("prod-1", "i1", "opt-b", "1.25")]


def test_payments_one_row_per_instrument(docs):
    out = FL.payment_rows(docs, sep=".")
    assert set(out.columns) >= {"payment_inst_payment_card.card_type", "file_name"}
    per = {}
    for r in out.collect():
        per[r["order_order_no"]] = per.get(r["order_order_no"], 0) + 1
    assert per["1"] == 2 and "4" not in per


def test_first_item_adjustments_only(docs):
    out = FL.first_item_adjustments(docs, sep="_")
    per = {}
    for r in out.collect():
        per.setdefault(r["order_order_no"], []).append(r["price_adjustments_price_adjustment_id"])
    assert sorted(per["1"]) == ["PA1", "PA2"]
    assert per["7"] == [None]          # first item has none; the second's are ignored
    assert per["6"] == [None]          # present but empty, default mode
    strict = {r["order_order_no"] for r in FL.first_item_adjustments(docs, strict=True).collect()}
    assert "6" not in strict and "7" in strict


def test_entity_product_row_count(docs):
    counts = dict(rows(FL.entity_product(docs).groupBy("order_no").count(), "order_no", "count"))
    assert counts["1"] == 2 * 1 * 1 * 2 * 2
    assert counts["2"] == 2 * 1 * 1 * 2 * 1
    sizes = FL.entity_product_size(docs).groupBy("order_no").agg(F.sum("n_rows").alias("n"))
    assert dict(rows(sizes, "order_no", "n")) == counts


def test_flatten_nested_names(spark):
    df = spark.createDataFrame([(1, (2, (3, "x")))], "a int, s struct<b:int,t:struct<c:int,d:string>>")
    assert FL.flatten(df, prefix="p_", sep=".").columns == ["p_a", "p_s.b", "p_s.t.c", "p_s.t.d"]
    assert FL.flatten(df, sep="_").columns == ["a", "s_b", "s_t_c", "s_t_d"]


def test_strict_mode_spares_options_and_payments(docs):
    strict_orders = {r["order_order_no"] for r in FL.order_rows(docs, strict=True).collect()}
    assert "6" not in strict_orders
    opts = {r["order_no"] for r in FL.option_item_rows(docs, strict=True).collect()}
    pays = {r["order_order_no"] for r in FL.payment_rows(docs, strict=True).collect()}
    assert "6" in opts and "6" in pays
    assert "5" not in opts and "5" not in pays      # quarantined everywhere
