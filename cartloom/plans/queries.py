"""Query registry: every operator of the inventory as a query over the driver's
tables, with an equivalent DuckDB SQL oracle.

Each query takes ``(spark, data_dir)`` and returns a DataFrame over whole
tables. Output types are kept to text, integers, doubles, booleans and
``TIMESTAMP_NTZ`` (days are ``yyyy-MM-dd`` text), so both engines hand back the
same values. Money is split in integer cents and only then turned into doubles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.labels import (day_file_name, path_part_from_end, slice_label,
                                      substitute_run_date)
from cartloom.functions.metrics import metric_lines, metric_name, metric_value, read_run_metrics
from cartloom.functions.timefmt import (add_seconds, bad_stamp, day_text, default_run_date,
                                        pacific_text, parse_run_date, parse_utc, run_date_text,
                                        to_pacific, utc_text)
from cartloom.operators import conform as C
from cartloom.operators import flatten as FL
from cartloom.operators import merge as M
from cartloom.operators import quality as Q
from cartloom.operators import slicing as SL
from cartloom.operators.drift import document_keys, key_drift, read_variants
from cartloom.plans import documents as D
from cartloom.plans.pipelines import (backfill_payments, customer_table, extract_day,
                                      merge_day_files, order_tables, run_orders, slice_schemas,
                                      source_totals_of)
from cartloom.schemas import (CUSTOMER_LADDER, DAY_COUNT_LOG_KEYS, ORDER_COLUMNS, ORDER_DOCUMENT,
                              ORDER_LADDER, REQUEST_ECHO)
from cartloom.session import scratch_path, session_key
from cartloom.sources.calendar import day_spine, day_spine_of
from cartloom.sinks.publish import current_markers, published_files, read_published
from cartloom.sources.envelope import (envelope_audit, explode_hits, latest_pages, parse_json_column,
                                       read_envelopes, request_audit)
from cartloom.sources.flatfiles import read_pipe_csv, read_pipe_csv_by_name, write_pipe_csv
from cartloom.sources.search import deep_page, search
from cartloom.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]

# Test parameters: at sf0.01 no hour holds more than 30 events, so the
# service's cap of 200 never refines; cap 3 makes every ladder level occur.
TEST_CAP = 3
OFFSET_PAGE = 25
BACKFILL_FIRST, BACKFILL_LAST = "2024-01-10", "2024-01-26"
SEARCH_LO, SEARCH_HI = "2024-01-10 00:00:00", "2024-01-11 00:00:00"
SEARCH_START = 200
RUN_DAY = "1996-09-17"
#: Conversation turns of one remainder class are taken as lost in landing.
LOST_TURNS = 17

_SPARK: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def spark_queries() -> dict[str, QueryFn]:
    return dict(_SPARK)


def oracle_queries() -> dict[str, str]:
    return dict(_SQL)


# --------------------------------------------------------------------------
# Shared pieces
# --------------------------------------------------------------------------
def _headers(spark, d) -> DataFrame:
    """Order headers (order number, creation and modification stamps) as the
    landed documents carry them; parts of a split order share their header, so
    the distinct over the three columns keeps one row per order."""
    docs = D.landed_order_documents(spark, d)
    return docs.select("order_no", "creation_date", "last_modified").dropDuplicates()


SQL_HEADERS = """
h AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_no, o.o_orderdate AS c, lm.m AS m
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY l_orderkey) lm
    ON lm.l_orderkey = o.o_orderkey)"""

SQL_ITEM_ID = "CAST({a}.l_orderkey AS VARCHAR) || '-' || CAST({a}.l_linenumber AS VARCHAR)"


# --------------------------------------------------------------------------
# Scans (SRC1)
# --------------------------------------------------------------------------
@register("json_scan", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_scan(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", parse_json_column("props", "k INT").getField("k").alias("k"))


@register("hits_explode", """
SELECT conv_id,
       count(*) OVER (PARTITION BY conv_id) AS total,
       count(*) OVER (PARTITION BY conv_id, (rn - 1) // 200) AS count,
       turn, role, text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn
      FROM conversations)
""")
def q_hits_explode(spark, d):
    """Search responses (pages of at most 200 hits) per conversation, landed as
    JSON Lines in the shared folder, scanned back with an explicit schema and
    exploded into rows with their envelope ``total`` and ``count`` (SRC1)."""
    v = Tables(spark, d).conversations
    numbered = SL.row_numbers(v, ["conv_id"], ["turn", "role", "text"], "rn")
    pages = (numbered.withColumn("page", F.floor((F.col("rn") - 1) / 200))
             .groupBy("conv_id", "page")
             .agg(F.count(F.lit(1)).alias("count"),
                  F.collect_list(F.struct(F.struct("turn", "role", "text").alias("data")))
                  .alias("hits")))
    totals = v.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    envelopes = pages.join(totals, "conv_id").select("conv_id", "total", "count", "hits")
    path = scratch_path(spark, "conversation-responses")
    envelopes.write.json(path)
    landed = read_envelopes(spark, path, envelopes.schema).drop("source_file")
    return explode_hits(landed, keep=("conv_id", "total", "count"))


@register("envelope_audit", f"""
WITH p AS (SELECT conv_id, turn % {LOST_TURNS} = 5 AS lost,
                  (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // 200 AS page
           FROM conversations)
SELECT conv_id, CAST(count(DISTINCT page) AS BIGINT) AS n_responses, CAST(0 AS BIGINT) AS n_corrupt,
       count(*) AS expected, count(*) FILTER (WHERE NOT coalesce(lost, false)) AS landed,
       count(*) FILTER (WHERE lost) = 0 AS whole
FROM p GROUP BY conv_id
""")
def q_envelope_audit(spark, d):
    """Whether the landed responses of every conversation hold the hits that the service
    reports (AGG1); turns of one remainder class are taken as lost."""
    v = Tables(spark, d).conversations
    numbered = SL.row_numbers(v, ["conv_id"], ["turn", "role", "text"], "rn")
    lost = F.coalesce(F.col("turn") % LOST_TURNS == 5, F.lit(False))
    pages = (numbered.withColumn("start", F.floor((F.col("rn") - 1) / 200) * 200)
             .groupBy("conv_id", "start").agg(F.collect_list(F.when(~lost, F.struct(
                 F.struct("turn", "role").alias("data")))).alias("hits")))
    totals = v.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    return envelope_audit(pages.join(totals, "conv_id"), by=("conv_id",))


#: Requests of the conversations: pages of so many turns; the second page is lost for one
#: remainder class and landed late for a part of it, the first one landed twice for another.
REQUEST_PAGE, LOST_PAGE_OF, LATE_PAGE_OF, TWICE_OF = 2, 17, 34, 5


def _landed_requests(spark, d) -> DataFrame:
    """Conversations landed as the pages of one request each, in two landings."""
    v = Tables(spark, d).conversations
    numbered = SL.row_numbers(v, ["conv_id"], ["turn", "role", "text"], "rn")
    page = F.floor((F.col("rn") - 1) / REQUEST_PAGE).cast("bigint")
    pages = (numbered.groupBy("conv_id", page.alias("page"))
             .agg(F.count(F.lit(1)).alias("count"), F.collect_list(F.struct(F.struct("turn", "role", "text").alias("data"))).alias("hits")))
    totals = v.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    span = F.struct(F.lit("conversation").alias("field"), F.col("conv_id").cast("string").alias("from"), F.col("conv_id").cast("string").alias("to"))
    query = F.struct(F.struct(F.struct(span.alias("range_filter")).alias("filter")).alias("filtered_query"))
    responses = pages.join(totals, "conv_id").select(
        "conv_id", "page", "total", "count", (F.col("page") * REQUEST_PAGE).alias("start"), query.alias("query"), "hits")
    lost = (F.col("page") == 1) & (F.col("conv_id") % LOST_PAGE_OF == 5)
    late = (lost & (F.col("conv_id") % LATE_PAGE_OF == 5)) | ((F.col("page") == 0) & (F.col("conv_id") % TWICE_OF == 2))
    path = scratch_path(spark, "conversation-requests")
    for name, rows in (("first", responses.filter(~lost)), ("second", responses.filter(late))):
        rows.drop("conv_id", "page").write.json(f"{path}/{name}")
    schema = T.StructType([f for f in responses.schema.fields if f.name in ("total", "count", "start", "hits")]
                          + [T.StructField("query", REQUEST_ECHO)])
    return read_envelopes(spark, f"{path}/*", schema)


SQL_REQUESTS = f"""
WITH p AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) // {REQUEST_PAGE} AS page
           FROM conversations),
k AS (SELECT * FROM p WHERE NOT (page = 1 AND conv_id % {LOST_PAGE_OF} = 5 AND conv_id % {LATE_PAGE_OF} <> 5))"""


@register("request_audit", SQL_REQUESTS + f""",
t AS (SELECT conv_id, count(*) AS expected, max(page) AS pages FROM p GROUP BY conv_id),
l AS (SELECT conv_id, count(DISTINCT page) AS n_pages, count(*) AS landed FROM k GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS conversation, n_pages,
       CASE WHEN conv_id % {TWICE_OF} = 2 THEN 1 ELSE 0 END
         + CAST(0 AS BIGINT) AS n_repeats, expected, landed,
       CAST(CASE WHEN landed < expected THEN 2 ELSE 0 END AS BIGINT) AS n_breaks, landed = expected AS whole
FROM t JOIN l USING (conv_id)
""")
def q_request_audit(spark, d):
    """Completeness of every request over its landed files: contiguous offsets, the last
    landing of a page counts (SRC1, AGG1)."""
    audit = request_audit(_landed_requests(spark, d))
    return audit.select(F.split("request", " ")[1].alias("conversation"), "n_pages", "n_repeats", "expected", "landed",
                        "n_breaks", "whole")


@register("request_hits", SQL_REQUESTS + """
SELECT turn, role, text FROM k
""")
def q_request_hits(spark, d):
    """Hits of the last landing of every page (SRC1)."""
    return explode_hits(latest_pages(_landed_requests(spark, d)), keep=())


# --------------------------------------------------------------------------
# Flatten family (PRJ1, PRJ2, PRJ10, JON1-JON4, FUN12, FUN13)
# --------------------------------------------------------------------------
@register("flatten_prefix", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_order_no,
       o.o_orderstatus AS order_status,
       'customer_info' AS order_customer_info__type,
       CAST(o.o_custkey AS VARCHAR) AS order_customer_info_customer_id,
       lpad(CAST(o.o_custkey AS VARCHAR), 8, '0') AS order_customer_info_customer_no,
       c.c_name AS order_customer_info_customer_name,
       c.c_mktsegment AS order_customer_info_segment,
       n.n_nationkey AS order_customer_info_nation_key,
       n.n_name AS order_customer_info_nation_name
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_flatten_prefix(spark, d):
    """Order with a nested ``customer_info`` (itself holding a ``nation`` struct)
    flattened to prefixed names; ``_`` separates levels here, ``.`` in files."""
    t = Tables(spark, d)
    cust = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    cid = F.col("o_custkey").cast("string")
    info = F.struct(F.lit("customer_info").alias("_type"), cid.alias("customer_id"),
                    F.lpad(cid, 8, "0").alias("customer_no"), F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
                    .alias("nation"))
    docs = t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        D.order_no().alias("order_no"), F.col("o_orderstatus").alias("status"),
        info.alias("customer_info"))
    return FL.flatten(docs, prefix="order_", sep="_")


PRODUCT_QUERY_COLS = [
    "order_order_no", "product_item_item_id", "product_item_product_id",
    "product_item_product_name", "product_item_quantity", "product_item_price",
    "product_item_price_after_item_discount", "product_item_tax", "product_item_shipment_id",
    "product_item_c_Type", "product_item_c_isBackorder"]


def _docs(spark, d) -> DataFrame:
    """Order documents of ``d`` (landed once per session, then read)."""
    return D.landed_order_documents(spark, d)


def _product_rows(spark, d) -> DataFrame:
    return FL.product_rows(_docs(spark, d), sep="_")


@register("order_product_lines", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_order_no,
       {SQL_ITEM_ID.format(a='l')} AS product_item_item_id,
       CAST(l.l_partkey AS VARCHAR) AS product_item_product_id,
       'Part#' || CAST(l.l_partkey AS VARCHAR) AS product_item_product_name,
       l.l_quantity AS product_item_quantity,
       l.l_extendedprice AS product_item_price,
       l.l_extendedprice * (1 - l.l_discount) AS product_item_price_after_item_discount,
       l.l_tax AS product_item_tax,
       'S' || CAST(l.l_suppkey % 3 AS VARCHAR) AS product_item_shipment_id,
       l.l_returnflag AS product_item_c_Type,
       (l.l_linestatus = 'O') AS product_item_c_isBackorder
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_order_product_lines(spark, d):
    """Product-line table: ``explode_outer(product_items)``, a null row for an
    order without lines (JON4)."""
    return _product_rows(spark, d).select(*PRODUCT_QUERY_COLS)


@register("order_entity_product", """
WITH g AS (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey % 3) AS n_ship,
                  min(l_suppkey % 3) AS g0
           FROM lineitem GROUP BY l_orderkey),
a AS (SELECT l.l_orderkey, count(*) AS n_adj
      FROM lineitem l JOIN g ON g.l_orderkey = l.l_orderkey AND l.l_suppkey % 3 = g.g0
      WHERE l.l_discount > 0.05 GROUP BY l.l_orderkey)
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_no,
       CAST(2 * greatest(1, coalesce(g.n_ship, 0)) * greatest(1, coalesce(g.n_ship, 0))
              * greatest(1, coalesce(a.n_adj, 0)) * greatest(1, coalesce(g.n_lines, 0))
            AS BIGINT) AS n_rows
FROM orders o
LEFT JOIN g ON g.l_orderkey = o.o_orderkey
LEFT JOIN a ON a.l_orderkey = o.o_orderkey
""")
def q_order_entity_product(spark, d):
    """Rows per order of the full product payments x shipments x shipping items x
    first-item adjustments x products (JON1), from the array sizes: the product
    itself is never materialised."""
    return FL.entity_product_size(_docs(spark, d))


@register("entity_product_slice", """
WITH o AS (SELECT * FROM orders),
l AS (SELECT l.*, l_suppkey % 3 AS g FROM lineitem l JOIN o ON o.o_orderkey = l.l_orderkey),
g AS (SELECT DISTINCT l_orderkey, 'S' || CAST(g AS VARCHAR) AS ship, 'SI' || CAST(g AS VARCHAR) AS item
      FROM l),
adj AS (SELECT l.l_orderkey, CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
               || '-' || CAST(l_partkey AS VARCHAR) AS adj
        FROM l JOIN (SELECT l_orderkey, min(g) AS g FROM l GROUP BY 1) f
          ON f.l_orderkey = l.l_orderkey AND f.g = l.g
        WHERE l_discount > 0.05)
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_no,
       CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(p.i AS VARCHAR) AS payment,
       coalesce(s.ship, 'S0') AS shipment, coalesce(t.item, 'SI0') AS shipping_item,
       adj.adj AS price_adjustment,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS product_item
FROM o CROSS JOIN (SELECT unnest([1, 2]) AS i) p
LEFT JOIN g s ON s.l_orderkey = o.o_orderkey
LEFT JOIN g t ON t.l_orderkey = o.o_orderkey
LEFT JOIN adj ON adj.l_orderkey = o.o_orderkey
LEFT JOIN l ON l.l_orderkey = o.o_orderkey
""")
def q_entity_product_slice(spark, d):
    """The full product payments x shipments x shipping items x first-item adjustments x
    products, built for every order (JON1)."""
    rows = FL.entity_product(_docs(spark, d))
    return rows.select("order_no", F.col("payment.payment_instrument_id").alias("payment"),
                       F.col("shipment.shipment_id").alias("shipment"),
                       F.col("shipping_item.item_id").alias("shipping_item"),
                       F.col("price_adjustment.price_adjustment_id").alias("price_adjustment"),
                       F.col("product_item.item_id").alias("product_item"))


SQL_FIRST_ADJ = """
WITH g AS (SELECT l_orderkey, min(l_suppkey % 3) AS g0 FROM lineitem GROUP BY l_orderkey),
adj AS (SELECT l.* FROM lineitem l
        JOIN g ON g.l_orderkey = l.l_orderkey AND l.l_suppkey % 3 = g.g0
        WHERE l.l_discount > 0.05)
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_order_no,
       CASE WHEN a.l_orderkey IS NOT NULL THEN 'price_adjustment' END AS price_adjustments__type,
       CAST(a.l_orderkey AS VARCHAR) || '-' || CAST(a.l_linenumber AS VARCHAR) || '-'
         || CAST(a.l_partkey AS VARCHAR) AS price_adjustments_price_adjustment_id,
       'PROMO-' || CAST(CAST(round(a.l_discount * 100) AS INTEGER) AS VARCHAR)
         AS price_adjustments_promotion_id,
       -(a.l_extendedprice * a.l_discount) AS price_adjustments_price,
       CASE WHEN a.l_orderkey IS NOT NULL THEN 'line discount' END AS price_adjustments_item_text,
       CASE WHEN a.l_orderkey IS NOT NULL THEN 'discount' END
         AS price_adjustments_applied_discount__type,
       a.l_discount AS price_adjustments_applied_discount_amount,
       CASE WHEN a.l_orderkey IS NOT NULL THEN 'percentage' END
         AS price_adjustments_applied_discount_type
FROM orders o LEFT JOIN adj a ON a.l_orderkey = o.o_orderkey
"""


@register("first_item_adjustments", SQL_FIRST_ADJ)
def q_first_item_adjustments(spark, d):
    """Adjustments of the first shipping item only, one null row when it has none
    (JON3); nested ``applied_discount`` flattened too."""
    return FL.first_item_adjustments(_docs(spark, d), sep="_")


OPTION_QUERY_COLS = [
    "order_no", "product_items_product_id", "product_item_item_id", "option_items__type",
    "option_items_item_id", "option_items_option_id", "option_items_option_value_id",
    "option_items_price", "option_items_product_id", "option_items_quantity",
    "option_items_tax_basis", "option_items_c_OptionType"]


@register("option_items", f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS order_no,
       CAST(l.l_partkey AS VARCHAR) AS product_items_product_id,
       {SQL_ITEM_ID.format(a='l')} AS product_item_item_id,
       'option_item' AS option_items__type,
       {SQL_ITEM_ID.format(a='l')} || '-' || CAST(s.i AS VARCHAR) AS option_items_item_id,
       'opt-' || CAST(s.i AS VARCHAR) AS option_items_option_id,
       'val-' || CAST(l.l_partkey AS VARCHAR) AS option_items_option_value_id,
       l.l_tax * s.i AS option_items_price,
       CAST(l.l_partkey AS VARCHAR) || '-' || CAST(s.i AS VARCHAR) AS option_items_product_id,
       CAST(1.0 AS DOUBLE) AS option_items_quantity,
       CAST(CAST(l.l_linenumber * 100 AS DOUBLE) AS VARCHAR) AS option_items_tax_basis,
       'option' AS option_items_c_OptionType
FROM lineitem l,
     LATERAL (SELECT unnest(generate_series(1, l.l_linenumber % 3 + 1)) AS i) s
WHERE l.l_discount > 0.05
""")
def q_option_items(spark, d):
    """Two-level explode product_items -> option_items with parent keys (FUN13)."""
    return FL.option_item_rows(_docs(spark, d), sep="_").select(*OPTION_QUERY_COLS)


SQL_PAYMENTS = """
WITH o AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS order_order_no,
       CAST(o_orderkey AS VARCHAR) || '-1' AS payment_inst_payment_instrument_id,
       CAST(cents - cents // 4 AS DOUBLE) / 100 AS payment_inst_amount,
       'CREDIT_CARD' AS payment_inst_payment_method_id,
       CAST(o_custkey AS VARCHAR) AS payment_inst_c_customerProfileId,
       'VISA' AS payment_inst_payment_card_card_type,
       '************' || lpad(right(CAST(o_custkey AS VARCHAR), 4), 4, '0')
         AS payment_inst_payment_card_masked_number,
       CAST(NULL AS VARCHAR) AS payment_inst_masked_gift_certificate_code,
       'payments_data.csv' AS file_name
FROM o
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR) || '-2',
       CAST(cents // 4 AS DOUBLE) / 100, 'GIFT_CERTIFICATE', CAST(o_custkey AS VARCHAR),
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       '********' || lpad(right(CAST(o_orderkey AS VARCHAR), 4), 4, '0'), 'payments_data.csv'
FROM o
"""


@register("payment_details", SQL_PAYMENTS)
def q_payment_details(spark, d):
    """Payment instruments: order x instruments, distinct (JON2)."""
    return FL.payment_rows(_docs(spark, d), sep="_", file_name=F.lit("payments_data.csv"))


@register("array_to_json", """
WITH opts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, s.i,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS item
  FROM lineitem, LATERAL (SELECT unnest(generate_series(1, l_linenumber % 3 + 1)) AS i) s),
js AS (
  SELECT item, l_partkey, l_discount, '[' || string_agg(
           '{"item_id":"' || item || '-' || CAST(i AS VARCHAR) || '","option_id":"opt-'
           || CAST(i AS VARCHAR) || '","option_value_id":"val-' || CAST(l_partkey AS VARCHAR)
           || '"}', ',' ORDER BY i) || ']' AS doc, count(*) AS n
  FROM (SELECT DISTINCT item, l_partkey, l_discount, i FROM opts) GROUP BY ALL)
SELECT CAST(l.l_orderkey AS VARCHAR) AS order_no, js.item AS item_id,
       CASE WHEN l.l_discount > 0.05 THEN js.n ELSE 0 END AS n_options,
       CASE WHEN l.l_discount > 0.05 THEN js.doc END AS options_json
FROM lineitem l JOIN js
  ON js.item = CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
 AND js.l_partkey = l.l_partkey AND js.l_discount = l.l_discount
""")
def q_array_to_json(spark, d):
    """Array column written as JSON text (FUN12): the option list of every product
    line, as the product files carry it."""
    lines = _docs(spark, d).select("order_no", F.explode("product_items").alias("p"))
    slim = F.transform("p.option_items", lambda o: F.struct(
        o.getField("item_id").alias("item_id"), o.getField("option_id").alias("option_id"),
        o.getField("option_value_id").alias("option_value_id")))
    return lines.select(
        "order_no", F.col("p.item_id").alias("item_id"),
        F.coalesce(F.size("p.option_items"), F.lit(0)).cast("bigint").alias("n_options"),
        FL.array_as_json(slim).alias("options_json"))


# --------------------------------------------------------------------------
# Conform family (PRJ3-PRJ9, FUN1)
# --------------------------------------------------------------------------
@register("conform_columns", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_order_no,
       CAST(NULL AS VARCHAR) AS order_currency,
       o_orderstatus AS order_status,
       CAST(NULL AS DOUBLE) AS order_c_ATTax,
       o_totalprice AS order_order_total,
       o_orderdate AS order_creation_date,
       'orders_data_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_name
FROM orders
""")
def q_conform_columns(spark, d):
    """Fixed ordered column list: absent names become typed nulls, extra ones are
    dropped (PRJ5); lineage column (PRJ6)."""
    o = Tables(spark, d).orders
    flat = o.select(D.order_no().alias("order_order_no"),
                    F.col("o_totalprice").alias("order_order_total"),
                    F.col("o_orderstatus").alias("order_status"),
                    F.col("o_orderdate").alias("order_creation_date"),
                    F.col("o_orderpriority").alias("order_priority"),
                    day_file_name("orders", run_date_text("o_orderdate")).alias("file_name"))
    return C.conform(flat, ["order_order_no", "order_currency", "order_status", "order_c_ATTax",
                            "order_order_total", "order_creation_date", "file_name"],
                     {"order_c_ATTax": T.DoubleType()})


SQL_CUSTOMER_EMAIL = ("CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'customer' || "
                      "CAST(c_custkey AS VARCHAR) || '@example.com' END")


@register("drop_and_mask", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_no,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS company_name,
       sha256({SQL_CUSTOMER_EMAIL}) AS customer_emails,
       sha256(coalesce({SQL_CUSTOMER_EMAIL}, 'nan')) AS customer_emails_compat
FROM customer
""")
def q_drop_and_mask(spark, d):
    """Hash the e-mail (null stays null; compat hashes 'nan'), drop personal
    fields, absent ones ignored (FUN1, PRJ3)."""
    docs = D.customer_documents(Tables(spark, d).customer)
    masked = docs.withColumn("customer_emails_compat", C.ref("email"))
    masked = C.mask_column(masked, "customer_emails_compat", "customer_emails_compat", compat=True,
                           drop_source=False)
    masked = C.mask_column(masked, "email", "customer_emails")
    masked = C.drop_columns(masked, ["first_name", "last_name", "phone_home", "phone_mobile",
                                     "birthday", "gender", "c_pointsBalance", "segment"])
    return masked.select("customer_id", "customer_no", "company_name", "customer_emails",
                         "customer_emails_compat")


@register("default_fill", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, '') AS company_name,
       coalesce(CASE WHEN c_mktsegment <> 'FURNITURE'
                     THEN lpad(CAST(c_nationkey * 1000 + 7 AS VARCHAR), 10, '0') END, '')
         AS phone_home,
       coalesce({SQL_CUSTOMER_EMAIL}, '') AS email,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey % 3 AS INTEGER) END AS gender,
       coalesce(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END, CAST('NaN' AS DOUBLE))
         AS c_pointsBalance
FROM customer
""")
def q_default_fill(spark, d):
    """Defaults for absent keys: text '', gender stays null, numbers NaN (PRJ9)."""
    docs = D.customer_documents(Tables(spark, d).customer)
    filled = C.fill_defaults(docs, {"company_name": "", "phone_home": "", "email": "",
                                    "gender": None, "c_pointsBalance": float("nan")})
    return filled.select("customer_id", "company_name", "phone_home", "email", "gender",
                         "c_pointsBalance")


@register("override_column", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_order_no,
       {SQL_ITEM_ID.format(a='l')} AS product_item_item_id,
       'NAN' AS product_item_c_personalizationJson
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_override_column(spark, d):
    """Drop a column that must exist and set it to the constant 'NAN' (PRJ4, PRJ7)."""
    rows = C.override_constant(_product_rows(spark, d), "product_item_c_personalizationJson")
    return rows.select("order_order_no", "product_item_item_id",
                       "product_item_c_personalizationJson")


@register("dropna_key", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_order_no,
       {SQL_ITEM_ID.format(a='l')} AS product_item_item_id,
       CAST(l.l_partkey AS VARCHAR) AS product_item_product_id
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_dropna_key(spark, d):
    """Product lines without a product id (orders without lines) are dropped (FLT3)."""
    rows = M.drop_missing_key(_product_rows(spark, d), "product_item_product_id")
    return rows.select("order_order_no", "product_item_item_id", "product_item_product_id")


# --------------------------------------------------------------------------
# Merge family (SET1, SET2, AGG5, AGG6)
# --------------------------------------------------------------------------
@register("union_by_name", """
SELECT event_id, ts, user_id, value, CAST(NULL AS VARCHAR) AS event_type,
       CAST(NULL AS VARCHAR) AS props
FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, ts, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), event_type, props
FROM events WHERE NOT coalesce(event_type IN ('click', 'view'), false)
""")
def q_union_by_name(spark, d):
    """Two slice shapes with different columns, unioned by name (SET1)."""
    e = Tables(spark, d).events
    is_a = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    a = e.filter(is_a).select("event_id", "ts", "user_id", "value")
    b = e.filter(~is_a).select("event_id", "ts", "event_type", "props")
    return M.union_by_name(a, b)


@register("union_files", """
SELECT event_id, ts, user_id, value, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS VARCHAR) AS props,
       CAST(NULL AS VARCHAR) AS edition FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, ts, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), event_type, props, NULL
FROM events WHERE event_type NOT IN ('click', 'view') AND event_id % 3 <> 0
UNION ALL
SELECT event_id, ts, user_id, CAST(NULL AS DOUBLE), event_type, CAST(NULL AS VARCHAR), 'second'
FROM events WHERE event_type NOT IN ('click', 'view') AND event_id % 3 = 0
""")
def q_union_files(spark, d):
    """Slice files of three layouts in one folder (columns reordered, absent and new), united
    by name with typed nulls (SET1, SRC3)."""
    e = Tables(spark, d).events
    first, third = F.col("event_type").isin("click", "view"), F.col("event_id") % 3 == 0
    path = scratch_path(spark, "union-files")
    write_pipe_csv(e.filter(first).select("event_id", "ts", "user_id", "value"), f"{path}/a")
    write_pipe_csv(e.filter(~first & ~third).select("props", "event_type", "ts", "event_id"), f"{path}/b")
    write_pipe_csv(e.filter(~first & third).select("event_id", "user_id", F.lit("second").alias("edition"), "event_type", "ts"), f"{path}/c")
    return read_pipe_csv_by_name(spark, path, e.schema)


LINE_COLS = ", ".join(D.LINE_COLS)


@register("dedup_all", f"""
SELECT DISTINCT {LINE_COLS} FROM lineitem
""")
def q_dedup_all(spark, d):
    """Every slice fetched twice, merged, distinct over all columns (AGG5)."""
    line = Tables(spark, d).lineitem.select(*D.LINE_COLS)
    return M.dedup_all(M.union_by_name(line, line))


@register("dedup_subset", f"""
SELECT {LINE_COLS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem)
WHERE rn = 1
""")
def q_dedup_subset(spark, d):
    """One row per (orderkey, linenumber), the first by all other columns (AGG6)."""
    line = Tables(spark, d).lineitem.select(*D.LINE_COLS)
    return M.dedup_first(line, ["l_orderkey", "l_linenumber"])


@register("change_union", f"""
WITH {SQL_HEADERS}
SELECT strftime(CAST(c AS DATE), '%Y-%m-%d') AS run_date, order_no, c AS creation_date,
       m AS last_modified FROM h
UNION
SELECT strftime(CAST(m AS DATE), '%Y-%m-%d'), order_no, c, m FROM h WHERE m IS NOT NULL
""")
def q_change_union(spark, d):
    """Created on D union modified on D, distinct, for every day (SET2)."""
    feed = M.change_feed(_headers(spark, d), "creation_date", "last_modified")
    return feed.select(day_text("run_date").alias("run_date"), "order_no", "creation_date",
                       "last_modified")


@register("csv_roundtrip", """
SELECT doc_id, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS doc_no, nullif(text, '') AS text, source,
       n_chars
FROM documents
""")
def q_csv_roundtrip(spark, d):
    """Write ``|`` files with header, scan them back with an explicit schema: numbers kept
    as text keep their leading zeros, texts their line breaks, quotes and separators
    (SNK1/SRC3/SRC4/SRC5)."""
    t = Tables(spark, d).documents
    flat = t.select("doc_id", F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("doc_no"), "text",
                    "source", "n_chars")
    path = scratch_path(spark, "csv-roundtrip")
    write_pipe_csv(flat, path)
    return read_pipe_csv(spark, path, flat.schema)


# --------------------------------------------------------------------------
# Time family (FUN2-FUN7, SRC6, SRC7)
# --------------------------------------------------------------------------
SQL_PST = "(ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific'"


@register("parse_stamps", """
SELECT event_id, CASE WHEN event_id % 101 = 7 THEN NULL ELSE date_trunc('millisecond', ts) END AS ts,
       event_id % 101 = 7 AS bad
FROM events
""")
def q_parse_stamps(spark, d):
    """Stamp text with ``Z``, offsets or no zone parsed to UTC; malformed text becomes null
    and is marked (FUN3)."""
    e = Tables(spark, d).events
    zones = [("Z", 0), ("+00:00", 0), ("-07:00", -25200), ("+0530", 19800), ("", 0)]
    kind = F.pmod("event_id", F.lit(len(zones)))
    text = F.lit(None).cast("string")
    for i, (suffix, seconds) in enumerate(zones):
        local = F.date_format(add_seconds("ts", seconds), "yyyy-MM-dd'T'HH:mm:ss.SSS")
        text = F.when(kind == i, F.concat(local, F.lit(suffix))).otherwise(text)
    text = F.when(F.col("event_id") % 101 == 7, F.lit("2024-13-45T99:00:00Z")).otherwise(text)
    landed = e.select("event_id", text.alias("stamp"))
    return landed.select("event_id", parse_utc("stamp").alias("ts"), bad_stamp("stamp").alias("bad"))


@register("default_day", """
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS as_of,
       strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS run_date
FROM events
""")
def q_default_day(spark, d):
    """The day a job loads when it starts on a day and none is given: the day before (SRC7)."""
    days = Tables(spark, d).events.select(day_text("ts").alias("as_of")).distinct()
    return days.select("as_of", run_date_text(default_run_date("as_of")).alias("run_date"))


@register("tz_convert", f"""
SELECT event_id, ts, {SQL_PST} AS ts_pst FROM events
""")
def q_tz_convert(spark, d):
    """UTC -> US Pacific wall clock with DST (FUN4)."""
    e = Tables(spark, d).events
    return e.select("event_id", "ts", to_pacific("ts").alias("ts_pst"))


@register("tz_offset_text", f"""
WITH x AS (SELECT event_id, ts, {SQL_PST} AS p FROM events),
y AS (SELECT *, date_diff('minute', ts, p) AS off FROM x)
SELECT event_id,
       strftime(p, '%Y-%m-%d %H:%M:%S')
       || CASE WHEN microsecond(p) % 1000000 <> 0
               THEN '.' || lpad(CAST(microsecond(p) % 1000000 AS VARCHAR), 6, '0') ELSE '' END
       || CASE WHEN off < 0 THEN '-' ELSE '+' END
       || lpad(CAST(abs(off) // 60 AS VARCHAR), 2, '0') || ':'
       || lpad(CAST(abs(off) % 60 AS VARCHAR), 2, '0') AS ts_pst_text
FROM y
""")
def q_tz_offset_text(spark, d):
    """Pacific time printed with its UTC offset, as in the published files (FUN5)."""
    e = Tables(spark, d).events
    return e.select("event_id", pacific_text("ts").alias("ts_pst_text"))


@register("run_date_forms", """
SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS run_date,
       strftime(o_orderdate, '%Y-%m-%d') AS day,
       strftime(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS parsed_day
FROM orders
""")
def q_run_date_forms(spark, d):
    """Run dates as ``yyyyMMdd`` and ``yyyy-MM-dd``, and parsed back (FUN2)."""
    o = Tables(spark, d).orders
    days = o.select(run_date_text("o_orderdate").alias("run_date"),
                    day_text("o_orderdate").alias("day")).distinct()
    return days.withColumn("parsed_day", day_text(parse_run_date("run_date")))


@register("backfill_days", f"""
SELECT strftime(s.d, '%Y-%m-%d') AS day, CAST(coalesce(c.n, 0) AS BIGINT) AS n_events
FROM (SELECT CAST(unnest(generate_series(DATE '{BACKFILL_FIRST}', DATE '{BACKFILL_LAST}',
                                         INTERVAL 1 DAY)) AS DATE) AS d) s
LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) c ON c.d = s.d
""")
def q_backfill_days(spark, d):
    """All days of a closed backfill range in one job, empty days included (SRC6)."""
    e = Tables(spark, d).events
    spine = day_spine(spark, BACKFILL_FIRST, BACKFILL_LAST)
    lo = F.lit(BACKFILL_FIRST).cast("timestamp_ntz")
    hi = F.date_add(F.lit(BACKFILL_LAST).cast("date"), 1).cast("timestamp_ntz")
    counts = (e.filter((F.col("ts") >= lo) & (F.col("ts") < hi))
              .groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    return spine.join(counts, "day", "left").select(
        day_text("day").alias("day"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_events"))


SQL_BUCKETS = """
WITH s AS (SELECT DISTINCT time_bucket(INTERVAL '15 minutes', ts) AS slice_start FROM events),
e AS (SELECT slice_start,
             CASE WHEN strftime(slice_start, '%H:%M:%S') = '23:45:00'
                  THEN slice_start + INTERVAL 899 SECOND
                  ELSE slice_start + INTERVAL 900 SECOND END AS slice_end FROM s),
p AS (SELECT *, CAST(floor(date_diff('second', slice_start, slice_end) / 300) AS INTEGER)
                AS n_parts FROM e)
SELECT slice_start, slice_end, n_parts, CAST(g.part_no AS INTEGER) AS part_no,
       slice_start + to_seconds(g.part_no * 300) AS part_start,
       slice_start + to_seconds((g.part_no + 1) * 300) AS part_end
FROM p, LATERAL (SELECT unnest(generate_series(0, n_parts - 1)) AS part_no) g
"""


@register("sub_slices", SQL_BUCKETS)
def q_sub_slices(spark, d):
    """Non-empty 15-min slices on the reference's closed grid (last one ends
    23:59:59) cut into ``int(span / 300)`` parts: the last slice loses its tail
    (FUN7, N3)."""
    e = Tables(spark, d).events
    s = SL.fixed_slices(e, "ts", 900).select("slice_start")
    last = F.date_format("slice_start", "HH:mm:ss") == F.lit("23:45:00")
    spans = s.withColumn("slice_end", F.when(last, add_seconds("slice_start", 899))
                         .otherwise(add_seconds("slice_start", 900)))
    return SL.sub_slices(spans, "slice_start", "slice_end", 300)


# --------------------------------------------------------------------------
# Slicing family (WIN1-WIN7, SRT1-SRT4, FLT1, FLT2, FLT8)
# --------------------------------------------------------------------------
def _sql_fixed(width: int) -> str:
    return f"""
SELECT time_bucket(INTERVAL '{width} seconds', ts) AS slice_start,
       time_bucket(INTERVAL '{width} seconds', ts) + INTERVAL {width} SECOND AS slice_end,
       count(*) AS n
FROM events GROUP BY 1
"""


@register("slice_fixed", _sql_fixed(900))
def q_slice_fixed(spark, d):
    """Non-empty 15-min slices with counts (WIN1, FLT8)."""
    return SL.fixed_slices(Tables(spark, d).events, "ts", 900)


@register("slice_fixed_hour", _sql_fixed(3600))
def q_slice_fixed_hour(spark, d):
    """Non-empty 1-h slices with counts (WIN2, FLT8)."""
    return SL.fixed_slices(Tables(spark, d).events, "ts", 3600)


def sql_adaptive(ladder, cap: int, by: str | None = None) -> str:
    """Oracle for adaptive slicing: one ``sum() over`` per ladder level (and per
    ``by`` group when given)."""
    k = len(ladder)
    g = f"{by}, " if by else ""
    parents = ",\n       ".join(
        f"time_bucket(INTERVAL '{w} seconds', sec) AS p{i}" for i, w in enumerate(ladder))
    sums = ",\n       ".join(f"sum(n) OVER (PARTITION BY {g}p{i}) AS c{i}" for i in range(k))
    cases = " ".join(f"WHEN c{i} < {cap} THEN {i}" for i in range(k - 1))
    widths = "[" + ", ".join(str(w) for w in ladder) + "]"
    plist = "[" + ", ".join(f"p{i}" for i in range(k)) + "]"
    return f"""
WITH s AS (SELECT {g}date_trunc('second', ts) AS sec, count(*) AS n FROM events
           GROUP BY {g}date_trunc('second', ts)),
p AS (SELECT {g}sec, n,
       {parents} FROM s),
c AS (SELECT *,
       {sums} FROM p),
l AS (SELECT *, CASE {cases} ELSE {k - 1} END AS lvl FROM c)
SELECT {g}CAST({widths}[lvl + 1] AS INTEGER) AS level_seconds,
       {plist}[lvl + 1] AS slice_start,
       {plist}[lvl + 1] + to_seconds({widths}[lvl + 1]) AS slice_end,
       CAST(sum(n) AS BIGINT) AS n
FROM l GROUP BY ALL
"""


@register("slice_adaptive_orders", sql_adaptive(ORDER_LADDER, TEST_CAP))
def q_slice_adaptive_orders(spark, d):
    """Refinement 15 min -> 5 min -> 1 min -> 1 s while a slice holds >= cap (WIN3)."""
    s = SL.adaptive_slices(Tables(spark, d).events, "ts", ORDER_LADDER, cap=TEST_CAP)
    return s.select("level_seconds", "slice_start", "slice_end", "n")


@register("slice_adaptive_customers", sql_adaptive(CUSTOMER_LADDER, TEST_CAP))
def q_slice_adaptive_customers(spark, d):
    """Refinement 1 h -> 30 min -> 15 min -> 5 min -> 1 min -> 1 s (WIN4)."""
    s = SL.adaptive_slices(Tables(spark, d).events, "ts", CUSTOMER_LADDER, cap=TEST_CAP)
    return s.select("level_seconds", "slice_start", "slice_end", "n")


@register("page_offsets", f"""
SELECT u.user_id, u.n_events, CAST(g.start // {OFFSET_PAGE} AS BIGINT) AS page_no,
       CAST(g.start AS BIGINT) AS start
FROM (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) u,
     LATERAL (SELECT unnest(generate_series(0, u.n_events - 1, {OFFSET_PAGE})) AS start) g
""")
def q_page_offsets(spark, d):
    """Page offsets 0, p, 2p, ... below each user's event count (WIN5)."""
    e = Tables(spark, d).events
    n = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return SL.page_offsets(n, "n_events", OFFSET_PAGE, keep=["user_id"])


@register("page_assign", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
       CAST((row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) - 1) // 200
            AS BIGINT) AS page_no,
       CAST(((row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) - 1) // 200)
            * 200 AS BIGINT) AS page_start
FROM events
""")
def q_page_assign(spark, d):
    """Page number of every record within its day, 200 per page (WIN6)."""
    e = Tables(spark, d).events.select("event_id", "ts", day_text("ts").alias("day"))
    paged = SL.assign_pages(e, ["day"], ["ts", "event_id"], 200)
    return paged.select("event_id", "day", "page_no", "page_start")


@register("page_cap", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, ts,
       row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 200 AS in_page
FROM events
""")
def q_page_cap(spark, d):
    """Whether a day's first request (200 records in sort order) returns a record (WIN7,
    SRT3); the others are kept and marked, for the next pages."""
    e = Tables(spark, d).events.select("event_id", day_text("ts").alias("day"), "ts")
    paged = SL.assign_pages(e, ["day"], ["ts", "event_id"], 200)
    return paged.select("event_id", "day", "ts", (F.col("page_no") == 0).alias("in_page"))


@register("page_first", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, ts FROM events
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 20
""")
def q_page_first(spark, d):
    """The first 20 records of every day: a group limit before the exchange (WIN7, SRT3)."""
    e = Tables(spark, d).events.select("event_id", day_text("ts").alias("day"), "ts")
    return SL.cap_per_group(e, ["day"], ["ts", "event_id"], 20)


@register("search_deep", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)
WHERE rn > total * 9 // 10 AND rn <= total * 9 // 10 + 200
""")
def q_search_deep(spark, d):
    """A page of 200 at nine tenths of all events, found by counts of ranges (SRC2, SRT4)."""
    e = Tables(spark, d).events
    return deep_page(e, ["ts", "event_id"], e.count() * 9 // 10, 200)


@register("search_all", """
SELECT *, (SELECT count(*) FROM events) AS total FROM events ORDER BY ts, event_id LIMIT 200
""")
def q_search_all(spark, d):
    """A match-all search: first page of 200 in sort order, and the total (FLT2)."""
    return search(Tables(spark, d).events, None, sort=("ts", "event_id"), count=200)


@register("search_page", f"""
SELECT *, (SELECT count(*) FROM events
           WHERE ts >= TIMESTAMP '{SEARCH_LO}' AND ts < TIMESTAMP '{SEARCH_HI}') AS total
FROM events
WHERE ts >= TIMESTAMP '{SEARCH_LO}' AND ts < TIMESTAMP '{SEARCH_HI}'
ORDER BY ts, event_id LIMIT 200 OFFSET {SEARCH_START}
""")
def q_search_page(spark, d):
    """One search request: range, sort, offset, page of 200, total (SRC2, SRT1, SRT4)."""
    e = Tables(spark, d).events
    return search(e, "ts", SEARCH_LO, SEARCH_HI, sort=("ts", "event_id"), start=SEARCH_START,
                  count=200)


@register("range_filter", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT strftime(d.d, '%Y-%m-%d') AS day,
       count(*) FILTER (WHERE e.ts < d.d + INTERVAL 1 DAY) AS n_half_open,
       count(*) AS n_closed,
       count(*) FILTER (WHERE e.ts <= d.d + INTERVAL 86399 SECOND) AS n_compat_closed
FROM d JOIN events e ON e.ts >= d.d AND e.ts <= d.d + INTERVAL 1 DAY
GROUP BY d.d
""")
def q_range_filter(spark, d):
    """Per day: half-open ``[D, D+1)``, closed ``[D, D+1]`` (bare bounds) and the
    reference's closed ``[D 00:00:00, D 23:59:59]`` counts (FLT1, N1, N2)."""
    e = Tables(spark, d).events
    day = F.to_date("ts")
    start = day.cast("timestamp_ntz")
    per = (e.select(day.alias("day"), F.col("ts"), start.alias("d0"))
           .groupBy("day")
           .agg(F.count(F.lit(1)).alias("n_half_open"),
                F.count_if(F.col("ts") <= add_seconds("d0", 86399)).alias("n_compat_closed"),
                F.count_if(F.col("ts") == F.col("d0")).alias("n_midnight")))
    nxt = per.select(F.date_sub("day", 1).alias("day"), F.col("n_midnight").alias("n_next"))
    return per.join(nxt, "day", "left").select(
        day_text("day").alias("day"), "n_half_open",
        (F.col("n_half_open") + F.coalesce("n_next", F.lit(0))).alias("n_closed"),
        "n_compat_closed")


# --------------------------------------------------------------------------
# Quality and publish (AGG1-AGG4, DQ1-DQ3, SNK4, SNK5, FUN8-FUN11, FUN14, PRJ12)
# --------------------------------------------------------------------------
SQL_SOURCE = """
src AS (
  SELECT d, sum(ic) AS total_created, sum(im) AS total_modified,
         count(DISTINCT order_no) AS total_distinct
  FROM (SELECT CAST(c AS DATE) AS d, order_no, 1 AS ic, 0 AS im FROM h
        UNION ALL
        SELECT CAST(m AS DATE), order_no, 0, 1 FROM h WHERE m IS NOT NULL)
  GROUP BY d)"""


@register("source_totals", f"""
WITH {SQL_HEADERS},
{SQL_SOURCE}
SELECT strftime(d, '%Y-%m-%d') AS run_date, CAST(total_created AS BIGINT) AS total_created,
       CAST(total_modified AS BIGINT) AS total_modified,
       CAST(total_distinct AS BIGINT) AS total_distinct,
       CAST(total_created + total_modified AS BIGINT) AS total_records
FROM src
""")
def q_source_totals(spark, d):
    """Matches per day on each stamp, their sum and the distinct count (AGG1, AGG2)."""
    tot = Q.source_totals(_headers(spark, d), "creation_date", "last_modified")
    return tot.select(day_text("run_date").alias("run_date"), "total_created", "total_modified",
                      "total_distinct", "total_records")


SQL_DAY_ROWS = """
f AS (SELECT CAST(c AS DATE) AS d, order_no, c, m FROM h
      UNION
      SELECT CAST(m AS DATE), order_no, c, m FROM h WHERE m IS NOT NULL)"""

SQL_DAY_COUNTS = """
dc AS (
  SELECT d, count(order_no) AS total,
         count(*) FILTER (WHERE CAST(c AS DATE) = d) AS created,
         count(*) FILTER (WHERE CAST(c AS DATE) IS DISTINCT FROM d AND CAST(m AS DATE) = d)
           AS modified,
         count(*) FILTER (WHERE CAST(c AS DATE) <= d AND CAST(m AS DATE) = d) AS total_modified
  FROM f GROUP BY d)"""


def _day_counts(spark, d) -> DataFrame:
    feed = M.change_feed(_headers(spark, d), "creation_date", "last_modified")
    return Q.day_counts(feed, "run_date", "order_no", "creation_date", "last_modified")


@register("day_counts", f"""
WITH {SQL_HEADERS},
{SQL_DAY_ROWS},
{SQL_DAY_COUNTS}
SELECT strftime(d, '%Y-%m-%d') AS run_date, total, created, modified, total_modified FROM dc
""")
def q_day_counts(spark, d):
    """Counts of every merged day file: total, created, modified-not-created and
    all modified (AGG3, AGG4, FLT4-FLT6)."""
    dc = _day_counts(spark, d)
    return dc.select(day_text("run_date").alias("run_date"), "total", "created", "modified",
                     "total_modified")


@register("nonnull_count", """
SELECT count(*) AS n_rows, count(o.o_orderkey) AS n_order_order_no,
       count(l.l_partkey) AS n_product_item_product_id
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q_nonnull_count(spark, d):
    """``count(col)`` skips the null product ids of orders without lines (AGG3)."""
    return Q.nonnull_counts(_product_rows(spark, d), ["order_order_no", "product_item_product_id"])


#: Mismatching days for the gate: orders of this remainder class (of their number modulo
#: ``LOST_OF``) are taken as missing from the merged files.
LOST_OF, LOST_CLASS = 997, 5

SQL_RECONCILE_BASE = f"""
WITH {SQL_HEADERS},
{SQL_SOURCE},
f AS (SELECT * FROM (SELECT CAST(c AS DATE) AS d, order_no, c, m FROM h
                     UNION
                     SELECT CAST(m AS DATE), order_no, c, m FROM h WHERE m IS NOT NULL)
      WHERE CAST(order_no AS BIGINT) % {LOST_OF} <> {LOST_CLASS}),
{SQL_DAY_COUNTS.strip()},
rec AS (
  SELECT coalesce(s.d, dc.d) AS d,
         CAST(coalesce(s.total_created, 0) AS BIGINT) AS source_created,
         CAST(coalesce(s.total_modified, 0) AS BIGINT) AS source_modified,
         CAST(coalesce(dc.created, 0) AS BIGINT) AS file_created,
         CAST(coalesce(dc.total_modified, 0) AS BIGINT) AS file_total_modified
  FROM src s FULL JOIN dc ON dc.d = s.d)"""


def _reconciled(spark, d, mode: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(headers, source totals, day rows of the files, verdicts). The files lack the orders
    of one remainder class; totals and counts come from one pass over the headers each."""
    h = _headers(spark, d)
    source = Q.source_totals(h, "creation_date", "last_modified")
    merged = M.change_feed(h, "creation_date", "last_modified").filter(
        F.col("order_no").cast("bigint") % LOST_OF != LOST_CLASS)
    files = Q.day_counts(merged, "run_date", "order_no", "creation_date", "last_modified")
    return h, source, merged, Q.reconcile(source, files, "run_date", mode)


def _verdict_out(df: DataFrame) -> DataFrame:
    return df.select(day_text("run_date").alias("run_date"), "source_created", "source_modified",
                     "file_created", "file_total_modified", "passed")


@register("reconcile_all", SQL_RECONCILE_BASE + """
SELECT strftime(d, '%Y-%m-%d') AS run_date, source_created, source_modified, file_created,
       file_total_modified,
       (source_created = file_created) OR (source_modified = file_total_modified) AS passed
FROM rec
""")
def q_reconcile_all(spark, d):
    """Orders: a day fails only if created and modified counts both differ (DQ1)."""
    return _verdict_out(_reconciled(spark, d, "and")[3])


@register("reconcile_created", SQL_RECONCILE_BASE + """
SELECT strftime(d, '%Y-%m-%d') AS run_date, source_created, source_modified, file_created,
       file_total_modified, (source_created = file_created) AS passed
FROM rec
""")
def q_reconcile_created(spark, d):
    """Customers' rule: a day fails if created counts differ (DQ2)."""
    return _verdict_out(_reconciled(spark, d, "created")[3])


@register("publish_gate", SQL_RECONCILE_BASE + """
SELECT strftime(f.d, '%Y-%m-%d') AS run_date, f.order_no, f.c AS creation_date,
       f.m AS last_modified
FROM f SEMI JOIN rec ON rec.d = f.d
 AND ((rec.source_created = rec.file_created) OR (rec.source_modified = rec.file_total_modified))
""")
def q_publish_gate(spark, d):
    """Rows of passing days only: a failed day is not published (DQ3)."""
    _, _, captured, verdicts = _reconciled(spark, d, "and")
    rows = Q.publish_gate(captured, verdicts)
    return rows.select(day_text("run_date").alias("run_date"), "order_no", "creation_date",
                       "last_modified")


@register("trigger_rows", SQL_RECONCILE_BASE + """,
spine AS (SELECT CAST(unnest(generate_series(
             least(min(CAST(c AS DATE)), min(CAST(m AS DATE))),
             greatest(max(CAST(c AS DATE)), max(CAST(m AS DATE))), INTERVAL 1 DAY)) AS DATE) AS d
           FROM h),
t AS (SELECT spine.d, CAST(coalesce(src.total_created + src.total_modified, 0) AS BIGINT) AS total,
             coalesce((rec.source_created = rec.file_created)
                      OR (rec.source_modified = rec.file_total_modified), false) AS passed
      FROM spine LEFT JOIN src ON src.d = spine.d LEFT JOIN rec ON rec.d = spine.d)
SELECT strftime(d, '%Y-%m-%d') AS run_date, total,
       CASE WHEN total = 0 THEN 'empty' ELSE 'published' END AS state
FROM t WHERE total = 0 OR passed
""")
def q_trigger_rows(spark, d):
    """Day markers with the source total: empty days and passing days only (SNK5)."""
    h, totals, _, verdicts = _reconciled(spark, d, "and")
    days = h.select(F.explode(F.array(F.to_date("creation_date"), F.to_date("last_modified"))).alias("d"))
    spine = day_spine_of(days, "d", "run_date")
    all_days = spine.join(totals.select("run_date", "total_records"), "run_date", "left") \
        .fillna({"total_records": 0})
    marks = Q.trigger_rows(all_days, verdicts)
    return marks.select(day_text("run_date").alias("run_date"), "total", "state")


SQL_RUN_DAY = f"""
WITH {SQL_HEADERS}
SELECT order_no AS order_order_no, strftime(c, '%Y-%m-%dT%H:%M:%S.%gZ') AS order_creation_date,
       strftime(m, '%Y-%m-%dT%H:%M:%S.%gZ') AS order_last_modified
FROM h WHERE CAST(c AS DATE) = DATE '{RUN_DAY}' OR CAST(m AS DATE) = DATE '{RUN_DAY}'
"""


@register("publish_run_day", SQL_RUN_DAY)
def q_publish_run_day(spark, d):
    """The daily order job for one run date: only that day's rows are merged, judged
    against the source totals, published as flat files and read back (DQ3, SNK2, SNK3)."""
    docs, day = _docs(spark, d), dt.date.fromisoformat(RUN_DAY)
    out = scratch_path(spark, "publish-run-day")
    run = run_orders(docs, source_totals_of(docs), out, run_dates=[day], mode="and")
    table = run.tables["orders"].drop("run_date")
    printed = T.StructType([T.StructField(f.name, T.StringType() if "date" in f.name
                                          or "modified" in f.name else f.dataType)
                            for f in table.schema.fields])
    back = read_pipe_csv(spark, f"{run.written['orders']}/run_date={RUN_DAY}", printed)
    return back.select("order_order_no", "order_creation_date", "order_last_modified")


#: A re-run of three days: the first fails now, of the second one remainder class of orders
#: (of their number modulo ``GONE_OF``) is gone, the third is not part of it.
RERUN_DAYS = ("1996-09-17", "1996-09-18", "1996-09-19")
GONE_OF = 3


_RERUN: dict[tuple[str, str], str] = {}


def _rerun(spark, d) -> str:
    """The order job for three days, then again for two of them; the folder published to
    (once per session and landed documents)."""
    key = (session_key(spark), D.landed_order_path(spark, d))
    if key not in _RERUN:
        _RERUN[key] = _published_twice(spark, _docs(spark, d))
    return _RERUN[key]


def _published_twice(spark, docs) -> str:
    out = scratch_path(spark, "publish-rerun")
    days = [dt.date.fromisoformat(x) for x in RERUN_DAYS]
    stamps = [F.to_date(F.col(c)).isin(days) for c in ("creation_date", "last_modified")]
    # The two runs read the documents many times: those of the three days are landed once.
    path = scratch_path(spark, "rerun-documents")
    docs.filter(stamps[0] | stamps[1]).write.parquet(path)
    docs = spark.read.schema(docs.schema).parquet(path)
    run_orders(docs, source_totals_of(docs), out, run_dates=days, mode="and")
    fewer = docs.filter(F.col("order_no").cast("bigint") % GONE_OF != 0)
    wrong = F.when(F.col("run_date") == F.lit(days[0]), F.lit(1).cast("bigint")).otherwise(F.lit(0))
    totals = source_totals_of(fewer)
    totals = totals.withColumn("total_created", F.col("total_created") + wrong).withColumn("total_modified", F.col("total_modified") + wrong)
    run_orders(fewer, totals, out, run_dates=days[:2], mode="and")
    return out


SQL_RERUN = f"""
WITH {SQL_HEADERS},
f AS (SELECT CAST(c AS DATE) AS d, order_no FROM h UNION SELECT CAST(m AS DATE), order_no FROM h WHERE m IS NOT NULL),
s AS (SELECT * FROM f WHERE d = DATE '{RERUN_DAYS[2]}'
      UNION ALL SELECT * FROM f WHERE d = DATE '{RERUN_DAYS[1]}' AND CAST(order_no AS BIGINT) % {GONE_OF} <> 0)"""


@register("publish_rerun", SQL_RERUN + """
SELECT strftime(d, '%Y-%m-%d') AS run_date, order_no AS order_order_no FROM s
""")
def q_publish_rerun(spark, d):
    """What readers see after a re-run: the retracted day is gone, the repeated one shows its
    new version only, the other one stays (SNK2, SNK3, DQ3)."""
    out = _rerun(spark, d)
    text = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_COLUMNS])
    rows = read_published(spark, out, "orders", text)
    return rows.select(day_text("run_date").alias("run_date"), "order_order_no")


@register("publish_markers", SQL_RERUN + f""",
t AS (SELECT d, CAST(sum(n) AS BIGINT) AS total FROM (
        SELECT CAST(c AS DATE) AS d, order_no, 1 AS n FROM h UNION ALL SELECT CAST(m AS DATE), order_no, 1 FROM h WHERE m IS NOT NULL)
      WHERE d = DATE '{RERUN_DAYS[2]}' OR (d = DATE '{RERUN_DAYS[1]}' AND CAST(order_no AS BIGINT) % {GONE_OF} <> 0) GROUP BY d)
SELECT strftime(d, '%Y-%m-%d') AS run_date, total, 'published' AS state,
       CAST(CASE WHEN d = DATE '{RERUN_DAYS[1]}' THEN 2 ELSE 1 END AS BIGINT) AS seq
FROM t
""")
def q_publish_markers(spark, d):
    """Markers that hold after a re-run, with the number of the day's commits (SNK5)."""
    marks = current_markers(spark, _rerun(spark, d))
    return marks.select(day_text("run_date").alias("run_date"), "total", "state", "seq")


@register("publish_manifest", SQL_RERUN + """
SELECT strftime(d, '%Y-%m-%d') AS run_date, 'orders' AS table_name, true AS has_bytes FROM s GROUP BY d
""")
def q_publish_manifest(spark, d):
    """Days with files of the published order table, by the metadata of its folder (SNK4)."""
    files = published_files(spark, _rerun(spark, d), "orders")
    table = F.regexp_extract("file_path", "/([^/]+)/run_date=", 1)
    return (files.groupBy(day_text("run_date").alias("run_date"), table.alias("table_name"))
            .agg((F.sum("n_bytes") > 0).alias("has_bytes")))


#: Drift put into landed order documents: a new key, a new nested key and a retyped one, for
#: orders of a remainder class each.
NEW_KEY_OF, NESTED_KEY_OF, RETYPED_OF = 97, 89, 83
#: The text of whole documents is many times their Parquet size and repeats its keys, so it is
#: landed compressed; such a file is one task of the scan, so it holds a bounded number of rows.
LANDED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}


@register("key_drift", f"""
WITH c AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS run_date, o_orderkey AS k FROM orders)
SELECT run_date, 'c_giftNote' AS path, 'unknown' AS problem, 'STRING' AS found, count(*) AS n
FROM c WHERE k % {NEW_KEY_OF} = 3 GROUP BY 1
UNION ALL
SELECT run_date, 'customer_info.c_tier', 'unknown', 'BIGINT', count(*) FROM c WHERE k % {NESTED_KEY_OF} = 3 GROUP BY 1
UNION ALL
SELECT run_date, 'order_total', 'retyped', 'STRING', count(*) FROM c WHERE k % {RETYPED_OF} = 3 GROUP BY 1
""")
def q_key_drift(spark, d):
    """Unknown and retyped keys of landed order documents, per day (PRJ1, PRJ5)."""
    docs = _docs(spark, d).drop("doc_parts")
    of = lambda n: F.col("order_no").cast("bigint") % n == 3
    tier = F.when(of(NESTED_KEY_OF), F.lit(2))
    docs = (docs.withColumn("customer_info", F.col("customer_info").withField("c_tier", tier))
            .withColumn("c_giftNote", F.when(of(NEW_KEY_OF), F.lit("a note"))))
    texts = docs.withColumn("order_total", F.col("order_total").cast("string"))
    path = scratch_path(spark, "drifted-responses")
    for name, rows in (("a", docs.filter(~of(RETYPED_OF))), ("b", texts.filter(of(RETYPED_OF)))):
        data = F.struct(*[F.col(c) for c in rows.columns])
        rows.select(F.lit(1).alias("total"), F.array(F.struct(data.alias("data"))).alias("hits")).write.options(**LANDED_JSON).json(f"{path}/{name}")
    landed = read_variants(spark, f"{path}/*").withColumn(
        "run_date", F.substring(F.try_variant_get("data", "$.creation_date", "string"), 1, 10))
    return key_drift(document_keys(landed, ["run_date"]), ORDER_DOCUMENT)


@register("slice_files_merge", SQL_RUN_DAY)
def q_slice_files_merge(spark, d):
    """The file-based flow for one day: both stamp fields extracted into one folder per
    field and slice, then merged (SNK1, SRC3, SET2)."""
    docs, out = _docs(spark, d), scratch_path(spark, "slice-files")
    for field in ("creation_date", "last_modified"):
        extract_day(docs, RUN_DAY, out, field)
    orders = merge_day_files(spark, out, RUN_DAY, slice_schemas(docs))["orders"]
    return orders.select("order_order_no", utc_text("order_creation_date").alias("order_creation_date"),
                         utc_text("order_last_modified").alias("order_last_modified"))


@register("manifest_paths", """
SELECT page_id, string_split(url, '/')[-1] AS file_name, string_split(url, '/')[-2] AS folder_name
FROM pages
""")
def q_manifest_paths(spark, d):
    """File and folder names: last and second-last path parts (SNK4, FUN11)."""
    p = Tables(spark, d).pages
    return p.select("page_id", path_part_from_end("url", 1).alias("file_name"),
                    path_part_from_end("url", 2).alias("folder_name"))


LOG_METRICS = list(zip(["total", "created", "modified", "total_modified"], DAY_COUNT_LOG_KEYS))


@register("log_metrics", f"""
WITH {SQL_HEADERS},
{SQL_DAY_ROWS},
{SQL_DAY_COUNTS},
lines AS (
  {" UNION ALL ".join(f"SELECT d, '{name} : ' || CAST({col} AS VARCHAR) AS line FROM dc"
                      for col, name in LOG_METRICS)})
SELECT strftime(d, '%Y-%m-%d') AS run_date,
       regexp_extract(line, '^\\s*(\\S+)\\s*:', 1) AS metric,
       CAST(regexp_extract(line, '^\\s*(\\S+)\\s*:\\s*(-?\\d+)\\s*$', 2) AS BIGINT) AS value
FROM lines
""")
def q_log_metrics(spark, d):
    """Counts printed as ``key : value`` lines and extracted back (FUN14)."""
    dc = _day_counts(spark, d)
    named = dc.select("run_date", *[F.col(c).alias(n) for c, n in LOG_METRICS])
    lines = metric_lines(named, ["run_date"], [n for _, n in LOG_METRICS])
    return lines.select(day_text("run_date").alias("run_date"),
                        metric_name("line").alias("metric"), metric_value("line").alias("value"))


@register("log_metrics_scan", f"""
WITH {SQL_HEADERS},
{SQL_DAY_ROWS},
{SQL_DAY_COUNTS},
y AS (SELECT strftime(d, '%Y') || '-01-01' AS run, {", ".join(f"sum({c}) AS {c}" for c, _ in LOG_METRICS)} FROM dc GROUP BY 1)
{" UNION ALL ".join(f"SELECT run, '{name}' AS metric, CAST({col} AS BIGINT) AS value, CAST(2 AS BIGINT) AS n_values FROM y"
                    for col, name in LOG_METRICS)}
""")
def q_log_metrics_scan(spark, d):
    """Yearly counts logged by two runs as text files, scanned back: the second run's counts
    win (FUN14)."""
    dc = _day_counts(spark, d)
    year = F.concat(F.date_format("run_date", "yyyy"), F.lit("-01-01"))
    sums = dc.groupBy(year.alias("run_date")).agg(*[F.sum(c).alias(n) for c, n in LOG_METRICS])
    path = scratch_path(spark, "run-logs")
    for wrong in (1, 0):
        run = sums.select("run_date", *[(F.col(n) + wrong).alias(n) for _, n in LOG_METRICS])
        lines = metric_lines(run, ["run_date"], [n for _, n in LOG_METRICS])
        lines.repartition("run_date").write.mode("append").partitionBy("run_date").text(path)
    # The folder's own name may hold digits that look like a day.
    return read_run_metrics(spark, path, r"run_date=(\d{4}-\d{2}-\d{2})")


@register("slice_labels", """
WITH s AS (SELECT DISTINCT time_bucket(INTERVAL '15 minutes', ts) AS slice_start FROM events),
e AS (SELECT slice_start,
             CASE WHEN strftime(slice_start, '%H:%M:%S') = '23:45:00'
                  THEN slice_start + INTERVAL 899 SECOND
                  ELSE slice_start + INTERVAL 900 SECOND END AS slice_end FROM s)
SELECT slice_start,
       'events_on_ts_' || strftime(slice_start, '%Y-%m-%d') || '_'
       || replace(strftime(slice_start, '%H:%M:%S'), ':', '_') || '_to_'
       || replace(strftime(slice_end, '%H:%M:%S'), ':', '_') || '.csv' AS label
FROM e
""")
def q_slice_labels(spark, d):
    """File labels of the non-empty slices, times made file-safe (FUN8, FUN9)."""
    s = SL.fixed_slices(Tables(spark, d).events, "ts", 900).select("slice_start")
    last = F.date_format("slice_start", "HH:mm:ss") == F.lit("23:45:00")
    end = F.when(last, add_seconds("slice_start", 899)).otherwise(add_seconds("slice_start", 900))
    return s.select("slice_start", slice_label("events", "ts", F.col("slice_start"), end)
                    .alias("label"))


@register("preview_top5", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_no,
       {SQL_CUSTOMER_EMAIL} AS email,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS company_name
FROM customer ORDER BY customer_no LIMIT 5
""")
def q_preview_top5(spark, d):
    """First five customers by number: a top-k, not a full sort (PRJ12)."""
    docs = D.customer_documents(Tables(spark, d).customer)
    return docs.orderBy("customer_no").limit(5).select("customer_id", "customer_no", "email",
                                                       "company_name")


# --------------------------------------------------------------------------
# Merged day tables (the published outputs) and path templates
# --------------------------------------------------------------------------
DAY_PATH_TEMPLATE = "daily/RUN_DATE/orders/orders_data_RUN_DATE.csv"


@register("day_paths", f"""
SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS run_date,
       replace('{DAY_PATH_TEMPLATE}', 'RUN_DATE', strftime(o_orderdate, '%Y%m%d')) AS path
FROM orders
""")
def q_day_paths(spark, d):
    """Day file paths from a template with a ``RUN_DATE`` token (FUN10)."""
    o = Tables(spark, d).orders
    days = o.select(run_date_text("o_orderdate").alias("run_date")).distinct()
    return days.select("run_date", substitute_run_date(F.lit(DAY_PATH_TEMPLATE), F.col("run_date"))
                       .alias("path"))


def _order_day_tables(spark, d) -> dict[str, DataFrame]:
    return order_tables(_docs(spark, d), sep="_")


ORDER_DAY_NULLS = [
    "order_adjusted_merchandize_total_tax", "order_adjusted_shipping_total_tax",
    "order_created_by", "order_export_status", "order_merchandize_total_tax",
    "order_payment_status", "order_product_sub_total", "order_product_total",
    "order_shipping_status", "order_shipping_total", "order_shipping_total_tax", "order_site_id",
    "order_taxation", "order_tax_total", "order_c_ATCustomsDuty", "order_c_ATTax",
    "order_c_mcOrderConfirmationStatusFailed", "order_c_IPAddress", "order_notes__type",
    "order_notes_link"]


@register("orders_day_table", f"""
WITH {SQL_HEADERS},
{SQL_DAY_ROWS},
o AS (SELECT * FROM orders)
SELECT strftime(f.d, '%Y-%m-%d') AS run_date,
       'order' AS order__type,
       o.o_orderpriority AS order_confirmation_status,
       f.c AS order_creation_date,
       (f.c AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' AS order_creation_pst_date,
       'USD' AS order_currency,
       f.m AS order_last_modified,
       (f.m AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' AS order_last_modified_pst_date,
       f.order_no AS order_order_no,
       o.o_totalprice AS order_order_total,
       o.o_orderstatus AS order_status,
       'customer_info' AS order_customer_info__type,
       CAST(o.o_custkey AS VARCHAR) AS order_customer_info_customer_id,
       lpad(CAST(o.o_custkey AS VARCHAR), 8, '0') AS order_customer_info_customer_no,
       sha256('customer' || CAST(o.o_custkey AS VARCHAR) || '@example.com') AS customer_emails,
       'orders_data_' || strftime(f.d, '%Y%m%d') || '.csv' AS file_name,
       {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ORDER_DAY_NULLS)}
FROM f JOIN o ON CAST(o.o_orderkey AS VARCHAR) = f.order_no
""")
def q_orders_day_table(spark, d):
    """The merged order day table: 35 published columns (``_`` for ``.``), one row
    per order and day, Pacific stamps, hashed e-mail, lineage (section 3.1)."""
    t = _order_day_tables(spark, d)["orders"]
    return t.withColumn("run_date", day_text("run_date"))


@register("products_day_table", f"""
WITH {SQL_HEADERS},
{SQL_DAY_ROWS}
SELECT DISTINCT strftime(f.d, '%Y-%m-%d') AS run_date, f.order_no AS order_order_no,
       {SQL_ITEM_ID.format(a='l')} AS product_item_item_id,
       CAST(l.l_partkey AS VARCHAR) AS product_item_product_id,
       l.l_quantity AS product_item_quantity, l.l_extendedprice AS product_item_price,
       'NAN' AS product_item_c_personalizationJson,
       'products_data_' || strftime(f.d, '%Y%m%d') || '.csv' AS file_name
FROM f JOIN lineitem l ON CAST(l.l_orderkey AS VARCHAR) = f.order_no
""")
def q_products_day_table(spark, d):
    """The merged product-line day table: NAN personalisation, rows without a
    product id dropped, distinct, lineage (section 3.1)."""
    t = _order_day_tables(spark, d)["products"]
    return t.select(day_text("run_date").alias("run_date"), "order_order_no",
                    "product_item_item_id", "product_item_product_id", "product_item_quantity",
                    "product_item_price", "product_item_c_personalizationJson", "file_name")


BACKFILL_ORDERS = ("1996-06-01", "1996-06-17")


@register("payments_backfill", f"""
WITH o AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
           WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{BACKFILL_ORDERS[0]}'
                                               AND DATE '{BACKFILL_ORDERS[1]}')
SELECT strftime(o_orderdate, '%Y-%m-%d') AS run_date, CAST(o_orderkey AS VARCHAR) AS order_order_no,
       CAST(o_orderkey AS VARCHAR) || '-1' AS payment_inst_payment_instrument_id,
       CAST(cents - cents // 4 AS DOUBLE) / 100 AS payment_inst_amount,
       'payment_details_data_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS file_name
FROM o
UNION ALL
SELECT strftime(o_orderdate, '%Y-%m-%d'), CAST(o_orderkey AS VARCHAR),
       CAST(o_orderkey AS VARCHAR) || '-2', CAST(cents // 4 AS DOUBLE) / 100,
       'payment_details_data_' || strftime(o_orderdate, '%Y%m%d') || '.csv'
FROM o
""")
def q_payments_backfill(spark, d):
    """17 days of payment instruments in one job, as the monthly backfill
    (section 3.3, SRC6, JON2)."""
    pays = backfill_payments(_docs(spark, d), *BACKFILL_ORDERS, sep="_")
    return pays.select(day_text("run_date").alias("run_date"), "order_order_no",
                       "payment_inst_payment_instrument_id", "payment_inst_amount", "file_name")


CUSTOMER_TEXT_NULLS = ["birthday", "phone_business", "phone_mobile", "c_cordialSubscribed",
                       "c_cordialList", "c_cordialCID", "c_subscribed", "c_isLoyaltyMember",
                       "c_vipStatus", "c_isLoyaltyProgramInitialized", "c_aListStatus",
                       "c_freeEconomyShipping", "c_vipExpireStatus", "c_vipExtensionStatus"]
CUSTOMER_STAMP_NULLS = ["last_login_time", "last_visit_time", "previous_login_time",
                        "previous_visit_time"]


@register("customers_day_table", f"""
WITH cs AS (SELECT o_custkey, min(o_orderdate) AS c, max(o_orderdate) AS m
            FROM orders GROUP BY o_custkey),
b AS (SELECT cu.*, cs.c, cs.m FROM customer cu LEFT JOIN cs ON cs.o_custkey = cu.c_custkey),
f AS (SELECT CAST(c AS DATE) AS d, * FROM b WHERE c IS NOT NULL
      UNION
      SELECT CAST(m AS DATE) AS d, * FROM b WHERE m IS NOT NULL)
SELECT strftime(d, '%Y-%m-%d') AS run_date,
       CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS company_name,
       c AS creation_date,
       (c AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' AS creation_date_pst,
       lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_no,
       {SQL_CUSTOMER_EMAIL} AS email,
       'Customer' AS first_name,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey % 3 AS INTEGER) END AS gender,
       m AS last_modified,
       (m AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' AS last_modified_pst,
       split_part(c_name, '#', 2) AS last_name,
       CASE WHEN c_mktsegment <> 'FURNITURE'
            THEN lpad(CAST(c_nationkey * 1000 + 7 AS VARCHAR), 10, '0') END AS phone_home,
       coalesce(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END, CAST('NaN' AS DOUBLE))
         AS c_pointsBalance,
       CAST('NaN' AS DOUBLE) AS c_vipPointsNeeded,
       CAST('NaN' AS DOUBLE) AS c_aListMembershipTier,
       'customers_data_' || strftime(d, '%Y%m%d') || '.csv' AS file_name,
       {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in CUSTOMER_TEXT_NULLS)},
       {", ".join(f"CAST(NULL AS TIMESTAMP) AS {c}, CAST(NULL AS TIMESTAMP) AS {c}_pst"
                  for c in CUSTOMER_STAMP_NULLS)}
FROM f
""")
def q_customers_day_table(spark, d):
    """The merged customer day table (section 3.2): 38 published columns, defaults
    for absent keys, six Pacific columns, lineage, distinct."""
    t = Tables(spark, d)
    docs = D.customer_documents(t.customer, t.orders)
    return customer_table(docs).withColumn("run_date", day_text("run_date"))


def sql_adaptive_compat(ladder, cap: int) -> str:
    """Oracle for compat refinement: closed day end, truncated refined last slice,
    per-second cut to ``cap``."""
    k = len(ladder)
    w0, w1 = ladder[0], ladder[1]
    cut = (86400 - w0) + ((w0 - 1) // w1) * w1
    parents = ",\n       ".join(
        f"time_bucket(INTERVAL '{w} seconds', sec) AS p{i}" for i, w in enumerate(ladder))
    sums = ",\n       ".join(f"sum(n2) OVER (PARTITION BY p{i}) AS c{i}" for i in range(1, k))
    cases = " ".join(f"WHEN c{i} < {cap} THEN {i}" for i in range(k - 1))
    widths = "[" + ", ".join(str(w) for w in ladder) + "]"
    plist = "[" + ", ".join(f"p{i}" for i in range(k)) + "]"
    return f"""
WITH s AS (SELECT date_trunc('second', ts) AS sec,
                  count(*) FILTER (WHERE ts = date_trunc('second', ts)) AS n_exact,
                  count(*) FILTER (WHERE ts <> date_trunc('second', ts)) AS n_frac
           FROM events GROUP BY 1),
e AS (SELECT *, date_diff('second', CAST(CAST(sec AS DATE) AS TIMESTAMP), sec) AS off FROM s),
p AS (SELECT *, n_exact + CASE WHEN off < 86399 THEN n_frac ELSE 0 END AS n,
       {parents} FROM e),
q AS (SELECT *, sum(n) OVER (PARTITION BY p0) AS c0 FROM p),
r AS (SELECT *, CASE WHEN c0 >= {cap} AND off >= {cut} THEN 0 ELSE n END AS n2 FROM q),
c AS (SELECT *,
       {sums} FROM r),
l AS (SELECT *, CASE {cases} ELSE {k - 1} END AS lvl FROM c WHERE n2 > 0),
g AS (SELECT CAST({widths}[lvl + 1] AS INTEGER) AS level_seconds,
             {plist}[lvl + 1] AS slice_start,
             {plist}[lvl + 1] + to_seconds({widths}[lvl + 1]) AS slice_end,
             CAST(sum(n2) AS BIGINT) AS n
      FROM l GROUP BY 1, 2, 3)
SELECT *, CASE WHEN level_seconds = {ladder[-1]} AND n > {cap} THEN CAST({cap} AS BIGINT)
               ELSE n END AS n_captured
FROM g
"""


@register("slice_adaptive_compat", sql_adaptive_compat(ORDER_LADDER, TEST_CAP))
def q_slice_adaptive_compat(spark, d):
    """Refinement as the reference's requests capture it: closed day end (N2), the
    refined last slice's lost tail (N3) and seconds cut to the cap (N5)."""
    s = SL.adaptive_slices(Tables(spark, d).events, "ts", ORDER_LADDER, cap=TEST_CAP,
                           compat=True, cut_seconds=True)
    return s.select("level_seconds", "slice_start", "slice_end", "n", "n_captured")


def sql_closed(ladder, cap: int, select: str) -> str:
    """Oracle for closed bounds: every event with all requests that return it, level by level;
    an event exactly on a boundary belongs to both parts."""
    levels, day = [], 86400
    for k, w in enumerate(ladder):
        if k == 0:
            source, start, parts = "(SELECT * FROM e WHERE us - d <= 86399000000)", "d", day // w
        else:
            source, start, parts = f"(SELECT * FROM m{k - 1} WHERE c >= {cap})", "s", ladder[k - 1] // w
        if k == 1:
            parts = f"CASE WHEN s - d = {(day - ladder[0]) * 10**6} THEN {(ladder[0] - 1) // w} ELSE {parts} END"
        u = w * 10**6
        levels.append(f"""m{k} AS (
  SELECT *, count(*) OVER (PARTITION BY s) AS c FROM (
    SELECT event_id, ts, us, d, {start} + i * {u} AS s FROM (
      SELECT *, {parts} AS parts, unnest(CASE WHEN (us - {start}) % {u} = 0
        THEN [(us - {start}) // {u}, (us - {start}) // {u} - 1] ELSE [(us - {start}) // {u}] END) AS i
      FROM {source}) WHERE i >= 0 AND i < parts))""")
    last = len(ladder) - 1
    chosen = " UNION ALL ".join(
        f"SELECT event_id, ts, {w} AS level_seconds, make_timestamp(s) AS slice_start, c AS n FROM m{k}"
        + (f" WHERE c < {cap}" if k < last else "") for k, w in enumerate(ladder))
    return f"""
WITH e AS (SELECT event_id, ts, epoch_us(ts) AS us, epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS d FROM events),
{", ".join(levels)},
r AS ({chosen})
{select}
"""


@register("slice_adaptive_closed", sql_closed(CUSTOMER_LADDER, TEST_CAP, """
SELECT level_seconds, slice_start, slice_start + to_seconds(level_seconds) AS slice_end, count(*) AS n
FROM r GROUP BY ALL"""))
def q_slice_adaptive_closed(spark, d):
    """The customer ladder with the closed ranges of the requests: a stamp on a boundary counts
    in both slices (WIN4, FLT1, N1-N3)."""
    s = SL.adaptive_slices(Tables(spark, d).events, "ts", CUSTOMER_LADDER, cap=TEST_CAP, compat=True, closed=True)
    return s.select("level_seconds", "slice_start", "slice_end", "n")


@register("closed_capture", sql_closed(ORDER_LADDER, TEST_CAP, f"""
SELECT event_id, level_seconds, slice_start FROM r
QUALIFY level_seconds > {ORDER_LADDER[-1]}
  OR row_number() OVER (PARTITION BY level_seconds, slice_start ORDER BY ts, event_id) <= {TEST_CAP}"""))
def q_closed_capture(spark, d):
    """Every event as often as the order requests return it, with closed ranges and full
    seconds cut to the cap (WIN3, FLT1, N1-N3, N5)."""
    e = Tables(spark, d).events.select("event_id", "ts")
    got = SL.closed_capture(e, "ts", ORDER_LADDER, cap=TEST_CAP, sort=["ts", "event_id"])
    return got.select("event_id", "level_seconds", "slice_start")


def sql_assignment(ladder, cap: int) -> str:
    """Oracle for slice assignment: each event with its second's chosen slice."""
    k = len(ladder)
    parents = ",\n       ".join(
        f"time_bucket(INTERVAL '{w} seconds', sec) AS p{i}" for i, w in enumerate(ladder))
    sums = ",\n       ".join(f"sum(n) OVER (PARTITION BY p{i}) AS c{i}" for i in range(k))
    cases = " ".join(f"WHEN c{i} < {cap} THEN {i}" for i in range(k - 1))
    widths = "[" + ", ".join(str(w) for w in ladder) + "]"
    plist = "[" + ", ".join(f"p{i}" for i in range(k)) + "]"
    return f"""
WITH s AS (SELECT date_trunc('second', ts) AS sec, count(*) AS n FROM events GROUP BY 1),
p AS (SELECT sec, n,
       {parents} FROM s),
c AS (SELECT *,
       {sums} FROM p),
l AS (SELECT sec, CASE {cases} ELSE {k - 1} END AS lvl, c0, p0, p1, p2, p3 FROM c)
SELECT e.event_id,
       CAST({widths}[lvl + 1] AS INTEGER) AS level_seconds,
       {plist}[lvl + 1] AS slice_start,
       {plist}[lvl + 1] + to_seconds({widths}[lvl + 1]) AS slice_end,
       CAST(0 AS BIGINT) AS page_no,
       'events_on_ts_' || strftime({plist}[lvl + 1], '%Y-%m-%d') || '_'
       || replace(strftime({plist}[lvl + 1], '%H:%M:%S'), ':', '_') || '_to_'
       || replace(strftime({plist}[lvl + 1] + to_seconds({widths}[lvl + 1]), '%H:%M:%S'), ':', '_')
       || '.csv' AS label
FROM events e JOIN l ON l.sec = date_trunc('second', e.ts)
"""


@register("slice_assignment", sql_assignment(ORDER_LADDER, TEST_CAP))
def q_slice_assignment(spark, d):
    """Each event with the slice (and page) whose request returns it, and that
    slice's file label: the slice loop of a day's extraction (WIN3, WIN6, FUN9)."""
    e = Tables(spark, d).events.select("event_id", "ts")
    a = SL.assign_slices(e, "ts", ORDER_LADDER, cap=TEST_CAP, sort=["ts", "event_id"])
    return a.select("event_id", "level_seconds", "slice_start", "slice_end", "page_no",
                    slice_label("events", "ts", F.col("slice_start"), F.col("slice_end"))
                    .alias("label"))


@register("slice_adaptive_fields", sql_adaptive(ORDER_LADDER, TEST_CAP, by="event_type"))
def q_slice_adaptive_fields(spark, d):
    """Refinement per extraction field in one job: every event type is sliced on
    its own (the ``by`` key leads every window partition), as the creation and
    modification fields are (WIN3)."""
    s = SL.adaptive_slices(Tables(spark, d).events, "ts", ORDER_LADDER, cap=TEST_CAP,
                           by=["event_type"])
    return s.select("event_type", "level_seconds", "slice_start", "slice_end", "n")


CUSTOMER_PAGE = 2


def _sql_customer_pages(ladder, cap: int, page: int) -> str:
    k = len(ladder)
    parents = ",\n       ".join(
        f"time_bucket(INTERVAL '{w} seconds', sec) AS p{i}" for i, w in enumerate(ladder))
    sums = ",\n       ".join(f"sum(n) OVER (PARTITION BY p{i}) AS c{i}" for i in range(k))
    cases = " ".join(f"WHEN c{i} < {cap} THEN {i}" for i in range(k - 1))
    widths = "[" + ", ".join(str(w) for w in ladder) + "]"
    plist = "[" + ", ".join(f"p{i}" for i in range(k)) + "]"
    return f"""
WITH cs AS (SELECT o_custkey, min(o_orderdate) AS ts FROM orders GROUP BY o_custkey),
r AS (SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, cs.ts
      FROM customer c JOIN cs ON cs.o_custkey = c.c_custkey),
s AS (SELECT date_trunc('second', ts) AS sec, count(*) AS n FROM r GROUP BY 1),
p AS (SELECT sec, n,
       {parents} FROM s),
c AS (SELECT *,
       {sums} FROM p),
l AS (SELECT sec, n, CASE {cases} ELSE {k - 1} END AS lvl, {", ".join(f"p{i}" for i in range(k))}
      FROM c),
a AS (SELECT r.customer_id, r.ts, l.*,
             CAST({widths}[lvl + 1] AS INTEGER) AS level_seconds,
             {plist}[lvl + 1] AS slice_start,
             {plist}[lvl + 1] + to_seconds({widths}[lvl + 1]) AS slice_end,
             CASE WHEN lvl = {k - 1} AND n >= {cap}
                  THEN CAST((row_number() OVER (PARTITION BY l.sec ORDER BY r.ts, r.customer_id)
                             - 1) // {page} AS BIGINT)
                  ELSE CAST(0 AS BIGINT) END AS page_no
      FROM r JOIN l ON l.sec = date_trunc('second', r.ts))
SELECT customer_id, level_seconds, slice_start, slice_end, page_no,
       'customers_on_creation_date_' || strftime(slice_start, '%Y-%m-%d') || '_'
       || replace(strftime(slice_start, '%H:%M:%S'), ':', '_') || '_to_'
       || replace(strftime(slice_end, '%H:%M:%S'), ':', '_')
       || '_P' || CAST(page_no AS VARCHAR) || '.csv' AS file_label
FROM a
"""


@register("customer_pages", _sql_customer_pages(CUSTOMER_LADDER, TEST_CAP, CUSTOMER_PAGE))
def q_customer_pages(spark, d):
    """Customers assigned to the slice and page whose request returns them on the
    customer ladder (1 h -> 1 s), over-full seconds paged, with their ``_P<page>``
    file labels (WIN4, WIN6, FUN9). Creation stamps are first order dates, so many
    customers share a midnight second and are paged."""
    from cartloom.functions.labels import page_label

    t = Tables(spark, d)
    docs = D.customer_documents(t.customer, t.orders).filter(F.col("creation_date").isNotNull())
    a = SL.assign_slices(docs.select("customer_id", F.col("creation_date").alias("ts")), "ts",
                         CUSTOMER_LADDER, cap=TEST_CAP, sort=["ts", "customer_id"],
                         page_size=CUSTOMER_PAGE)
    label = slice_label("customers", "creation_date", F.col("slice_start"), F.col("slice_end"))
    return a.select("customer_id", "level_seconds", "slice_start", "slice_end", "page_no",
                    page_label(label, F.col("page_no")).alias("file_label"))
