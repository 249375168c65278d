"""Nested order and customer documents derived from the driver's tables.

These stand in for landed search responses: an order document carries its
payment instruments, shipments, shipping items (with price adjustments) and
product items (with option items), as the service returns them.

Derivation (every rule is data-driven, so the work grows with the tables):

* ``order_no`` = ``o_orderkey`` as text; ``creation_date`` = ``o_orderdate``;
  ``last_modified`` = latest ``l_shipdate`` of the order (null without lines);
* ``customer_info``: id ``o_custkey``, number zero-padded to 8 (leading zeros
  must survive), e-mail ``customer<custkey>@example.com``;
* ``payment_instruments``: two, splitting ``o_totalprice`` in cents: the gift
  certificate takes ``cents div 4``, the card the rest (exact, no rounding);
* ``shipments``: one per distinct ``l_suppkey % 3`` of the lines (``S0`` for an
  order without lines); ``shipping_items``: one per shipment, whose
  ``price_adjustments`` are its lines with ``l_discount > 0.05`` (absent if none);
* ``product_items``: one per line (absent without lines); a line with
  ``l_discount > 0.05`` has ``l_linenumber % 3 + 1`` option items.

Bounded documents are a matter of storage only: every query gives the same rows whether
an order comes as one document or as several (lines and adjustments are summed, header
values counted once). An order's lines are grouped into documents of at most about
``max_items`` lines (``doc_part``), using the line counts of the large orders from a
partial aggregate, and the plain lines are re-partitioned once on ``(order, doc_part)`` before
``collect_list``; the nested items are built after the join with the orders. A hot order therefore becomes many bounded documents spread
over many tasks, like the pages a search service returns; at the test scales
every order is one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ITEMS = 1000

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate"]


def order_no(col: str = "o_orderkey") -> Column:
    return F.col(col).cast("string")


def payment_cents(total: str = "o_totalprice") -> tuple[Column, Column]:
    """(card cents, gift cents) of an order total, exact in integers."""
    cents = F.round(F.col(total) * 100).cast("bigint")
    gift = F.floor(cents / F.lit(4)).cast("bigint")
    return cents - gift, gift


def _dollars(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100)


def order_headers(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders with ``creation_date`` and ``last_modified`` (latest ship date).

    The per-order maximum is a partial aggregate; the join is on the order key.
    """
    lm = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_modified"),
                                            F.count(F.lit(1)).alias("n_lines"))
    return (orders.join(lm, orders.o_orderkey == lm.l_orderkey, "left")
            .drop("l_orderkey")
            .withColumn("creation_date", F.col("o_orderdate")))


def _customer_info() -> Column:
    cid = F.col("o_custkey").cast("string")
    cno = F.lpad(cid, 8, "0")
    return F.struct(F.lit("customer_info").alias("_type"), cid.alias("customer_id"),
                    cno.alias("customer_no"),
                    F.concat(F.lit("Customer#"), cno).alias("customer_name"),
                    F.concat(F.lit("customer"), cid, F.lit("@example.com")).alias("email"))


def _payments() -> Column:
    card, gift = payment_cents()
    no = order_no()
    cid = F.col("o_custkey").cast("string")
    card_struct = F.struct(F.lit("payment_card").alias("_type"), F.lit("VISA").alias("card_type"),
                           F.concat(F.lit("************"), F.lpad(F.substring(cid, -4, 4), 4, "0"))
                           .alias("masked_number"))
    p1 = F.struct(F.lit("order_payment_instrument").alias("_type"),
                  F.concat(no, F.lit("-1")).alias("payment_instrument_id"),
                  _dollars(card).alias("amount"), F.lit("CREDIT_CARD").alias("payment_method_id"),
                  cid.alias("c_customerProfileId"),
                  F.lit(None).cast("string").alias("masked_gift_certificate_code"),
                  card_struct.alias("payment_card"))
    p2 = F.struct(F.lit("order_payment_instrument").alias("_type"),
                  F.concat(no, F.lit("-2")).alias("payment_instrument_id"),
                  _dollars(gift).alias("amount"),
                  F.lit("GIFT_CERTIFICATE").alias("payment_method_id"),
                  cid.alias("c_customerProfileId"),
                  F.concat(F.lit("********"), F.lpad(F.substring(no, -4, 4), 4, "0"))
                  .alias("masked_gift_certificate_code"),
                  F.lit(None).cast(card_struct_type()).alias("payment_card"))
    return F.array(p1, p2)


def card_struct_type() -> str:
    return "struct<_type:string,card_type:string,masked_number:string>"


def _option_items(line: Column, item_id: Column, product_id: Column) -> Column:
    n = (line["l_linenumber"] % 3) + 1
    opts = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.lit("option_item").alias("_type"),
        F.concat(item_id, F.lit("-"), i.cast("string")).alias("item_id"),
        F.concat(F.lit("opt-"), i.cast("string")).alias("option_id"),
        F.concat(F.lit("val-"), line["l_partkey"].cast("string")).alias("option_value_id"),
        (line["l_tax"] * i).alias("price"),
        F.concat(product_id, F.lit("-"), i.cast("string")).alias("product_id"),
        F.lit(1.0).alias("quantity"),
        (line["l_linenumber"] * 100).cast("double").alias("tax_basis"),
        F.lit("option").alias("c_OptionType")))
    return F.when(line["l_discount"] > 0.05, opts)


def _product_item(line: Column) -> Column:
    no = F.col("l_orderkey").cast("string")
    item_id = F.concat(no, F.lit("-"), line["l_linenumber"].cast("string"))
    product_id = line["l_partkey"].cast("string")
    return F.struct(
        F.lit("product_item").alias("_type"),
        item_id.alias("item_id"),
        product_id.alias("product_id"),
        F.concat(F.lit("Part#"), product_id).alias("product_name"),
        line["l_quantity"].alias("quantity"),
        line["l_extendedprice"].alias("price"),
        (line["l_extendedprice"] * (1 - line["l_discount"])).alias("price_after_item_discount"),
        line["l_tax"].alias("tax"),
        F.concat(F.lit("S"), _group(line)).alias("shipment_id"),
        line["l_returnflag"].alias("c_Type"),
        (line["l_linestatus"] == F.lit("O")).alias("c_isBackorder"),
        F.lit("{}").alias("c_personalizationJson"),
        _option_items(line, item_id, product_id).alias("option_items"))


def _adjustment(line: Column) -> Column:
    no = F.col("l_orderkey").cast("string")
    return F.struct(
        F.lit("price_adjustment").alias("_type"),
        F.concat(no, F.lit("-"), line["l_linenumber"].cast("string"), F.lit("-"),
                 line["l_partkey"].cast("string")).alias("price_adjustment_id"),
        F.concat(F.lit("PROMO-"), F.round(line["l_discount"] * 100).cast("int").cast("string"))
        .alias("promotion_id"),
        (-(line["l_extendedprice"] * line["l_discount"])).alias("price"),
        F.lit("line discount").alias("item_text"),
        F.struct(F.lit("discount").alias("_type"), line["l_discount"].alias("amount"),
                 F.lit("percentage").alias("type")).alias("applied_discount"))


def _group(line: Column) -> Column:
    """The shipment group of a line."""
    return (line["l_suppkey"] % 3).cast("string")


def large_orders(lineitem: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Orders of more than ``max_items`` lines: key, number of documents, latest ship date.

    At most one row per ``max_items`` lines, so it is broadcast: only a few bytes per line
    (the partial counts) are shuffled for it.
    """
    counts = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"), F.max("l_shipdate").alias("large_lm"))
    return F.broadcast(counts.filter((F.col("_n") > max_items) & F.col("l_orderkey").isNotNull())
                       .select(F.col("l_orderkey").alias("large_key"), "large_lm",
                               F.ceil(F.col("_n") / F.lit(int(max_items))).cast("bigint").alias("doc_parts")))


def document_parts(lineitem: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Lines tagged with ``doc_part`` so that no document exceeds ~``max_items``
    lines; re-partitioned on (order, part) for the document aggregation, which is the only
    exchange of the lines.

    A large order's lines are spread by a hash of a row id taken at the scan
    (deterministic per file split), so even identical copies of one line are
    split across parts.
    """
    lines = (lineitem.select(*LINE_COLS).withColumn("_rid", F.monotonically_increasing_id())
             .filter(F.col("l_orderkey").isNotNull()))
    large = large_orders(lineitem, max_items).drop("large_lm")
    part = F.coalesce(F.pmod(F.xxhash64("_rid"), "doc_parts"), F.lit(0).cast("bigint"))
    return (lines.join(large, F.col("l_orderkey") == F.col("large_key"), "left")
            .select(*LINE_COLS, part.alias("doc_part")).repartition("l_orderkey", "doc_part"))


def line_arrays(lineitem: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Per (order, doc_part): the plain columns of its lines (``_lines``) and their latest
    ship date (``_lm``). The wide nested items are built from them when the document is, so
    that neither the aggregation nor the join with the orders sorts or moves them."""
    line = F.struct(*[F.col(c) for c in LINE_COLS if c not in ("l_orderkey", "l_shipdate")])
    return document_parts(lineitem, max_items).groupBy("l_orderkey", "doc_part").agg(
        F.max("l_shipdate").alias("_lm"), F.collect_list(line).alias("_lines"))


def _shipping(lines: str = "_lines") -> tuple[Column, Column]:
    """Shipments and shipping items: one per group, with the group's adjustments. Arrays are
    sorted with ``sort_array`` (a native comparison, not a lambda comparator)."""
    groups = F.array_distinct(F.transform(lines, _group))

    def item(group: Column) -> Column:
        hits = F.filter(lines, lambda line: _group(line).eqNullSafe(group) & (line["l_discount"] > 0.05))
        return F.struct(F.lit("shipping_item").alias("_type"), F.concat(F.lit("SI"), group).alias("item_id"),
                        F.concat(F.lit("S"), group).alias("shipment_id"),
                        F.when(F.size(hits) > 0, F.sort_array(F.transform(hits, _adjustment))).alias("price_adjustments"))

    ship = F.transform(groups, lambda g: F.struct(F.lit("shipment").alias("_type"), F.concat(F.lit("S"), g).alias("shipment_id")))
    return F.sort_array(ship), F.sort_array(F.transform(groups, item))


def _default_shipping() -> tuple[Column, Column]:
    ship = F.array(F.struct(F.lit("shipment").alias("_type"), F.lit("S0").alias("shipment_id")))
    adj_type = ("array<struct<_type:string,price_adjustment_id:string,promotion_id:string,"
                "price:double,item_text:string,applied_discount:struct<_type:string,"
                "amount:double,type:string>>>")
    item = F.array(F.struct(F.lit("shipping_item").alias("_type"), F.lit("SI0").alias("item_id"),
                            F.lit("S0").alias("shipment_id"),
                            F.lit(None).cast(adj_type).alias("price_adjustments")))
    return ship, item


def order_documents(orders: DataFrame, lineitem: DataFrame, *, products: bool = True,
                    shipping: bool = True, payments: bool = True,
                    max_items: int = MAX_ITEMS) -> DataFrame:
    """Order documents, one per order (or per bounded part of a large order).

    Without ``products`` and ``shipping`` no line arrays are built; the lines only
    give ``last_modified``.
    """
    head = [order_no().alias("order_no"), F.lit("order").alias("_type"),
            F.col("o_orderdate").alias("creation_date")]
    tail = [F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("confirmation_status"),
            F.col("o_totalprice").alias("order_total"), F.lit("USD").alias("currency"),
            _customer_info().alias("customer_info")]
    if payments:
        tail.append(_payments().alias("payment_instruments"))
    if products or shipping:
        # An order is repeated per part, so that it meets its lines where they are; a part
        # of a large order that got no line is no document.
        parts = F.coalesce(F.sequence(F.lit(0).cast("bigint"), F.col("doc_parts") - 1), F.array(F.lit(0).cast("bigint")))
        heads = (orders.join(large_orders(lineitem, max_items), F.col("o_orderkey") == F.col("large_key"), "left")
                 .withColumn("_part", F.explode(parts)))
        docs = (heads.join(line_arrays(lineitem, max_items),
                           (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("_part") == F.col("doc_part")), "left")
                .filter(F.col("doc_parts").isNull() | F.col("l_orderkey").isNotNull()))
        # last_modified is the whole order's latest ship date, even for a split order
        cols = head + [F.coalesce("large_lm", "_lm").alias("last_modified"), F.coalesce("doc_parts", F.lit(1)).alias("doc_parts")] + tail
        if shipping:
            ship, item = _shipping()
            d_ship, d_item = _default_shipping()
            cols += [F.coalesce(ship, d_ship).alias("shipments"), F.coalesce(item, d_item).alias("shipping_items")]
        if products:
            cols.append(F.sort_array(F.transform("_lines", _product_item)).alias("product_items"))
        return docs.select(*cols)
    headers = order_headers(orders, lineitem)
    return headers.select(*head, F.col("last_modified"), *tail)


def customer_documents(customer: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Customer documents: sparse keys, some absent by market segment.

    e-mail absent for AUTOMOBILE, company absent for BUILDING, home phone absent
    for FURNITURE, gender absent for MACHINERY, points balance absent for
    HOUSEHOLD. With ``orders``, ``creation_date`` / ``last_modified`` are the
    customer's first and last order dates (a partial aggregate joined on the
    customer key); customers without orders have no stamps.
    """
    cid = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")

    def unless(segment: str, value: Column) -> Column:
        return F.when(seg != F.lit(segment), value)

    cols = [
        cid.alias("customer_id"),
        F.lpad(cid, 8, "0").alias("customer_no"),
        unless("AUTOMOBILE", F.concat(F.lit("customer"), cid, F.lit("@example.com"))).alias("email"),
        F.lit("Customer").alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        unless("BUILDING", seg).alias("company_name"),
        unless("FURNITURE", F.lpad((F.col("c_nationkey") * 1000 + 7).cast("string"), 10, "0"))
        .alias("phone_home"),
        unless("MACHINERY", (F.col("c_nationkey") % 3).cast("int")).alias("gender"),
        unless("HOUSEHOLD", F.col("c_acctbal")).alias("c_pointsBalance"),
        seg.alias("segment"),
    ]
    if orders is None:
        return customer.select(*cols)
    span = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("creation_date"),
                                           F.max("o_orderdate").alias("last_modified"))
    joined = customer.join(span, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(*cols, "creation_date", "last_modified")


_LANDED: dict[tuple, str] = {}


def landed_order_documents(spark, data_dir: str, max_items: int = MAX_ITEMS) -> DataFrame:
    """The order documents of ``data_dir``, read from :func:`landed_order_path`."""
    return spark.read.parquet(landed_order_path(spark, data_dir, max_items))


def landed_order_path(spark, data_dir: str, max_items: int = MAX_ITEMS) -> str:
    """Folder of the order documents of ``data_dir``, landed once per session as Parquet
    in the shared checkpoint folder.

    Like landed search responses, the documents are written once and read by
    every job that needs them; reads prune nested columns, so a job using only
    ``product_items`` does not read the payment or shipping arrays. The written
    table also cuts the lineage: a lost executor re-reads files instead of
    re-running the nesting aggregation.
    """
    from cartloom.session import scratch_path, session_key
    from cartloom.sources.tables import Tables

    # The files' times and sizes are part of the key: changed tables are landed again.
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([f"{data_dir}/orders.parquet", f"{data_dir}/lineitem.parquet"])
             .select("path", "modificationTime", "length").collect())
    key = (session_key(spark), data_dir, int(max_items), tuple(sorted(map(tuple, files))))
    path = _LANDED.get(key)
    if path is None:
        t = Tables(spark, data_dir)
        path = scratch_path(spark, "landed-order-documents")
        order_documents(t.orders, t.lineitem, max_items=max_items).write.parquet(path)
        _LANDED[key] = path
    return path
