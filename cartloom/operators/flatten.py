"""Flatten nested order documents into entity tables (PRJ1, PRJ2, PRJ10, JON1-JON4,
FUN12, FUN13).

Every operator here is a projection plus ``explode`` / ``explode_outer``: narrow
transformations that run inside the scan's stage, with no shuffle and no join.
Parent keys ride along in the same ``select`` (PRJ10), which replaces the
constant-key Cartesian merges of a per-document loop.

Array semantics
---------------
* absent ``product_items`` or first-item ``price_adjustments`` -> one null row
  (``explode_outer``);
* absent ``payment_instruments`` / ``shipments`` / ``shipping_items`` -> the
  document is quarantined with a reason (:func:`quarantine`);
* a present but empty array -> ``strict=True`` drops the order from the order
  and product tables (both come from the full product, where an empty factor
  empties everything); option items and payments are written separately and
  keep it. ``strict=False`` (default) keeps the order everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom import schemas
from cartloom.functions.masking import masked_text, sha256_text
from cartloom.functions.timefmt import parse_utc
from cartloom.operators.conform import as_text, conform, ref, rename_separator

REQUIRED_ARRAYS = ("payment_instruments", "shipments", "shipping_items")


# --------------------------------------------------------------------------
# Schema-driven flattening (PRJ1 + PRJ2)
# --------------------------------------------------------------------------
def _flat(dtype: T.StructType, base: Column | None, prefix: str, sep: str,
          path: tuple[str, ...]) -> list[Column]:
    out: list[Column] = []
    for f in dtype.fields:
        c = ref(f.name) if base is None else base.getField(f.name)
        p = path + (f.name,)
        if isinstance(f.dataType, T.StructType):
            out.extend(_flat(f.dataType, c, prefix, sep, p))
        else:
            out.append(c.alias(prefix + sep.join(p)))
    return out


def flatten(df: DataFrame, prefix: str = "", sep: str = "_",
            keep: Iterable[str] = ()) -> DataFrame:
    """Nested struct fields become ``prefix + a<sep>b`` columns; arrays stay one
    column; ``keep`` columns pass through unchanged and first. One ``select``."""
    keep = list(keep)
    rest = T.StructType([f for f in df.schema.fields if f.name not in keep])
    return df.select(*[ref(k) for k in keep], *_flat(rest, None, prefix, sep, ()))


def flatten_struct(df: DataFrame, struct_col: str, prefix: str, sep: str = "_",
                   keep: Iterable[str] = ()) -> DataFrame:
    """Flatten the fields of one struct column, keeping ``keep`` columns."""
    dtype = df.schema[struct_col].dataType
    keep = list(keep)
    return df.select(*[ref(k) for k in keep], *_flat(dtype, F.col(struct_col), prefix, sep, ()))


def _field_names(df: DataFrame) -> set[str]:
    return set(df.columns)


def _has(df: DataFrame, name: str) -> bool:
    return name in _field_names(df)


def _probe(df: DataFrame, name: str) -> Column:
    """An array column reduced to one leaf field of its elements: same nullness
    and size, but a Parquet scan then reads only that leaf (nested pruning)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return F.col(name).getField(dtype.elementType.fields[0].name)
    return F.col(name)


# --------------------------------------------------------------------------
# Document validity: quarantine and strict filters (JON1 semantics)
# --------------------------------------------------------------------------
def quarantine(docs: DataFrame) -> DataFrame:
    """Documents that cannot be flattened, with a reason; ``order_no`` + ``reason``."""
    reasons = []
    for name in REQUIRED_ARRAYS:
        if _has(docs, name):
            reasons.append(F.when(_probe(docs, name).isNull(), F.lit(f"{name} absent")))
        else:
            reasons.append(F.lit(f"{name} absent"))
    if _has(docs, "shipping_items"):
        reasons.append(F.when(F.size(_probe(docs, "shipping_items")) == 0,
                              F.lit("shipping_items empty")))
    reason = F.coalesce(*reasons)
    return docs.select("order_no", reason.alias("reason")).filter(F.col("reason").isNotNull())


def valid_documents(docs: DataFrame, strict: bool = False) -> DataFrame:
    """Documents that flatten: required arrays present (all modes), and with
    ``strict=True`` no present array empty (an empty factor empties the product)."""
    cond = F.lit(True)
    for name in REQUIRED_ARRAYS:
        if _has(docs, name):
            cond = cond & _probe(docs, name).isNotNull()
    if _has(docs, "shipping_items"):
        cond = cond & (F.size(_probe(docs, "shipping_items")) > 0)
    if strict:
        for name in REQUIRED_ARRAYS + ("product_items",):
            if _has(docs, name):
                probe = _probe(docs, name)
                cond = cond & (probe.isNull() | (F.size(probe) > 0))
        if _has(docs, "shipping_items"):
            adj = F.get(F.col("shipping_items"), 0).getField("price_adjustments")
            cond = cond & (adj.isNull() | (F.size(adj) > 0))
    return docs.filter(cond)


# --------------------------------------------------------------------------
# Entity tables of one slice
# --------------------------------------------------------------------------
ORDER_SLICE_COLUMNS = [c for c in schemas.ORDER_COLUMNS
                       if c not in ("order_creation_pst_date", "order_last_modified_pst_date",
                                    "file_name")]
PRODUCT_SLICE_COLUMNS = [c for c in schemas.PRODUCT_COLUMNS if c != "file_name"]
OPTION_SLICE_COLUMNS = [c for c in schemas.OPTION_ITEM_COLUMNS if c != "file_name"]


def _stamps_to_ntz(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = set(names)
    out = []
    for f in df.schema.fields:
        if f.name in names and isinstance(f.dataType, T.StringType):
            out.append(parse_utc(ref(f.name)).alias(f.name))
        else:
            out.append(ref(f.name))
    return df.select(*out)


def order_rows(docs: DataFrame, sep: str = "_", compat: bool = False,
               strict: bool = False, dedup: bool = True, carry: Iterable[str] = ()) -> DataFrame:
    """Order table of a slice: order header fields flattened with prefix ``order_``,
    e-mail hashed into ``customer_emails``, personal fields dropped, conformed to
    the 32 slice columns, distinct (AGG5). Payments, shipments, adjustments and
    products never multiply the rows: the product is not built."""
    flat = order_headers(docs, sep, compat, strict, carry)
    out = published_orders(flat, sep, carry)
    return out.dropDuplicates() if dedup else out


def _email(sep: str) -> str:
    return f"order_customer_info{sep}email"


def order_headers(docs: DataFrame, sep: str = "_", compat: bool = False, strict: bool = False,
                  carry: Iterable[str] = ()) -> DataFrame:
    """What the documents say of the order columns, and the plain e-mail: the narrow rows that
    :func:`published_orders` completes, as many and as different as the published ones."""
    carry = list(carry)
    docs = valid_documents(docs, strict)
    header = [f.name for f in docs.schema.fields
              if not isinstance(f.dataType, T.ArrayType) and f.name != "source_file"
              and f.name not in carry]
    flat = flatten(docs.select(*header, *carry), prefix="order_", sep=sep, keep=carry)
    email = ref(_email(sep)) if _has(flat, _email(sep)) else F.lit(None).cast("string")
    flat = flat.withColumn(_email(sep), masked_text(email, compat))
    flat = _stamps_to_ntz(flat, ["order_creation_date", "order_last_modified"])
    # Personal fields go here: only the listed columns are published.
    cols = [c for c in rename_separator(ORDER_SLICE_COLUMNS, sep) if _has(flat, c) and c != "customer_emails"]
    number = f"order_customer_info{sep}customer_no"
    flat = flat.select(*[ref(c) for c in [*cols, _email(sep), *carry]])
    return as_text(flat, [number]) if number in cols else flat


def published_orders(headers: DataFrame, sep: str = "_", carry: Iterable[str] = ()) -> DataFrame:
    """The slice columns from :func:`order_headers`: e-mail hashed, absent columns null."""
    cols = rename_separator(ORDER_SLICE_COLUMNS, sep) + list(carry)
    out = headers.withColumn("customer_emails", sha256_text(ref(_email(sep))))
    return conform(out, cols, {"order_creation_date": T.TimestampNTZType(),
                               "order_last_modified": T.TimestampNTZType()})


def product_rows(docs: DataFrame, sep: str = "_", strict: bool = False,
                 carry: Iterable[str] = ()) -> DataFrame:
    """Product-line table of a slice (JON4): one row per product item, one null
    row for an order without ``product_items``; ``option_items`` kept as JSON
    text (FUN12). ``carry`` document columns ride along at the end."""
    carry = list(carry)
    docs = valid_documents(docs, strict)
    if not _has(docs, "product_items"):
        docs = docs.withColumn("product_items", F.lit(None).cast(
            T.ArrayType(schemas.PRODUCT_ITEM)))
    rows = docs.select(F.col("order_no").alias("order_order_no"), *carry,
                       F.explode_outer("product_items").alias("pi"))
    flat = flatten_struct(rows, "pi", prefix="product_item_", sep=sep,
                          keep=["order_order_no", *carry])
    if _has(flat, "product_item_option_items"):
        flat = flat.withColumn("product_item_option_items",
                               F.to_json(ref("product_item_option_items")))
    return conform(flat, rename_separator(PRODUCT_SLICE_COLUMNS, sep) + carry)


def option_item_rows(docs: DataFrame, sep: str = "_", strict: bool = False,
                     carry: Iterable[str] = ()) -> DataFrame:
    """Option-item table (FUN13 + PRJ10): two-level explode, parent order number,
    product id and item id copied onto every option; tax basis as text (PRJ8).

    Options do not depend on the order's other arrays, so ``strict`` (empty
    arrays drop the order from the order and product tables) does not apply here;
    quarantined documents are left out as everywhere.
    """
    del strict
    carry = list(carry)
    docs = valid_documents(docs, False)
    items = docs.select("order_no", *carry, F.explode("product_items").alias("pi"))
    opts = items.select(
        F.col("order_no"), *carry,
        F.col("pi.product_id").alias("product_items_product_id"),
        F.col("pi.item_id").alias("product_item_item_id"),
        F.explode("pi.option_items").alias("oi"))
    flat = flatten_struct(opts, "oi", prefix="option_items_", sep=sep,
                          keep=["order_no", "product_items_product_id", "product_item_item_id",
                                *carry])
    flat = as_text(flat, ["option_items_tax_basis"])
    return conform(flat, rename_separator(OPTION_SLICE_COLUMNS, sep) + carry)


def payment_rows(docs: DataFrame, sep: str = "_", file_name: Column | None = None,
                 strict: bool = False, carry: Iterable[str] = (), dedup: bool = True) -> DataFrame:
    """Payment-instrument table (JON2): one row per instrument, distinct.

    ``file_name`` fills the lineage column (the published layout has it, N7);
    ``dedup=False`` leaves the distinct to a later merge (one shuffle, not two).
    Payments pair the order with its instruments only, so ``strict`` does not
    apply here; quarantined documents are left out as everywhere.
    """
    del strict
    carry = list(carry)
    docs = valid_documents(docs, False)
    rows = docs.select(F.col("order_no").alias("order_order_no"), *carry,
                       F.explode("payment_instruments").alias("p"))
    flat = flatten_struct(rows, "p", prefix="payment_inst_", sep=sep,
                          keep=["order_order_no", *carry])
    flat = flat.withColumn("file_name", file_name if file_name is not None
                           else F.lit(None).cast("string"))
    out = conform(flat, rename_separator(schemas.PAYMENT_COLUMNS, sep) + carry)
    return out.dropDuplicates() if dedup else out


def _version(docs: DataFrame) -> list[str]:
    """What the parts of one order share and its versions do not: number and stamps."""
    return ["order_no", *[c for c in ("creation_date", "last_modified") if c in docs.columns]]


def _same_version(docs: DataFrame, a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
                                       for c in _version(docs)])


def _first_item(docs: DataFrame) -> DataFrame:
    """Per order (version) its first shipping item and how many adjustments that item has,
    over all parts: version columns, ``item_id, n_adj`` (partial aggregates)."""
    version = _version(docs)
    first = F.get(F.col("shipping_items"), 0)
    n_adj = F.coalesce(F.size(first.getField("price_adjustments").getField("_type")), F.lit(0))
    parts = docs.select(*version, first.getField("item_id").alias("item_id"),
                        F.greatest(n_adj, F.lit(0)).alias("n"))
    items = parts.groupBy(*version, "item_id").agg(F.sum("n").alias("n_adj"))
    return items.groupBy(*version).agg(F.min(F.struct("item_id", "n_adj")).alias("f")) \
        .select(*version, "f.item_id", "f.n_adj")


def _by_parts(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents that are a whole order, and those that are a part of one (``doc_parts``)."""
    if "doc_parts" not in docs.columns:
        return docs, None
    part = F.col("doc_parts") > 1
    return docs.filter(~F.coalesce(part, F.lit(False))), docs.filter(part)


def first_item_adjustments(docs: DataFrame, sep: str = "_", strict: bool = False) -> DataFrame:
    """Price adjustments of the **first** shipping item only (JON3): one null row
    when that item has none; later items' adjustments are ignored.

    A document is an order, so this is one ``explode_outer`` without a shuffle. Only orders
    that come as several documents are aggregated: their first item is the one with the least
    id, its adjustments are those of all documents, and the null row is one per order."""
    whole, parts = _by_parts(valid_documents(docs, strict))
    first = F.get(F.col("shipping_items"), 0)
    rows = whole.select(F.col("order_no").alias("order_order_no"),
                        F.explode_outer(first.getField("price_adjustments")).alias("pa"))
    if parts is not None:
        rows = rows.unionByName(_joined_adjustments(parts))
    return flatten_struct(rows, "pa", prefix="price_adjustments_", sep=sep, keep=["order_order_no"])


def _joined_adjustments(docs: DataFrame) -> DataFrame:
    """First-item adjustments of orders in parts: ``order_order_no, pa``."""
    first = F.get(F.col("shipping_items"), 0)
    items = docs.select(*_version(docs), first.getField("item_id").alias("item_id"),
                        first.getField("price_adjustments").alias("adjustments"))
    chosen = _first_item(docs)
    same = _same_version(docs, "i", "f") & F.col("i.item_id").eqNullSafe(F.col("f.item_id"))
    some = items.alias("i").join(chosen.filter("n_adj > 0").alias("f"), same).select(
        F.col("i.order_no").alias("order_order_no"), F.explode("adjustments").alias("pa"))
    none = chosen.filter("n_adj = 0").select(F.col("order_no").alias("order_order_no"),
                                             F.lit(None).cast(some.schema["pa"].dataType).alias("pa"))
    return some.unionByName(none)


def entity_product(docs: DataFrame, strict: bool = False) -> DataFrame:
    """The full per-order product order x payments x shipments x shipping items
    x first-item adjustments x products (JON1), as chained ``explode_outer``.

    Columns: ``order_no`` and one struct column per entity. Row count per order is
    the product of ``max(1, size)`` of each array (:func:`entity_product_size`). Only orders
    that come as several documents are put together first, so their lines and adjustments
    meet across documents; all others are narrow.
    """
    whole, parts = _by_parts(valid_documents(docs, strict))
    first_adj = F.get(F.col("shipping_items"), 0).getField("price_adjustments")
    rows = _exploded(whole.select("order_no", "payment_instruments", "shipments", "shipping_items",
                                  first_adj.alias("first_adjustments"), "product_items")
                     .withColumn("product_item", F.explode_outer("product_items")))
    return rows if parts is None else rows.unionByName(_exploded(_joined_arrays(parts)))


def _exploded(rows: DataFrame) -> DataFrame:
    """Every combination of the arrays beside a product line."""
    return (rows
            .withColumn("payment", F.explode_outer("payment_instruments"))
            .withColumn("shipment", F.explode_outer("shipments"))
            .withColumn("shipping_item", F.explode_outer("shipping_items"))
            .withColumn("price_adjustment", F.explode_outer("first_adjustments"))
            .select("order_no", "payment", "shipment", "shipping_item", "price_adjustment",
                    "product_item"))


def _joined_arrays(docs: DataFrame) -> DataFrame:
    """Orders in parts, a row per product line: their payments, shipments and shipping items
    (each id once, with the adjustments of all parts) and first-item adjustments. The lines are
    joined to them, not gathered."""
    version = _version(docs)
    orders = docs.groupBy(*version).agg(
        F.count(F.lit(1)).alias("parts"),
        F.max_by("payment_instruments", F.size("payment_instruments")).alias("payment_instruments"),
        F.collect_set("shipments").alias("ships"), F.collect_list("shipping_items").alias("items"))
    adjustments = lambda items: F.flatten(F.transform(F.filter(
        items, lambda i: i.getField("price_adjustments").isNotNull()), lambda i: i.getField("price_adjustments")))
    of_id = lambda rows, name, id_: F.filter(rows, lambda r: r.getField(name).eqNullSafe(id_))

    def together(arrays: str, name: str, one) -> Column:
        """Each id once if the order has several documents, the array as it is if not."""
        rows = F.flatten(F.col(arrays))
        each = F.transform(F.sort_array(F.array_distinct(F.transform(rows, lambda r: r.getField(name)))),
                           lambda id_: one(of_id(rows, name, id_)))
        return F.when(F.col("parts") == 1, F.get(F.col(arrays), 0)).otherwise(each)

    firsts = F.transform(F.filter("items", lambda a: F.size(a) > 0), lambda a: F.get(a, 0))
    least = F.get(F.sort_array(F.transform(firsts, lambda i: i.getField("item_id"))), 0)
    found = orders.select(
        *version, "payment_instruments", together("ships", "shipment_id", lambda same: F.get(same, 0)).alias("shipments"),
        together("items", "item_id", lambda same: F.get(same, 0).withField("price_adjustments", adjustments(same))).alias("shipping_items"),
        adjustments(of_id(firsts, "item_id", least)).alias("first_adjustments"))
    lines = docs.select(*version, F.explode("product_items").alias("product_item"))
    return found.alias("o").join(lines.alias("l"), _same_version(docs, "o", "l"), "left").select("o.*", "product_item")


def entity_product_size(docs: DataFrame, strict: bool = False) -> DataFrame:
    """Rows each order (each version of it) contributes to :func:`entity_product`, without
    building them: the product of ``max(1, size)`` of each array (``order_no``, ``n_rows``).

    A large order may come as several documents: lines and first-item adjustments are summed
    over them, payments and the ids of shipments and shipping items are the order's, each
    counted once. Use this to size or audit the full product.
    """
    whole, parts = _by_parts(valid_documents(docs, strict))
    size = lambda arr: F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(1)).cast("bigint")
    first = F.get(F.col("shipping_items"), 0).getField("price_adjustments")
    n = (size(_probe(whole, "payment_instruments")) * size(_probe(whole, "shipments"))
         * size(_probe(whole, "shipping_items")) * size(first.getField("_type")) * size(_probe(whole, "product_items")))
    rows = whole.select("order_no", n.alias("n_rows"))
    return rows if parts is None else rows.unionByName(_joined_product_size(parts))


def _joined_product_size(docs: DataFrame) -> DataFrame:
    """:func:`entity_product_size` of orders in parts."""
    size = lambda arr: F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(0))
    ids = lambda arr, name: F.array_sort(F.coalesce(
        F.col(arr).getField(name), F.array().cast("array<string>")))
    version = _version(docs)
    parts = docs.select(*version, size(_probe(docs, "payment_instruments")).alias("pay"),
                        ids("shipments", "shipment_id").alias("ships"),
                        ids("shipping_items", "item_id").alias("items"),
                        size(_probe(docs, "product_items")).alias("lines"))
    sizes = parts.groupBy(*version).agg(
        F.max("pay").alias("pay"), F.collect_set("ships").alias("ships"),
        F.collect_set("items").alias("items"), F.count(F.lit(1)).alias("parts"),
        F.sum(F.size("ships")).alias("n_ships"), F.sum(F.size("items")).alias("n_items"),
        F.sum("lines").alias("lines"))
    # One document: its arrays as they are; several: what they hold together.
    together = lambda c, n: F.when(F.col("parts") == 1, F.col(n)).otherwise(
        F.size(F.array_distinct(F.flatten(c))))
    first = _first_item(docs)
    factor = lambda c: F.greatest(F.lit(1), c).cast("bigint")
    n = (factor(F.col("pay")) * factor(together("ships", "n_ships"))
         * factor(together("items", "n_items")) * factor(F.col("n_adj")) * factor(F.col("lines")))
    return (sizes.alias("s").join(first.alias("f"), _same_version(docs, "s", "f"))
            .select("s.order_no", n.alias("n_rows")))


def array_as_json(col, sort: bool = True) -> Column:
    """Array column -> JSON text for a flat file (FUN12); sorted for stable text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_json(F.sort_array(c) if sort else c)
