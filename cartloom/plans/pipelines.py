"""Day pipelines: orders, customers and the payments backfill (section 3 of the
blueprint), as one lazy Spark plan per entity.

A run takes the landed documents of a day (or of a range of days), builds the
entity tables, merges them with explicit deduplication rules, counts them,
reconciles the counts with the service's totals and publishes only the days
that pass, each with a marker carrying the source total. Counts reach the
driver only as the small per-day audit frame returned to the caller.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom import schemas
from cartloom.functions.labels import day_file_name
from cartloom.functions.timefmt import parse_utc, run_date_text, to_pacific
from cartloom.operators import conform as C
from cartloom.operators import flatten as FL
from cartloom.operators import merge as M
from cartloom.operators import quality as Q
from cartloom.session import scratch_path
from cartloom.sinks.publish import commit_days, land_verdicts, new_version, publish_days
from cartloom.sources.envelope import broken_responses, request_audit


@dataclass
class DayRun:
    """What a run produced: entity tables (lazy), the audit and the verdicts."""

    tables: dict[str, DataFrame]
    audit: DataFrame
    verdicts: DataFrame
    quarantined: DataFrame | None = None
    written: dict[str, str] = field(default_factory=dict)
    version: str | None = None


def _with_run_date(df: DataFrame, created: str, modified: str, run_dates=None) -> DataFrame:
    """Attach the run day(s) a row belongs to: its creation and modification days, of
    which only ``run_dates`` are kept if given."""
    rows = M.change_feed(df, created, modified, "run_date")
    return rows.filter(F.col("run_date").isin(list(run_dates))) if run_dates else rows


def _file_name(entity: str) -> F.Column:
    return day_file_name(entity, run_date_text(F.col("run_date")))


def order_tables(docs: DataFrame, sep: str = ".", compat: bool = False,
                 strict: bool = False, run_dates=None) -> dict[str, DataFrame]:
    """Merged day tables of orders, product lines, option items and payments, of all
    days or of ``run_dates`` only (chosen before any shuffle).

    * orders: slice rows + two Pacific columns + lineage, one row per order and
      day; among versions differing only in their stamps the latest
      ``last_modified`` wins (N8 made deterministic);
    * products: personalisation text set to ``NAN``, rows without a product id
      dropped, distinct (PRJ7, FLT3, AGG5);
    * option items and payments: lineage, distinct.
    """
    stamps = ["order_creation_date", "order_last_modified"]
    orders = FL.order_headers(docs, sep=sep, compat=compat, strict=strict)
    orders = C.conform(orders, [*[c for c in orders.columns if c not in stamps], *stamps],
                       {c: T.TimestampNTZType() for c in stamps})
    orders = _with_run_date(orders, *stamps, run_dates)
    # The rows are told apart by what the documents say, before the columns that follow from it.
    subset = [c for c in orders.columns if c not in stamps]
    orders = M.dedup_first(orders, subset, [("order_last_modified", True),
                                            ("order_creation_date", True)])
    orders = FL.published_orders(orders, sep=sep, carry=["run_date"])
    orders = (orders
              .withColumn("order_creation_pst_date", to_pacific("order_creation_date"))
              .withColumn("order_last_modified_pst_date", to_pacific("order_last_modified"))
              .withColumn("file_name", _file_name(schemas.ORDERS_FILE_WORD)))
    orders = C.conform(orders, ["run_date"] + C.rename_separator(schemas.ORDER_COLUMNS, sep))

    # The product, option and payment tables are keyed by the order's run days
    # too: the days ride along from the document and are exploded in the same
    # projection (no join, no shuffle).
    days = F.array_compact(F.array_distinct(F.array(
        F.to_date(_stamp(docs, "creation_date")), F.to_date(_stamp(docs, "last_modified")))))
    if run_dates:
        days = F.filter(days, lambda d: d.isin(list(run_dates)))
    dated = docs.withColumn("_days", days).filter(F.size("_days") > 0)

    def by_day(rows: DataFrame) -> DataFrame:
        cols = [c for c in rows.columns if c != "_days"]
        return rows.select(F.explode("_days").alias("run_date"), *[C.ref(c) for c in cols])

    def product_lines(docs: DataFrame) -> DataFrame:
        rows = FL.product_rows(docs, sep=sep, strict=strict, carry=["_days"])
        rows = C.override_constant(rows, "product_item_c_personalizationJson")
        return by_day(M.drop_missing_key(rows, "product_item_product_id"))

    # Equal lines are of one order: only the lines of orders that may have some are shuffled.
    again = _may_repeat_lines(dated, strict)
    products = product_lines(dated.filter(~again)).unionByName(M.dedup_all(product_lines(dated.filter(again))))
    products = products.withColumn("file_name", _file_name(schemas.PRODUCTS_FILE_WORD))
    products = C.conform(products, ["run_date"] + schemas.PRODUCT_COLUMNS)

    options = by_day(FL.option_item_rows(dated, sep=sep, strict=strict, carry=["_days"]))
    options = options.withColumn("file_name", _file_name(schemas.OPTION_ITEMS_FILE_WORD))
    options = M.dedup_all(C.conform(options, ["run_date"] + schemas.OPTION_ITEM_COLUMNS))

    payments = by_day(FL.payment_rows(dated, sep=sep, strict=strict, carry=["_days"],
                                      dedup=False).drop("file_name"))
    payments = payments.withColumn("file_name", _file_name(schemas.PAYMENTS_FILE_WORD))
    payments = M.dedup_all(C.conform(payments, ["run_date"] + C.rename_separator(
        schemas.PAYMENT_COLUMNS, sep)))
    return {"orders": orders, "products": products, "option_items": options,
            "payments": payments}


#: Words of 64 bits that mark, by hash of its number, an order whose lines may repeat.
REPEAT_WORDS = 1 << 16


def _may_repeat_lines(docs: DataFrame, strict: bool = False) -> F.Column:
    """Whether a document's product rows may equal others: its order has several documents, or
    two of its lines agree in the plain published fields. True for some orders more (hashes that
    share a bit), never false for one that repeats. What is shuffled for it is a count per order;
    the marks have a fixed size."""
    valid = FL.valid_documents(docs, strict)
    own = F.lit(False)
    if "product_items" in docs.columns:
        published = {f"product_item_{f.name}": f for f in docs.schema["product_items"].dataType.elementType.fields}
        plain = [f.name for n, f in published.items() if n in schemas.PRODUCT_COLUMNS and isinstance(f.dataType, T.AtomicType)
                 and n != "product_item_c_personalizationJson"]
        lines = F.transform("product_items", lambda i: F.xxhash64(*[i.getField(n) for n in plain] or [F.lit(0)]))
        own = F.coalesce(F.size(F.array_distinct(lines)) < F.size(lines), F.lit(False))
    slot = F.pmod(F.xxhash64("order_no"), F.lit(64 * REPEAT_WORDS))
    bit = (slot % 64).cast("int")
    repeated = (valid.groupBy("order_no").agg(F.count(F.lit(1)).alias("n"), F.max(own).alias("own")).filter("n > 1 OR own")
                .select((slot / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits")))
    every = docs.sparkSession.range(REPEAT_WORDS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = repeated.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    marks = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("marks")).scalar()
    word = F.get(marks, (slot / 64).cast("int"))
    return F.call_function("shiftright", word, bit).bitwiseAND(F.lit(1)) == 1


def _stamp(docs: DataFrame, name: str) -> F.Column:
    dtype = docs.schema[name].dataType if name in docs.columns else T.StringType()
    c = F.col(name) if name in docs.columns else F.lit(None).cast("string")
    return parse_utc(c) if isinstance(dtype, T.StringType) else c


CUSTOMER_SLICE_COLUMNS = [c for c in schemas.CUSTOMER_COLUMNS
                          if not c.endswith("_pst") and c != "file_name"]


def customer_slice_rows(docs: DataFrame, carry=()) -> DataFrame:
    """Customer rows of a slice (31 columns): stamps parsed, text keys default to
    '' and numeric keys to NaN, gender stays null (PRJ9). An absent text key is
    published as null ('' reads back as null from a flat file), so it is null here."""
    carry = list(carry)
    present = set(docs.columns)
    rows = docs
    for name in schemas.CUSTOMER_STAMP_COLUMNS:
        if name in present:
            rows = rows.withColumn(name, _stamp(rows, name))
    text_cols = [f.name for f in schemas.CUSTOMER_DOCUMENT.fields
                 if isinstance(f.dataType, T.StringType)
                 and f.name not in schemas.CUSTOMER_STAMP_COLUMNS]
    rows = C.conform(rows, [f.name for f in schemas.CUSTOMER_DOCUMENT.fields] + carry,
                     {**{f.name: f.dataType for f in schemas.CUSTOMER_DOCUMENT.fields},
                      **{n: T.TimestampNTZType() for n in schemas.CUSTOMER_STAMP_COLUMNS}})
    rows = C.fill_defaults(rows, {c: "" for c in text_cols})
    rows = C.fill_defaults(rows, {c: float("nan") for c in schemas.CUSTOMER_NUMERIC_COLUMNS})
    rows = rows.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) if c in text_cols
                         else F.col(c) for c in rows.columns])
    return C.conform(rows, CUSTOMER_SLICE_COLUMNS + carry)


def _customer_merge(rows: DataFrame) -> DataFrame:
    """Merge rules of a customer day: six Pacific columns, lineage, distinct."""
    for name in schemas.CUSTOMER_STAMP_COLUMNS:
        rows = rows.withColumn(f"{name}_pst", to_pacific(name))
    rows = rows.withColumn("file_name", _file_name(schemas.CUSTOMERS_FILE_WORD))
    return M.dedup_all(C.conform(rows, ["run_date"] + schemas.CUSTOMER_COLUMNS))


def customer_table(docs: DataFrame, run_dates=None) -> DataFrame:
    """Merged day table of customers: defaults for absent keys, six Pacific columns,
    lineage, distinct (PRJ9, FUN4, PRJ6, AGG5). Personal fields pass through, as
    published (N18)."""
    rows = _with_run_date(customer_slice_rows(docs), "creation_date", "last_modified", run_dates)
    return _customer_merge(rows)


def _publish(run: DayRun, source: DataFrame, out: str | None, entity: str, run_dates,
             envelopes: DataFrame | None) -> DayRun:
    """Judge the run's days and, with ``out``, publish those that pass as one commit.

    Only ``run_dates`` are judged and written (required with ``out``): rows of other days
    in the documents are that day's business. A day passes only if all its requests landed
    whole (:func:`~cartloom.sources.envelope.request_audit`); a request of unknown day counts
    against every day. The markers, written last, make the run's version the valid one of its
    days; a day that does not pass is retracted.
    """
    days = sorted(run_dates or ())
    if out and not days:
        raise ValueError("publishing needs the run dates")
    if days:
        run.verdicts = run.verdicts.filter(F.col("run_date").isin(days))
    if envelopes is not None:
        lost = request_audit(envelopes).filter(~F.col("whole")).groupBy("request_day").agg(F.count(F.lit(1)).alias("n_lost"))
        anywhere = lost.filter(F.col("request_day").isNull()).agg(F.coalesce(F.sum("n_lost"), F.lit(0))).scalar()
        columns = run.verdicts.columns
        run.verdicts = (run.verdicts.join(lost, run.verdicts["run_date"] == lost["request_day"], "left")
                        .withColumn("passed", F.col("passed") & F.col("n_lost").isNull() & (anywhere == 0)).select(*columns))
    if out:
        base, run.version = out.rstrip("/"), new_version()
        run.verdicts = land_verdicts(run.verdicts, f"{base}/_verdicts", entity, run.version)
        run.written = publish_days(run.tables, run.verdicts, base, version=run.version)
        stamp = "-".join(f"{d:%Y%m%d}" for d in (days[0], days[-1]))
        rejected = {"documents": run.quarantined,
                    "responses": broken_responses(envelopes) if envelopes is not None else None}
        for kind, rows in rejected.items():
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{base}/_quarantine/{entity}/{kind}/{stamp}")
        in_run = source.filter(F.col("run_date").isin(days))
        commit_days(in_run, run.verdicts, base, entity, run.version, days, list(run.tables))
    return run


def run_orders(docs: DataFrame, source: DataFrame, out: str | None = None, *,
               run_dates=None, envelopes: DataFrame | None = None,
               compat: bool = False, strict: bool = False, mode: str = "or") -> DayRun:
    """Orders of the run dates (without them: of every day present in ``docs``).

    ``source``: the service's per-day totals (``run_date, total_created,
    total_modified, total_records``), from its probe responses
    (:func:`~cartloom.sources.envelope.read_probe_totals`). With ``envelopes`` (the landed
    responses the documents come from) a day also fails if one of its requests is not whole.
    With ``out`` the passing run dates are published under ``out/<entity>/``, verdicts under
    ``out/_verdicts``, markers under ``out/_markers`` and rejected documents and responses
    under ``out/_quarantine``; files and markers of other days stay as they are. Read the
    published rows with :func:`~cartloom.sinks.publish.read_published`.
    """
    tables = order_tables(docs, sep=".", compat=compat, strict=strict, run_dates=run_dates)
    audit = Q.day_counts(tables["orders"], "run_date", "order_order_no", "order_creation_date",
                         "order_last_modified")
    verdicts = Q.reconcile(source, audit, "run_date", mode)
    run = DayRun(tables, audit, verdicts, FL.quarantine(docs))
    return _publish(run, source, out, "orders", run_dates, envelopes)


def run_customers(docs: DataFrame, source: DataFrame, out: str | None = None, *,
                  run_dates=None, envelopes: DataFrame | None = None) -> DayRun:
    """Customers of the run dates; created counts decide (DQ2). See :func:`run_orders`."""
    table = customer_table(docs, run_dates)
    audit = Q.day_counts(table, "run_date", "customer_no", "creation_date", "last_modified")
    verdicts = Q.reconcile(source, audit, "run_date", "created")
    run = DayRun({"customers": table}, audit, verdicts)
    return _publish(run, source, out, "customers", run_dates, envelopes)


def source_totals_of(docs: DataFrame, key: str = "order_no") -> DataFrame:
    """Per-day totals of landed documents, as the service reports them: one
    version per ``key`` (the latest modification), then counted per day."""
    d = docs.select(C.ref(key).alias("k"), _stamp(docs, "creation_date").alias("c"),
                    _stamp(docs, "last_modified").alias("m"))
    latest = M.dedup_first(d, ["k"], [("m", True), ("c", True)])
    return Q.source_totals(latest, "c", "m")


def backfill_payments(docs: DataFrame, first: str, last: str, sep: str = ".") -> DataFrame:
    """Payment instruments of orders created in ``[first, last]``, all days in one
    job (SRC6, JON2); rows carry their creation day as ``run_date``."""
    created = F.to_date(_stamp(docs, "creation_date"))
    in_range = docs.filter(created.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    pays = FL.payment_rows(in_range.withColumn("run_date", created), sep=sep, carry=["run_date"],
                           dedup=False)
    pays = pays.drop("file_name").withColumn("file_name", _file_name(schemas.PAYMENTS_FILE_WORD))
    return M.dedup_all(C.conform(pays, ["run_date"] + C.rename_separator(
        schemas.PAYMENT_COLUMNS, sep)))


# --------------------------------------------------------------------------
# The file-based flow: extract a day into slice files, merge the slice files
# --------------------------------------------------------------------------
ORDER_FIELDS = ("creation_date", "last_modified")


def extract_day(docs: DataFrame, run_date: str, out: str, field: str = "creation_date", *,
                ladder=schemas.ORDER_LADDER, cap: int = schemas.PAGE_SIZE) -> None:
    """One day's extraction on one stamp field, as the request loop lands it.

    The documents whose ``field`` falls on ``run_date`` are assigned to the slice
    whose request returns them (refining over-full slices), flattened into the four entity slice tables and
    written one folder per field and slice under ``out/<entity>/`` (SNK1).
    """
    from cartloom.operators import slicing as SL
    from cartloom.sinks.publish import write_slices

    stamp = _stamp(docs, field)
    day = docs.withColumn("_ts", stamp).filter(F.to_date("_ts") == F.to_date(F.lit(run_date)))
    sliced = SL.assign_slices(day, "_ts", ladder, cap, sort=["creation_date", "order_no"])
    sliced = sliced.withColumn("slice_start", F.date_format("slice_start", "HH_mm_ss"))
    # Four tables are cut from the same slices: they are assigned and landed once.
    path = scratch_path(docs.sparkSession, "sliced-documents")
    sliced.write.parquet(path)
    sliced = docs.sparkSession.read.schema(sliced.schema).parquet(path)
    carry = ["slice_start"]
    tables = {"orders": FL.order_rows(sliced, sep=".", carry=carry),
              "products": FL.product_rows(sliced, sep=".", carry=carry),
              "option_items": FL.option_item_rows(sliced, sep=".", carry=carry),
              "payments": FL.payment_rows(sliced, sep=".", carry=carry)}
    for entity, table in tables.items():
        write_slices(table, f"{out.rstrip('/')}/{entity}/run_date={run_date}/extraction_field={field}",
                     keys=carry)


def _day_slices(spark, out: str, entity: str, run_date: str, schema: T.StructType,
                fmt: str = "csv") -> DataFrame:
    """The slice files of one day: the entity folder is scanned with an explicit
    schema and the day picked by a partition filter (pruned at file listing), so
    a day without files gives an empty, typed frame (N15). ``fmt="parquet"``
    reads the streaming ingest's slice tables."""
    from cartloom.sources.flatfiles import read_pipe_csv

    parts = T.StructType(list(schema.fields) + [
        T.StructField("run_date", T.DateType()), T.StructField("extraction_field", T.StringType()),
        T.StructField("slice_start", T.StringType())]
        + ([T.StructField("page_no", T.LongType())] if entity == "customers" else []))
    base = f"{out.rstrip('/')}/{entity}"
    if fmt == "parquet":
        rows = spark.read.parquet(base)
    else:
        rows = read_pipe_csv(spark, base, parts)
    day = rows.filter(F.col("run_date") == F.to_date(F.lit(run_date)))
    return day.select(*[C.ref(f.name) for f in schema.fields], "run_date")


def slice_schemas(docs: DataFrame) -> dict[str, T.StructType]:
    """Schemas of the four slice tables (an explicit schema for the scans)."""
    return {"orders": FL.order_rows(docs, sep=".").schema,
            "products": FL.product_rows(docs, sep=".").schema,
            "option_items": FL.option_item_rows(docs, sep=".").schema,
            "payments": FL.payment_rows(docs, sep=".").schema}


def merge_day_files(spark, out: str, run_date: str,
                    schemas_by_entity: dict[str, T.StructType],
                    fmt: str = "csv") -> dict[str, DataFrame]:
    """Scan every slice file of a day (SRC3/SRC4) and apply the merge rules: the
    day's order, product, option and payment tables (section 3.1 merge step).
    ``fmt="parquet"`` merges the streaming ingest's slice tables instead."""
    read = {e: _day_slices(spark, out, e, run_date, sch, fmt)
            for e, sch in schemas_by_entity.items()}
    orders = (read["orders"]
              .withColumn("order_creation_pst_date", to_pacific("order_creation_date"))
              .withColumn("order_last_modified_pst_date", to_pacific("order_last_modified"))
              .withColumn("file_name", _file_name(schemas.ORDERS_FILE_WORD)))
    order_cols = ["run_date"] + schemas.ORDER_COLUMNS
    orders = C.conform(orders, order_cols)
    subset = [c for c in order_cols if c not in schemas.ORDER_STAMP_COLUMNS]
    orders = M.dedup_first(orders, subset, [("order_last_modified", True),
                                            ("order_creation_date", True)])
    products = C.override_constant(read["products"], "product_item_c_personalizationJson")
    products = M.drop_missing_key(products, "product_item_product_id") \
        .withColumn("file_name", _file_name(schemas.PRODUCTS_FILE_WORD))
    products = M.dedup_all(C.conform(products, ["run_date"] + schemas.PRODUCT_COLUMNS))
    options = read["option_items"].withColumn("file_name", _file_name(schemas.OPTION_ITEMS_FILE_WORD))
    options = M.dedup_all(C.conform(options, ["run_date"] + schemas.OPTION_ITEM_COLUMNS))
    payments = read["payments"].drop("file_name") \
        .withColumn("file_name", _file_name(schemas.PAYMENTS_FILE_WORD))
    payments = M.dedup_all(C.conform(payments, ["run_date"] + schemas.PAYMENT_COLUMNS))
    return {"orders": orders, "products": products, "option_items": options,
            "payments": payments}


def extract_customers_day(docs: DataFrame, run_date: str, out: str,
                          field: str = "creation_date", *, ladder=schemas.CUSTOMER_LADDER,
                          cap: int = schemas.PAGE_SIZE, page_size: int = schemas.PAGE_SIZE) -> None:
    """One day's customer extraction on one stamp field: customers assigned to
    slices (1 h refined down to 1 s) and pages, written one folder per field,
    slice and page (the ``_P<page>`` files)."""
    from cartloom.operators import slicing as SL
    from cartloom.sinks.publish import write_slices

    day = docs.withColumn("_ts", _stamp(docs, field)) \
        .filter(F.to_date("_ts") == F.to_date(F.lit(run_date)))
    sliced = SL.assign_slices(day, "_ts", ladder, cap, sort=["_ts", "customer_id"],
                              page_size=page_size)
    sliced = sliced.withColumn("slice_start", F.date_format("slice_start", "HH_mm_ss"))
    keys = ["slice_start", "page_no"]
    write_slices(customer_slice_rows(sliced, carry=keys),
                 f"{out.rstrip('/')}/customers/run_date={run_date}/extraction_field={field}", keys=keys)


def merge_customer_files(spark, out: str, run_date: str) -> DataFrame:
    """Scan every customer slice file of a day with an explicit schema (customer
    number and phones as text) and apply the merge rules."""
    from cartloom.sources.flatfiles import read_pipe_csv

    schema = T.StructType([T.StructField(c, T.TimestampNTZType() if c in
                                         schemas.CUSTOMER_STAMP_COLUMNS else
                                         dict((f.name, f.dataType) for f in
                                              schemas.CUSTOMER_DOCUMENT.fields)[c])
                           for c in CUSTOMER_SLICE_COLUMNS])
    return _customer_merge(_day_slices(spark, out, "customers", run_date, schema))
