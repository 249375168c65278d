"""Landed search responses (SRC1).

A landed file holds search responses ``{total, count, hits: [{data: doc}]}``,
one per line (JSON Lines, splittable) or one per file (``multi_line=True``; a
response holds at most one page of 200 documents, so a file stays small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.schemas import CUSTOMER_ENVELOPE, ORDER_ENVELOPE


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType = ORDER_ENVELOPE,
                   multi_line: bool = False, path_glob: str | None = None) -> DataFrame:
    """Scan landed responses with an explicit schema; adds ``source_file`` and ``landed_at``
    (its modification time) and keeps the text of a response that cannot be parsed in
    ``corrupt`` (its hits are lost, so the audit fails; see :func:`request_audit`)."""
    schema = T.StructType([*schema.fields, T.StructField("corrupt", T.StringType())])
    reader = (spark.read.schema(schema).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "corrupt"))
    if multi_line:
        reader = reader.option("multiLine", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.json(path)
    return (df.withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("landed_at", F.col("_metadata.file_modification_time")))


def read_order_envelopes(spark, path, **kw) -> DataFrame:
    return read_envelopes(spark, path, ORDER_ENVELOPE, **kw)


def read_customer_envelopes(spark, path, **kw) -> DataFrame:
    return read_envelopes(spark, path, CUSTOMER_ENVELOPE, **kw)


def explode_hits(envelopes: DataFrame, keep: tuple[str, ...] = ("total", "count"),
                 position: bool = False) -> DataFrame:
    """One row per hit: envelope columns in ``keep`` plus the fields of ``data``.

    No shuffle: ``explode`` is a narrow generator inside the scan's stage.
    """
    keep = [c for c in keep if c in envelopes.columns]
    if position:
        exploded = envelopes.select(*keep, F.posexplode("hits").alias("hit_pos", "h"))
        return exploded.select(*keep, F.col("hit_pos").cast("int").alias("hit_pos"), "h.data.*")
    exploded = envelopes.select(*keep, F.explode("hits").alias("h"))
    return exploded.select(*keep, "h.data.*")


def documents(envelopes: DataFrame) -> DataFrame:
    """The documents of all hits, as top-level columns (none of broken responses)."""
    if "corrupt" in envelopes.columns:
        envelopes = envelopes.filter(F.col("corrupt").isNull())
    return explode_hits(envelopes, keep=())


def envelope_audit(envelopes: DataFrame, by: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """Whether the landed responses are whole, per ``by`` (AGG1): ``n_responses``,
    ``n_corrupt``, ``expected`` (the totals that first pages report), ``landed`` (hits
    received) and ``whole``."""
    broken = F.col("corrupt").isNotNull() if "corrupt" in envelopes.columns else F.lit(False)
    start = F.coalesce(F.col("start"), F.lit(0)) if "start" in envelopes.columns else F.lit(0)
    hits = F.greatest(F.coalesce(F.size("hits"), F.lit(0)), F.lit(0))
    per = envelopes.select(*by, broken.alias("broken"),
                           F.when(~broken & (start == 0), F.coalesce("total", F.lit(0))).alias("first_total"),
                           F.when(broken, F.lit(0)).otherwise(hits).alias("n_hits"))
    sums = per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_responses"), F.count_if("broken").alias("n_corrupt"),
        F.coalesce(F.sum("first_total"), F.lit(0)).cast("bigint").alias("expected"),
        F.sum("n_hits").cast("bigint").alias("landed"))
    return sums.withColumn("whole", (F.col("n_corrupt") == 0) & (F.col("expected") == F.col("landed")))


#: A landed file's label: entity, field, day, slice and, for a paged request, its page.
FILE_LABEL = r"([^/]+_on_([^/]+)_(\d{4}-\d{2}-\d{2})_\d{2}_\d{2}_\d{2}_to_[^/_]+_\d{2}_\d{2})(?:_P\d+)?\.[^/]*$"


def with_request(envelopes: DataFrame) -> DataFrame:
    """Responses with the request they answer (SRC1, AGG1): ``request`` (its key; null if
    unknown), ``request_field`` and ``request_day``.

    The key is the field and range that the response repeats or else the label of its file
    without the page, so the pages of one request meet whatever files they landed in.
    """
    label = lambda group: F.nullif(F.regexp_extract("source_file", FILE_LABEL, group), F.lit(""))
    field = lo = hi = F.lit(None).cast("string")
    if "query" in envelopes.columns:
        field, lo, hi = (F.col(f"query.filtered_query.filter.range_filter.{n}") for n in ("field", "from", "to"))
    echoed = F.when(field.isNotNull() & (lo.isNotNull() | hi.isNotNull()),
                    F.concat_ws(" ", field, F.coalesce(lo, F.lit("*")), F.coalesce(hi, F.lit("*"))))
    day = F.coalesce(F.try_to_date(F.substring(lo, 1, 10)), F.try_to_date(label(3)))
    return (envelopes.withColumn("request", F.coalesce(echoed, label(1)))
            .withColumn("request_field", F.coalesce(field, label(2))).withColumn("request_day", day))


def _pages(envelopes: DataFrame) -> DataFrame:
    """Narrow rows of landed responses: request, day, file, place and hits."""
    broken = F.col("corrupt").isNotNull() if "corrupt" in envelopes.columns else F.lit(False)
    start = F.coalesce("start", F.lit(0)) if "start" in envelopes.columns else F.lit(0)
    hits = F.greatest(F.coalesce(F.size("hits"), F.lit(0)), F.lit(0))
    landed = F.col("landed_at") if "landed_at" in envelopes.columns else F.lit(None).cast("timestamp")
    return with_request(envelopes).select(
        "request", "request_day", "source_file", landed.alias("landed_at"), broken.alias("broken"),
        start.cast("bigint").alias("start"), hits.cast("bigint").alias("n_hits"), F.col("total").cast("bigint").alias("total"))


def _last_pages(pages: DataFrame) -> DataFrame:
    """Of the landings of each page of a known request the last one."""
    last = F.max_by(F.struct("n_hits", "total", "landed_at", "source_file"), F.struct("landed_at", "source_file", "n_hits", "total"))
    return (pages.filter(F.col("request").isNotNull() & ~F.col("broken")).groupBy("request", "start")
            .agg(last.alias("p"), F.count(F.lit(1)).alias("n_landings"), F.count_distinct("source_file").alias("n_files"),
                 F.max("request_day").alias("request_day"))
            .select("request", "request_day", "start", "n_landings", "n_files", "p.*"))


def latest_pages(envelopes: DataFrame) -> DataFrame:
    """Landed responses without those pages of which a later file holds another landing.

    Only pages that landed in several files are looked up, so the responses themselves are
    not shuffled while these are few. Two landings of a page in one file both stay; equal
    documents merge later. Responses of unknown requests stay.
    """
    pages = with_request(envelopes).withColumn("_start", F.coalesce("start", F.lit(0)).cast("bigint"))
    again = _last_pages(_pages(envelopes)).filter(F.col("n_files") > 1).select(
        F.col("request").alias("_request"), F.col("start").alias("_page"), F.col("source_file").alias("_file"))
    same = (F.col("request") == F.col("_request")) & (F.col("_start") == F.col("_page"))
    kept = pages.join(again, same, "left").filter(F.col("_file").isNull() | (F.col("source_file") == F.col("_file")))
    return kept.select(*envelopes.columns)


def request_audit(envelopes: DataFrame) -> DataFrame:
    """Whether every request has landed whole, over all its files (AGG1).

    One row per request: ``request``, ``request_day``, ``n_pages`` (different pages),
    ``n_repeats`` (further landings of a page; the last one counts), ``n_corrupt``,
    ``expected`` (the total that the last landed page reports), ``landed`` (its hits),
    ``n_breaks`` and ``whole``. Pages must cover the offsets from 0 to the total without a gap
    and none twice: a page adds 1 at its first offset and takes 1 off at its end, the request
    takes 1 off at 0 and adds 1 at its total, and ``n_breaks`` counts the offsets whose sum is
    not 0. These are sums by (request, offset), so a request of many pages is no single group.

    Responses of unknown requests, and corrupt ones whose file has no label, are judged
    together by folder: the totals of first pages against all hits.
    """
    pages = _pages(envelopes)
    kept = _last_pages(pages)
    latest = F.max_by("total", F.struct("landed_at", "source_file", "start"))
    per = kept.groupBy("request").agg(
        F.max("request_day").alias("request_day"), F.count(F.lit(1)).alias("n_pages"),
        F.sum(F.col("n_landings") - 1).cast("bigint").alias("n_repeats"),
        latest.alias("expected"), F.sum("n_hits").cast("bigint").alias("landed"))
    point = lambda at, step: F.struct(at.alias("at"), F.lit(step).alias("step"))
    start, end = F.col("start"), F.col("start") + F.col("n_hits")
    steps = kept.select("request", F.explode(F.array(point(start, 1), point(end, -1))).alias("s")).unionByName(
        per.select("request", F.explode(F.array(point(F.lit(0).cast("bigint"), -1), point(F.coalesce("expected", F.lit(-1)), 1))).alias("s")))
    breaks = (steps.groupBy("request", "s.at").agg(F.sum("s.step").alias("sum")).filter(F.col("sum") != 0)
              .groupBy("request").agg(F.count(F.lit(1)).alias("n_breaks")))
    corrupt = (pages.filter(F.col("request").isNotNull() & F.col("broken")).groupBy("request")
               .agg(F.count(F.lit(1)).alias("n_corrupt"), F.max("request_day").alias("corrupt_day")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    known = (per.join(breaks, "request", "left").join(corrupt, "request", "full_outer")
             .select("request", F.coalesce("request_day", "corrupt_day").alias("request_day"), zero("n_pages"), zero("n_repeats"),
                     zero("n_corrupt"), "expected", zero("landed"), zero("n_breaks"))
             .withColumn("whole", (F.col("n_pages") > 0) & (F.col("n_breaks") == 0)))
    folder = F.regexp_replace("source_file", "/[^/]*$", "")
    first = F.when(~F.col("broken") & (F.col("start") == 0), F.coalesce("total", F.lit(0)))
    unknown = (pages.filter(F.col("request").isNull()).groupBy(folder.alias("request")).agg(
        F.max("request_day").alias("request_day"), F.count_if(~F.col("broken")).alias("n_pages"), F.lit(0).cast("bigint").alias("n_repeats"),
        F.count_if("broken").alias("n_corrupt"), F.coalesce(F.sum(first), F.lit(0)).cast("bigint").alias("expected"),
        F.sum(F.when(F.col("broken"), F.lit(0)).otherwise(F.col("n_hits"))).cast("bigint").alias("landed"))
        .withColumn("n_breaks", (F.col("expected") != F.col("landed")).cast("bigint"))
        .withColumn("whole", (F.col("n_corrupt") == 0) & (F.col("n_breaks") == 0)))
    return known.unionByName(unknown)


def broken_responses(envelopes: DataFrame) -> DataFrame:
    """Text of the responses that cannot be parsed, with their file and reported total."""
    return envelopes.filter(F.col("corrupt").isNotNull()).select("source_file", "total", "corrupt")


def parse_json_column(col, schema) -> Column:
    """Parse a JSON text column with a DDL or ``StructType`` schema (nulls when malformed)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema)


def _probe_schema() -> T.StructType:
    return T.StructType([T.StructField("total", T.LongType()), T.StructField("count", T.LongType()),
                         T.StructField("field", T.StringType()),
                         T.StructField("run_date", T.DateType())])


def read_probe_totals(spark: SparkSession, path: str) -> DataFrame:
    """Source totals from landed probe responses (AGG1, AGG2).

    A probe is the whole-day request on one stamp field; its response's ``total``
    is what the service reports; of a probe that landed several times the last one
    counts. Responses are landed under
    ``<path>/field=<creation_date|last_modified>/run_date=<yyyy-MM-dd>/``; the
    result has one row per day: ``run_date, total_created, total_modified,
    total_records`` (their sum, as reported).
    """
    landed = spark.read.schema(_probe_schema()).json(path)
    last = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("total"))
    probes = landed.groupBy("field", "run_date").agg(F.max_by("total", last).alias("total"))
    per_day = probes.groupBy("run_date").agg(
        F.sum(F.when(F.col("field") == "creation_date", F.col("total")).otherwise(F.lit(0)))
        .alias("total_created"),
        F.sum(F.when(F.col("field") == "last_modified", F.col("total")).otherwise(F.lit(0)))
        .alias("total_modified"))
    return per_day.withColumn("total_records", F.col("total_created") + F.col("total_modified"))
