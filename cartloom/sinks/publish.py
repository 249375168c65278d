"""Publishing as one commit per day (SNK1-SNK5, DQ3, FUN10, FUN11).

A run writes its rows into folders of its own, ``<base>/<entity>/run_date=D/version=V/``, and
then one marker per day into ``<base>/_markers`` (SNK5). The marker is the commit: it names the
version that is valid for all entities of the day, and the last one of a day counts. Until it
is there, readers see the day as it was before, so a job that is killed between two entities
changes nothing. A day that fails on a re-run gets a ``retracted`` marker, after which it shows
no rows at all; an entity without rows in the new version shows none either.

Markers are only ever added (one file per day and run, which appears by a rename or a single
put), so no reader meets a half replaced one. Files of versions that no marker names are left
for :func:`expired_files`. Rows are written straight to their target URI (local, HDFS or an
object store) through Spark's commit protocol, so a lost executor's task is simply re-run.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.functions.labels import path_part_from_end
from cartloom.functions.timefmt import published_stamps
from cartloom.schemas import CUSTOMER_STAMP_COLUMNS
from cartloom.operators.quality import publish_gate, trigger_rows
from cartloom.sources.flatfiles import read_pipe_csv, write_pipe_csv


def write_slices(df: DataFrame, path: str, keys=("extraction_field", "slice_start")) -> None:
    """One folder per key, replacing all slices under ``path``: a re-run neither doubles
    a slice nor leaves one of an earlier layout (SNK1)."""
    write_pipe_csv(df, path, partition_by=list(keys), mode="overwrite")


def write_day(df: DataFrame, path: str, day_col: str = "run_date") -> None:
    """Merged day files, one folder per day, replacing only the days written (SNK2)."""
    write_pipe_csv(df, path, partition_by=[day_col], mode="overwrite", dynamic=True)


PUBLISHED_STAMPS = {
    "orders": [("order_creation_date", "order_creation_pst_date"),
               ("order_last_modified", "order_last_modified_pst_date")],
    "customers": [(s, f"{s}_pst") for s in CUSTOMER_STAMP_COLUMNS],
}


MARKER_SCHEMA = T.StructType([
    T.StructField("total", T.LongType()), T.StructField("state", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
    T.StructField("entity", T.StringType()), T.StructField("run_date", T.DateType())])


def new_version() -> str:
    """A name for a run's folders; later runs sort after earlier ones."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish_days(tables: dict[str, DataFrame], verdicts: DataFrame, base: str,
                 day_col: str = "run_date", version: str | None = None) -> dict[str, str]:
    """Write each entity's rows of passing days to ``<base>/<entity>/`` under the run's
    ``version`` (SNK3, DQ3); they show once the version is committed.

    Stamps are printed as the published files carry them (ISO UTC text, Pacific
    text with offset); the tables themselves stay typed.
    """
    version = version or new_version()
    written = {}
    for entity, rows in tables.items():
        target = f"{base.rstrip('/')}/{entity}"
        rows = published_stamps(rows, PUBLISHED_STAMPS.get(entity, []))
        rows = publish_gate(rows, verdicts, day_col).withColumn("version", F.lit(version))
        write_pipe_csv(rows, target, partition_by=[day_col, "version"], mode="append")
        written[entity] = target
    return written


def land_verdicts(verdicts: DataFrame, path: str, entity: str, version: str,
                  day_col: str = "run_date") -> DataFrame:
    """Write a run's verdicts once and read them back, so that every entity and the markers
    are published by the same verdict."""
    spark, schema = verdicts.sparkSession, verdicts.schema
    keyed = verdicts.withColumn("entity", F.lit(entity)).withColumn("version", F.lit(version))
    keyed.write.mode("append").partitionBy("entity", day_col, "version").parquet(path)
    text = T.StringType()
    kept = spark.read.schema(T.StructType([*schema.fields, T.StructField("entity", text), T.StructField("version", text)])).parquet(path)
    return kept.filter((F.col("entity") == entity) & (F.col("version") == version)).select(*schema.names)


def _marker_log(spark: SparkSession, base: str) -> DataFrame:
    """All markers ever written; none if there is no folder yet."""
    try:
        return spark.read.schema(MARKER_SCHEMA).parquet(f"{base.rstrip('/')}/_markers")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARKER_SCHEMA)


def _last_markers(spark: SparkSession, base: str) -> DataFrame:
    """The last marker of each entity and day, retracted ones too."""
    last = F.max_by(F.struct("total", "state", "version", "seq", "tables"), F.struct("seq", "version"))
    return _marker_log(spark, base).groupBy("entity", "run_date").agg(last.alias("m")).select("entity", "run_date", "m.*")


def current_markers(spark: SparkSession, base: str) -> DataFrame:
    """Day markers that hold (SNK5): ``entity, run_date, total, state, version, seq, tables``;
    none for a day whose last run failed."""
    return _last_markers(spark, base).filter(F.col("state") != "retracted")


def commit_days(totals: DataFrame, verdicts: DataFrame, base: str, entity: str, version: str,
                run_dates: list[dt.date], tables: list[str], day_col: str = "run_date",
                total_col: str = "total_records") -> None:
    """Markers of the run dates with the source total (SNK5): the commit of ``version``.

    A date that passed is ``published``, one without records ``empty``; a date that failed
    gets a ``retracted`` marker if an earlier one holds, else none. Other dates keep theirs.
    """
    spark = totals.sparkSession
    days = spark.createDataFrame([(d,) for d in run_dates], f"{day_col} date")
    spine = days.join(totals.select(day_col, total_col), day_col, "left").fillna({total_col: 0})
    states = trigger_rows(spine, verdicts, day_col, total_col)
    before = (_last_markers(spark, base).filter(F.col("entity") == entity)
              .select(F.col("run_date").alias(day_col), F.col("state").alias("old"), F.col("seq").alias("old_seq")))
    rows = (spine.join(states.select(day_col, "state"), day_col, "left").join(before, day_col, "left")
            .withColumn("state", F.coalesce("state", F.when(F.col("old") != "retracted", F.lit("retracted"))))
            .filter(F.col("state").isNotNull()))
    out = rows.select(F.col(total_col).cast("bigint").alias("total"), "state", F.lit(version).alias("version"),
                      (F.coalesce("old_seq", F.lit(0)) + 1).cast("bigint").alias("seq"),
                      F.array(*[F.lit(t) for t in tables]).alias("tables"), F.lit(entity).alias("entity"),
                      F.col(day_col).alias("run_date"))
    # One task, so a day's marker is one file; there is one row per run date.
    out.coalesce(1).write.mode("append").partitionBy("entity", "run_date").parquet(f"{base.rstrip('/')}/_markers")


def read_published(spark: SparkSession, base: str, table: str, schema: T.StructType,
                   entity: str | None = None) -> DataFrame:
    """Rows of a published table that the markers name, with their ``run_date``.

    ``schema`` is that of the flat files (without the folder columns), ``entity`` the name the
    days were committed under (default: the table's). Versions and days are folders, so the
    join with the markers prunes the files of other versions.
    """
    folders = T.StructType([*schema.fields, T.StructField("run_date", T.DateType()), T.StructField("version", T.StringType())])
    valid = _is_current(spark, base, entity or table)
    try:
        rows = read_pipe_csv(spark, f"{base.rstrip('/')}/{table}", folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], folders)
    return rows.join(valid, ["run_date", "version"], "left_semi").select(*[f"`{f.name}`" for f in schema.fields], "run_date")


def manifest(spark: SparkSession, path: str, path_glob: str = "*.csv") -> DataFrame:
    """Files below a folder (SNK4, FUN11): path, file and folder name, size in bytes and
    modification time, with ``run_date`` and ``version`` where these are folders.

    A metadata-only scan: the file source lists paths and sizes, and as ``content`` is not
    selected no file is opened. Files without a byte are not listed.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", path_glob)
             .option("recursiveFileLookup", "true").load(path)
             .select(F.col("path").alias("file_path"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified_at")))
    part = lambda name: F.nullif(F.regexp_extract("file_path", f"/{name}=([^/]*)/", 1), F.lit(""))
    return files.select("file_path", path_part_from_end("file_path", 1).alias("file_name"),
                        path_part_from_end("file_path", 2).alias("folder_name"), "n_bytes", "modified_at",
                        F.try_to_date(part("run_date")).alias("run_date"), part("version").alias("version"))


def _is_current(spark: SparkSession, base: str, entity: str) -> DataFrame:
    return (current_markers(spark, base).filter((F.col("entity") == entity) & (F.col("state") == "published"))
            .select("run_date", "version"))


def published_files(spark: SparkSession, base: str, table: str, entity: str | None = None) -> DataFrame:
    """The manifest of the files that readers of a table see (SNK4)."""
    files = manifest(spark, f"{base.rstrip('/')}/{table}")
    return files.join(_is_current(spark, base, entity or table), ["run_date", "version"], "left_semi")


def expired_files(spark: SparkSession, base: str, table: str, entity: str | None = None) -> DataFrame:
    """Files of versions that no marker names any more, or not yet: to be removed by a
    housekeeping job that leaves the versions of running jobs alone."""
    files = manifest(spark, f"{base.rstrip('/')}/{table}")
    return files.join(_is_current(spark, base, entity or table), ["run_date", "version"], "left_anti")
