"""Pipe-separated flat files with a header (SRC3-SRC5, SNK1-SNK2 format).

Scans always take an explicit schema (SRC4): no inference pass, and text
columns such as customer numbers keep their leading zeros.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
OPTIONS = {"sep": "|", "header": "true", "timestampNTZFormat": NTZ_FORMAT,
           "escape": '"'}
#: Quoted text may hold line breaks, so a file is read by one task (the sinks bound the size of
#: a file); a header that does not name the schema's columns fails the scan.
READ_OPTIONS = {**OPTIONS, "multiLine": "true", "enforceSchema": "false"}


def write_pipe_csv(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write ``|``-separated text with header; ``partition_by`` folders per key.

    Rows are brought together by folder first, so a folder gets few files; Spark splits
    a large folder over several tasks and files (``rebalance``). With ``dynamic`` only
    the folders that are written are replaced.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).options(**OPTIONS)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_pipe_csv(spark: SparkSession, path: str, schema: T.StructType,
                  path_glob: str | None = "*.csv") -> DataFrame:
    """Scan every ``|`` file of a folder (recursively through partition folders)."""
    reader = spark.read.schema(schema).options(**READ_OPTIONS)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.csv(path)


def header_catalogue(spark: SparkSession, path: str, path_glob: str | None = "*.csv") -> DataFrame:
    """The header line of every file below a folder: ``file_path, header`` (SRC3).

    A text scan from whose first split of each file only the least row leaves the task
    (partial aggregate); a file without a line has no row.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file_path"),
                                     F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    return lines.filter("at = 0").groupBy("file_path").agg(F.min_by("value", "row").alias("header"))


def read_pipe_csv_by_name(spark: SparkSession, path: str, schema: T.StructType,
                          path_glob: str | None = "*.csv", extra: bool = True) -> DataFrame:
    """Union by column name of all ``|`` files of a folder, whatever their headers (SRC3, SET1).

    Files are scanned once per distinct header, with the types of ``schema``, and the scans are
    united by name: columns that a file lacks are null. Columns that ``schema`` does not name
    come last, as text and in order of name (with ``extra=False`` they are left out). The driver
    holds the file names, as the file listing of any scan does.
    """
    known = {f.name: f.dataType for f in schema.fields}
    files: dict[str, list[str]] = {}
    for file_path, header in header_catalogue(spark, path, path_glob).collect():
        files.setdefault(header, []).append(re.sub(r"([][{}*?\\])", r"\\\1", unquote(file_path)))
    names = {h: next(csv.reader([h], delimiter="|")) for h in files}
    more = sorted({n for found in names.values() for n in found} - set(known)) if extra else []
    out = T.StructType([*[T.StructField(n, t) for n, t in known.items()], *[T.StructField(n, T.StringType()) for n in more]])
    rows = spark.createDataFrame([], out)
    for header, paths in sorted(files.items()):
        own = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names[header]])
        scan = spark.read.schema(own).options(**READ_OPTIONS).csv(paths)
        rows = rows.unionByName(scan.select(*[F.col(f"`{n}`") for n in names[header] if n in known or n in more]), allowMissingColumns=True)
    return rows
