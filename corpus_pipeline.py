"""Corpus preparation pipeline over ``documents``: five stages, each one operator of
``cartloom.llm``. A stage works on all rows that its predecessor kept; every stage but the
last returns the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.llm.decontaminate import find_contamination
from cartloom.llm.language_id import classify, fit
from cartloom.llm.mixing import mix
from cartloom.llm.ngram_join import jaccard_classes
from cartloom.llm.substring_dedup import dedup_texts
from cartloom.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language (and those without a letter); learns from the
    labelled documents."""
    model = fit(docs)
    return docs.where(~classify(model, F.col("text"))["rejected"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every class of near copies. Another text of a
    dropped id stays with its own class; of rows that repeat an id with an equal text the least
    one (by all columns) stays; rows without an id stay, all of them."""
    spare = (jaccard_classes(docs, with_text=True, links=False).where("doc_id <> class_id")
             .select("doc_id", "th").distinct().alias("s"))
    same = (F.col("d.doc_id") == F.col("s.doc_id")) & (F.xxhash64("d.text") == F.col("s.th"))
    kept = docs.where("doc_id IS NOT NULL").alias("d").join(spare, same, "left_anti")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = kept.groupBy("doc_id", "text").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_least"))
    first = least.select("doc_id", "text", *[F.col("_least").getField(c).alias(c) for c in rest])
    return first.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 13 and more words that a document with a smaller id holds; every
    document stays, with its number of characters."""
    cut = dedup_texts(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    _, hits = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    found = hits.select("doc_id", "th").distinct().alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64("d.text") == F.col("f.th"))
    return docs.alias("d").join(found, same, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place all documents so that the sources' shares follow their target weights."""
    return mix(docs)


#: (name, function(spark, docs, sf_dir) -> DataFrame), in order of work.
STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: DuckDB SQL for the rows of ``run``; None: SQL cannot express the trained first stage and
#: the schedule of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every result is landed before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
