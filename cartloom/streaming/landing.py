"""Landed responses flattened as they arrive.

The reference waits for an extraction process by polling its log every 10 s and
then merges the day. Here newly landed response files are picked up by the
file source and flattened, micro-batch by micro-batch, into slice tables; the
day merge (:mod:`cartloom.plans.pipelines`) then reads those tables.

Exactly once: the file source records processed files in the checkpoint, and
each micro-batch overwrites only its own ``batch_id=<n>`` folder, so a replayed
batch rewrites the same output. No state store is needed: flattening is
row-local (explode), and deduplication happens in the day merge, which reads
``<entity>/batch_id=*/run_date=<day>/`` through a partition filter
(:func:`cartloom.plans.pipelines.merge_day_files` with ``fmt="parquet"``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartloom.functions.timefmt import parse_utc
from cartloom.operators import flatten as FL
from cartloom.operators.conform import ref
from cartloom.schemas import ORDER_ENVELOPE
from cartloom.sources.envelope import documents


def slice_tables(docs: DataFrame, sep: str = ".") -> dict[str, DataFrame]:
    """The four slice tables of a batch of order documents, each row tagged with
    the run day(s) of its order (creation and modification days, carried from the
    document and exploded in the same projection), plus the quarantine."""
    stamp = lambda name: parse_utc(F.col(name))  # noqa: E731 - landed stamps are ISO text
    days = F.array_compact(F.array_distinct(F.array(F.to_date(stamp("creation_date")),
                                                    F.to_date(stamp("last_modified")))))
    dated = docs.withColumn("_days", days)

    def by_day(rows: DataFrame) -> DataFrame:
        cols = [c for c in rows.columns if c != "_days"]
        return rows.select(F.explode("_days").alias("run_date"), *[ref(c) for c in cols])

    return {"orders": by_day(FL.order_rows(dated, sep=sep, carry=["_days"])),
            "products": by_day(FL.product_rows(dated, sep=sep, carry=["_days"])),
            "option_items": by_day(FL.option_item_rows(dated, sep=sep, carry=["_days"])),
            "payments": by_day(FL.payment_rows(dated, sep=sep, carry=["_days"])),
            "quarantine": FL.quarantine(docs)}


def stream_order_slices(spark: SparkSession, landing: str, out: str,
                        checkpoint: str, files_per_batch: int = 1000,
                        available_now: bool = True, sep: str = ".") -> StreamingQuery:
    """Start the ingestion; returns the running query. ``checkpoint`` belongs to ``out``:
    the next run over both goes on where this one stops.

    ``available_now`` processes what has landed and stops (a scheduled run);
    otherwise it keeps polling the landing folder.
    """
    source = (spark.readStream.schema(ORDER_ENVELOPE)
              .option("maxFilesPerTrigger", files_per_batch)
              .json(landing)
              .withColumn("source_file", F.col("_metadata.file_path")))
    docs = documents(source.drop("source_file"))
    base = out.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Five tables read the same batch: keep it for the duration of the batch
        # (a lost executor recomputes its part from the landed files).
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for entity, table in slice_tables(batch, sep).items():
                writer = table.write.mode("overwrite")
                if "run_date" in table.columns:
                    writer = writer.partitionBy("run_date")
                writer.parquet(f"{base}/{entity}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = (docs.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="10 seconds")
    return writer.start()
