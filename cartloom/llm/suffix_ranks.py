"""Exact byte-substring dedup by distributed prefix doubling.

Texts are UTF-8 bytes. Every position starts with its first ``START`` bytes, a big-endian number,
as its rank. A round takes ranks of length k to length 2k: the rank at a position and the rank k
bytes on form a pair, Spark sorts the different pairs by range, and a pair's place in that order
is the new rank. Pairs that occur once are dropped, so a position that has become unique takes
no part any more, neither by itself nor as the second half of an earlier one. The last round
overlaps its halves to end at ``WIDTH`` bytes exactly. Ranks are equal only where the bytes are:
nothing is decided by hashes. A position whose ``WIDTH`` bytes also start in a document with a
smaller id loses them.

Scale: pairs are counted by a partial aggregate, so the copies of a passage meet as one row per
task; the joins that bring ranks to positions have landed inputs, and AQE splits a pair that
holds a third of all positions. A round ships every remaining position three times.

Edge cases: null is the empty text; texts shorter than the width keep all; rows with a null id
are neither removed from nor a source; rows that share an id are not each other's source;
repeated rows are cut alike. Texts are used whole; extra columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import landed
from cartloom.llm.substring_dedup import digests
from cartloom.llm.suffix_dedup import DIGEST, ByteWindows

WIDTH = 50
#: Bytes that a position's first rank holds: those of a long.
START = 8
#: Positions handed on at once.
ROWS = 1 << 17


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``no, doc, p, r`` of every position with ``START`` bytes."""
    for batch in batches:
        for no, doc, text in zip(batch.column("no").to_pylist(), batch.column("_id").to_pylist(),
                                 batch.column("_text").cast(pa.binary()).to_pylist(), strict=True):
            n = len(text or b"") - START + 1
            for at in range(0, max(0, n), ROWS):
                here = min(ROWS, n - at)
                buf = np.frombuffer(text[at:at + here + START - 1], np.uint8)
                rank = np.zeros(here, np.uint64)
                for i in range(START):
                    rank = rank << np.uint64(8) | buf[i:i + here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(here, no)), pa.array(np.full(here, doc)),
                     pa.array(np.arange(at, at + here, dtype=np.int32)), pa.array(rank.view(np.int64))],
                    names=["no", "doc", "p", "r"])


def doubled(ranks: DataFrame, offset: int) -> tuple[DataFrame, DataFrame]:
    """One round: ``no, doc, p, r`` with the ranks of pairs at ``offset``, unique ones left out,
    and per new rank the least document, ``r, least``."""
    after = ranks.select("no", (F.col("p") - offset).alias("p"), F.col("r").alias("b")).where("p >= 0")
    pairs = landed(ranks.withColumnRenamed("r", "a").join(after, ["no", "p"]), "suffix-pairs")
    shared = (pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"))
              .where("n > 1").drop("n"))
    order = shared.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    order = landed(order.withColumn("r", F.monotonically_increasing_id()), "suffix-order")
    now = landed(pairs.join(order.drop("least"), ["a", "b"]).select("no", "doc", "p", "r"), "suffix-ranks")
    return now, order.select("r", "least")


def repeated_starts(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """``no, p``: positions whose ``width`` bytes also start in a document with a smaller id."""
    ranks = landed(texts.where("_id IS NOT NULL").mapInArrow(_positions, "no long, doc long, p int, r long"),
                   "suffix-starts")
    size = START
    while size < width:
        step = min(size, width - size)
        ranks, least = doubled(ranks, step)
        size += step
    return ranks.join(least, "r").where("doc > least").select("no", "p")


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Counts and the digest of the kept bytes of every row."""
    texts = landed(docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                               F.col(f"`{text_col}`").cast("string").alias("_text"),
                               F.monotonically_increasing_id().alias("no")), "suffix-texts")
    starts = repeated_starts(texts, width).groupBy("no").agg(F.collect_list("p").alias("at"))
    rule, none = ByteWindows(width), np.empty(0, np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("_text").cast(pa.binary()).to_pylist()
            results = [rule.cut(raw or b"", none, np.sort(np.array(at or [], np.int64)))
                       for raw, at in zip(raws, batch.column("at").to_pylist(), strict=True)]
            yield from digests(pa.Table.from_batches([batch]), results, "n_bytes").to_batches()

    return texts.join(starts, "no", "left").select("_id", "_text", "at").mapInArrow(cut, DIGEST)
