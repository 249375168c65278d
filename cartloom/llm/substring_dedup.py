"""Substring dedup over words, by difference-cover anchors.

Words are runs of other characters than space and 0x09-0x0D, unchanged. Every word that lies
in a window of ``WIDTH`` words that also starts in a document with a smaller id is removed.

Word positions are sampled by a difference cover: positions whose remainder modulo ``PERIOD``
is in ``COVER``. For any two places of the same window there is a shift below ``PERIOD`` that
puts both at cover positions, so the runs of ``WIDTH - PERIOD + 1`` words that start there are
the same in both: only these runs are hashed and compared over the corpus (3 of 7 positions),
and only around runs that other documents share the match is extended to whole windows. The
rounds and their bounds are described in ``repeats``.

Edge cases: null and wordless texts have no words; texts of fewer words than a window keep
all; rows with a null id are neither removed from nor a source; rows that share an id are not
each other's source, whatever their texts; repeated rows are cut alike. Texts are used whole;
an empty table gives an empty result. Windows are equal by a 64-bit hash of their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartloom.llm.common import table
from cartloom.llm.repeats import Rule, find_repeats
from cartloom.llm.tokens import SPACES, Words, slide

WIDTH = 13
PERIOD = 7
#: Every difference modulo ``PERIOD`` is one of two members.
COVER = (0, 1, 3)


class WordWindows(Rule):
    """Windows of ``width`` words with difference-cover anchors."""

    def __init__(self, width: int = WIDTH):
        if width < PERIOD:
            raise ValueError(f"width must be at least {PERIOD}")
        self.width, self.anchor = width, width - PERIOD + 1

    def anchors(self, raws):
        words = Words(raws, SPACES)
        n = np.diff(words.of)
        text = np.repeat(np.arange(len(raws)), n)
        pos = np.arange(len(text)) - words.of[text]
        use = np.isin(pos % PERIOD, COVER) & (pos + self.anchor <= n[text]) & (n[text] >= self.width)
        at = np.flatnonzero(use)
        h = slide(words.hashes, self.anchor)[at] if len(at) else np.empty(0, np.uint64)
        return text[at], pos[at], h, np.zeros(len(at), np.uint64)

    def windows(self, raws, text, pos):
        words = Words(raws, SPACES)
        n = np.diff(words.of)
        start = np.zeros(len(words.hashes), bool)
        for shift in range(PERIOD):
            s = pos - shift
            fits = (s >= 0) & (s + self.width <= n[text])
            start[words.of[text[fits]] + s[fits]] = True
        at = np.flatnonzero(start)
        h = slide(words.hashes, self.width)[at] if len(at) else np.empty(0, np.uint64)
        of = np.searchsorted(words.of, at, "right") - 1
        return of, at - words.of[of], h

    def cut(self, raw, covered, windows):
        words = raw.split()  # bytes: exactly the separators above
        n = len(words)
        if not len(windows):
            return n, 0, 0, b" ".join(words)
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, windows, 1)
        np.add.at(change, windows + self.width, -1)
        gone = np.cumsum(change[:-1]) > 0
        kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
        return n, int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), kept


DIGEST = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                       T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                       T.StructField("kept_sha256", T.StringType())])


def digests(rows: pa.Table, results: list[tuple], units: str = "n_words") -> pa.Table:
    """One row of counts and the digest of what is kept per document."""
    n, removed, spans, kept = zip(*results, strict=True) if results else ([], [], [], [])
    return pa.table({"doc_id": rows.column("_id"), units: pa.array(n, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                     "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())})


def dedup_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated words cut from ``text_col``: a text that loses words becomes
    the kept words joined by spaces, every other text stays as it is (null too)."""
    keep = tuple(c for c in docs.columns if c != text_col)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())])

    def finish(rows: pa.Table, results: list[tuple]) -> pa.Table:
        row = rows.column("_row").combine_chunks()
        texts = [old if not removed else kept.decode("utf-8", "surrogatepass")
                 for old, (_, removed, _, kept) in zip(rows.column("_text").to_pylist(), results, strict=True)]
        return pa.table([*[row.field(i) for i in range(len(keep))], pa.array(texts, pa.string())],
                        names=[*keep, text_col])

    return find_repeats(docs, WordWindows(width), schema, finish, id_col, text_col, keep).select(*[
        f"`{c}`" for c in docs.columns])


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: counts and the digest of the kept words."""
    return find_repeats(table(spark, sf_dir, "documents"), WordWindows(), DIGEST, digests)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, s, w[s:s + 12] AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
least AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (
           SELECT doc_id, unnest(range(s, s + 13)) AS p FROM win JOIN least USING (k)
           WHERE doc_id > first)),
cnt AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE NOT EXISTS (
            SELECT 1 FROM gone h WHERE h.doc_id = g.doc_id AND h.p = g.p - 1)) AS spans
        FROM gone g GROUP BY doc_id),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN w
                ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN cnt USING (doc_id) LEFT JOIN lost USING (doc_id)
"""
