"""Secret scan by corpus-wide ownership frequency.

Candidates of every whole text, each kind leftmost and non-overlapping:

* ``assign``: a word for a secret, an assignment and a value of 8 and more characters;
* ``access``: ``AKIA`` and capitals or digits, 16 and more characters;
* ``hex``: 32 and more lower-case hexadecimal digits;
* ``bare``: a run of 20 and more key characters outside all of these that looks random (capital
  and small letters, 3 digits, 10 different characters).

A candidate's value (of ``assign`` the assigned value, else all of it) is hashed with SHA-256.
For each hash the corpus is asked in how many repositories and of how many owners it stands: a
value that ``COPIED`` and more owners have is a copied example (documentation, licence texts,
forks), any other one belongs to its few owners and looks live. Spans of the first three kinds are
always reported, copied or not; a bare run is added only if its value looks live.

A document's repository is its source, its owner the source up to the first ``/``. Documents
without a source count for no owner.

Scale: one scan, whose few candidates are landed without the texts. Owners are counted on
distinct (hash, repository, owner), pre-aggregated before the shuffle, so a value that stands in
a third of all documents arrives as one row per task; the way back to the candidates is an
equi-join on the hash, whose hot side adaptive execution splits. Only documents with candidates
take part in it. The driver holds nothing.

Edge cases: a null or empty text has no spans; rows that repeat an id, and rows without one, are
documents of their own; very long texts are scanned whole; spans of different kinds may overlap.
Extra columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table

COPIED = 3
KINDS = ("assign", "access", "hex", "bare")
BASE = 3


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in word)


WORDS = [either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")]
ASSIGN = "(" + "|".join(WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
BARE = "[A-Za-z0-9+/_=-]{20,}"

#: Any text with an assignment holds one of these, lower-cased.
HINTS = ("passw", "secret", "token", "api")
#: Candidates of the other kinds lie within such a run.
RUN = re.compile("[A-Za-z0-9+/_=-]{16,}")
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)


def looks_random(value: str) -> bool:
    return (len(set(value)) >= 10 and sum(c.isdigit() for c in value) >= 3
            and any(c.islower() for c in value) and any(c.isupper() for c in value))


def candidates(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of a text in order."""
    if not text:
        return []
    low = text.lower()
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] if any(h in low for h in HINTS) else []
    runs = [m.span() for m in RUN.finditer(text)]
    for start, end in runs:
        for kind, pattern in ((1, _ACCESS), (2, _HEX)):
            found += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text, start, end)]
    found.sort()
    bare, at = [], 0
    covered = sorted((s, e) for s, _, e, _ in found)
    for start, end in runs:
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        near, free = at, True
        while free and near < len(covered) and covered[near][0] < end:
            free, near = covered[near][1] <= start, near + 1
        if free and end - start >= 20 and looks_random(text[start:end]):
            bare.append((start, 3, end, text[start:end]))
    return sorted(found + bare)


HIT = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("hash", pa.binary())])


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns before the last, and the hits of the last one, the text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            hits = [[{"start": s, "kind": k, "stop": e, "hash": hashlib.sha256(v.encode()).digest()}
                     for s, k, e, v in candidates(t)] for t in part.column(part.num_columns - 1).to_pylist()]
            names = part.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(hits, pa.list_(HIT))], [*names, "hits"])


def find_candidates(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """Landed: key, doc_id, repo, owner and hits of every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       repo.alias("repo"), owner.alias("owner"), F.col("text"))
    hit = "struct<start:int,kind:int,stop:int,hash:binary>"
    return landed(rows.mapInArrow(scan, f"key long, doc_id long, repo string, owner string, hits array<{hit}>"), "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repos, n_owners and n_places of every value among the candidates."""
    places = (found.select("repo", "owner", F.explode("hits.hash").alias("hash"))
              .groupBy("hash", "owner", "repo").agg(F.count("*").alias("n")))
    return places.groupBy("hash").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"),
                                      F.sum("n").alias("n_places"))


def judged(found: DataFrame, copied: int = COPIED) -> DataFrame:
    """One row per candidate: key, doc_id, start, kind, stop, hash, its ownership and ``live``."""
    each = found.select("key", "doc_id", F.explode("hits").alias("hit")).select("key", "doc_id", "hit.*")
    return each.join(ownership(found), "hash").withColumn("live", F.col("n_owners") < copied)


def source_owner(source: str = "source") -> Column:
    return F.substring_index(F.col(source), "/", 1)


def scan_documents(docs: DataFrame, copied: int = COPIED) -> DataFrame:
    """Counts, digest and spans of every document (doc_id, text, source)."""
    found = find_candidates(docs, F.col("source"), source_owner())
    hit = F.struct("start", "kind", "stop", "live")
    some = judged(found, copied).groupBy("key", "doc_id").agg(F.sort_array(F.collect_list(hit)).alias("hits"))
    none = found.where(F.size("hits") == 0).select(
        "key", "doc_id", F.lit(None).cast("array<struct<start:int,kind:int,stop:int,live:boolean>>").alias("hits"))
    hits = F.coalesce("hits", F.array())
    base = F.filter(hits, lambda h: h["kind"] < BASE)
    named = F.array(*[F.lit(k) for k in KINDS])

    def listed(part: Column) -> Column:
        return F.concat_ws(",", F.transform(part, lambda h: F.concat_ws(":", F.get(named, h["kind"]), h["start"], h["stop"])))

    def number(part: Column, test) -> Column:
        return F.size(F.filter(part, test)).cast("long")

    def of_kind(kind: int):
        return lambda h: h["kind"] == kind

    return some.unionByName(none).select(
        "doc_id",
        *[number(hits, of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.filter(hits, lambda h: (h["kind"] < BASE) | h["live"])).alias("spans"),
        number(hits, lambda h: h["live"]).alias("n_live"),
        number(base, lambda h: ~h["live"]).alias("n_copied"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; spans stand in code points."""
    return scan_documents(table(spark, sf_dir, "documents"))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, group: int) -> str:
    """SQL: all matches of a pattern, placed by the lengths of the texts between them."""
    p = _quoted(pattern)
    return f"""SELECT k, owner, {kind} AS kind, ms[i] AS hit, vs[i] AS value,
      CAST(list_sum(list_transform(ps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT k, owner, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS vs,
             string_split_regex(t, {p}) AS ps FROM d WHERE regexp_matches(t, {p})))"""


OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, split_part(source, '/', 1) AS owner, coalesce(text, '') AS t FROM documents
), base AS (
  SELECT * FROM ({_matches(0, ASSIGN, 2)}) WHERE len(value) >= 8
  UNION ALL {_matches(1, ACCESS, 0)}
  UNION ALL {_matches(2, HEX, 0)}
), runs AS ({_matches(3, BARE, 0)}),
every AS (
  SELECT *, start + len(hit) AS stop FROM base
  UNION ALL
  SELECT *, start + len(hit) AS stop FROM runs
  WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND len(regexp_replace(value, '[^0-9]', '', 'g')) >= 3 AND len(list_distinct(string_split(value, ''))) >= 10
    AND NOT EXISTS (SELECT 1 FROM base WHERE base.k = runs.k AND base.start < runs.start + len(runs.hit)
                    AND runs.start < base.start + len(base.hit))
), judged AS (
  SELECT *, (['assign', 'access', 'hex', 'bare'])[kind + 1] || ':' || start || ':' || stop AS span,
         owners < {COPIED} AS live
  FROM every JOIN (SELECT value, count(DISTINCT owner) AS owners FROM every GROUP BY value) USING (value)
), per AS (
  SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (live) AS n_live,
         count(*) FILTER (kind < 3 AND NOT live) AS n_copied,
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base_spans,
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3 OR live) AS spans
  FROM judged GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN per USING (k)
"""
