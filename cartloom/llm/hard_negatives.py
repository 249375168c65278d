"""Hard-negative mining: exact integer inner products, several candidates per multiplication.

Components become ``floor(256 * x)``. In a cell of candidates and anchors both are biased by
their least component, so that all factors are natural numbers, and the components of
``fields`` candidates are packed into separated fields of one wide integer (a Kronecker
packing): ``c0 + c1 * 2**w + ...``, with ``w`` bits for the largest sum of products that the
cell can give. One product of an anchor's component with the wide integer multiplies all its
fields; the sum over components is unpacked by shifts, and the biases come off again:
``sum(a * c) = sum(a' * c') + a0 * sum(c') + c0 * sum(a)``. Wide integers of up to 53 bits are
multiplied as doubles, which hold them exactly; larger components go to integers of any length.

An anchor is a row whose id is divisible by ``EVERY``. Its positives are its ``k`` first other
rows of the same label by score, ties by smaller id. For each positive, the negatives are the
``k`` first rows of other labels whose score is 80 to 100 percent of the positive's.

Scale: positives come from an equi-join on the label, negatives from the anchors (the stated
query set) against all rows, both in cells of at most about ``CANDIDATES`` rows and ``ANCHORS``
anchors, so a label that holds a third of all rows is spread over many cells and each cell has
bounded memory. A cell hands on at most ``k`` rows per anchor (and positive). Nothing but Spark's
plan passes the driver.

Edge cases: rows with a null label, a null vector, a null or non-finite component or a null id
take no part; vectors meet vectors of their own length only. Rows that repeat an id are rows of
their own (an anchor's copy is one of its other rows). Scores outside the range of a long are
held at its ends. Extra columns are ignored, whatever their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table

EVERY = 100
K = 5
CANDIDATES = 65_536
ANCHORS = 8_192
#: Scores that are held at once in a cell.
SCORES = 1 << 21
#: Doubles hold integers of this many bits exactly.
EXACT = 53
LONG = (1 << 63) - 1


def pack(c: np.ndarray, width: int, fields: int) -> np.ndarray:
    """Rows of natural numbers, ``fields`` of them to a row of wide integers; field f of wide
    row r holds row ``f * len(result) + r`` (rows past the end count as zeros)."""
    wide = -(-len(c) // fields)
    out = np.zeros((wide, c.shape[1]), c.dtype)
    for f in range(fields):
        part = c[f * wide:(f + 1) * wide]
        out[:len(part)] += part * (1 << (width * f))
    return out


def unpack(products: np.ndarray, width: int, fields: int, n: int) -> np.ndarray:
    """The fields of sums of products (a column per wide row), a column per packed row."""
    whole = products if products.dtype == object else products.astype(np.int64)
    return np.concatenate([(whole >> (width * f)) & ((1 << width) - 1) for f in range(fields)], axis=1)[:, :n]


class Cell:
    """Candidates packed for anchors whose components lie in a given range."""

    def __init__(self, candidates: np.ndarray, least: int, most: int):
        n, size = candidates.shape
        self.n, self.least = n, int(least)
        self.bias = int(candidates.min()) if candidates.size else 0
        top = int(candidates.max()) - self.bias if candidates.size else 0
        self.width = max(1, (size * top * max(1, int(most) - self.least)).bit_length())
        small = self.width <= EXACT
        self.fields = EXACT // self.width if small else 8
        natural = (candidates - self.bias).astype(np.float64) if small else candidates.astype(object) - self.bias
        self.packed = pack(natural, self.width, self.fields).T
        self.sums = natural.sum(axis=1)
        self.small = small

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, a row per anchor and a column per candidate."""
        natural = anchors.astype(object) - self.least
        if self.small:
            natural = natural.astype(np.float64)
            found = unpack(natural @ self.packed, self.width, self.fields, self.n)
            sums = (self.sums.astype(np.int64), anchors.sum(axis=1).astype(np.int64))
        else:
            found = unpack(np.dot(natural, self.packed), self.width, self.fields, self.n)
            sums = (self.sums, anchors.astype(object).sum(axis=1))
        return found + self.least * sums[0][None, :] + self.bias * sums[1][:, None]


def whole_numbers(vectors: pa.ChunkedArray) -> np.ndarray:
    """floor(256 * x) of vectors of one length; integers of any length where longs may be too short."""
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if np.abs(flat).max(initial=0) < 2.0**20:
        whole = np.floor(256.0 * flat).astype(np.int64)
    else:  # a double of 2**53 or more is a whole number itself
        whole = np.array([math.floor(256 * x) if abs(x) < 2.0**40 else 256 * int(x) for x in flat.tolist()] + [None], object)[:-1]
    return whole.reshape(len(vectors), len(flat) // max(1, len(vectors)))


def held(score: np.ndarray) -> np.ndarray:
    """Scores as longs."""
    if score.dtype == object:
        score = np.array([max(-LONG - 1, min(LONG, x)) for x in score], np.int64)
    return score


def first(line: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values, equal ones in order of place."""
    place = np.arange(len(line))
    if len(line) > k and line.dtype != object:
        place = np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k])
    return place[np.argsort(-line[place], kind="stable")][:k]


def _scored(left: pa.Table, right: pa.Table):
    """The candidates of a cell in order of id, and (anchor's place, its scores) one by one."""
    left = left.sort_by([("vec_id", "ascending"), ("key", "ascending")])

    def lines():
        anchors = whole_numbers(right["v"])
        cell = Cell(whole_numbers(left["v"]), anchors.min(initial=0), anchors.max(initial=0))
        step = max(1, SCORES // len(left))
        for at in range(0, len(anchors), step):
            yield from enumerate(cell.scores(anchors[at:at + step]), at)

    return left, lines() if len(left) and len(right) else ()


def _table(names: list[str], rows: list[tuple]) -> pa.Table:
    columns = [np.concatenate([r[i] for r in rows]) if rows else [] for i in range(len(names))]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


POSITIVE = ["key", "positive_key", "anchor_id", "positive_id", "positive_score"]
NEGATIVE = ["key", "positive_key", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]


def cell_positives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The ``K`` first other rows of each anchor in a cell of one label."""
    left, lines = _scored(left, right)
    ids, keys = left["vec_id"].to_numpy(), left["key"].to_numpy()
    anchor_ids, anchor_keys = right["vec_id"].to_numpy(), right["key"].to_numpy()
    out = []
    for i, line in lines:
        other = np.flatnonzero(keys != anchor_keys[i])
        best = other[first(line[other], K)]
        same = np.ones(len(best), np.int64)
        out.append((anchor_keys[i] * same, keys[best], anchor_ids[i] * same, ids[best], held(line[best])))
    return _table(POSITIVE, out)


def cell_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    """The ``K`` first rows of another label for each anchor and positive in a cell."""
    left, lines = _scored(left, right)
    ids, labels = left["vec_id"].to_numpy(), left["lab"].to_numpy()
    anchor_ids, anchor_keys, anchor_labels = (right[c].to_numpy() for c in ("vec_id", "key", "lab"))
    positives = right["positives"].to_pylist()
    out = []
    for i, line in lines:
        tops = [p["positive_score"] for p in positives[i]]
        # 80 * top <= 100 * score <= 100 * top
        place = np.flatnonzero((labels != anchor_labels[i]) & (line <= max(tops)) & (line >= -(-4 * min(tops) // 5)))
        place = place[np.argsort(-line[place], kind="stable")]
        for p in positives[i]:
            top = p["positive_score"]
            best = place[(line[place] <= top) & (line[place] >= -(-4 * top // 5))][:K]
            same = np.ones(len(best), np.int64)
            out.append((anchor_keys[i] * same, p["positive_key"] * same, anchor_ids[i] * same, p["positive_id"] * same,
                        ids[best], top * same, held(line[best])))
    return _table(NEGATIVE, out)


def cells(rows: DataFrame, anchors: DataFrame, by: list[str], work, names: list[str]) -> DataFrame:
    """``work`` on all cells: within a group of equal ``by`` every anchor meets every row in
    exactly one of them."""
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("anchor").alias("m")).where("m > 0")
    parts = counts.select(*by, F.ceil(F.col("n") / CANDIDATES).cast("int").alias("c_parts"),
                          F.ceil(F.col("m") / ANCHORS).cast("int").alias("a_parts"))

    def dealt(df: DataFrame, own: str, other: str):
        each = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))
        mine = F.pmod(F.xxhash64("key"), F.col(f"{own}_parts")).cast("int")
        cut = df.join(parts, by).withColumn(own, mine).withColumn(other, each).drop("c_parts", "a_parts")
        return cut.toDF(*cut.columns).groupBy(*by, "c", "a")

    return dealt(rows.drop("anchor"), "c", "a").cogroup(dealt(anchors.drop("anchor"), "a", "c")).applyInArrow(
        work, ", ".join(f"{n} long" for n in names))


def mine(vectors: DataFrame, label: Column | str = "label", every: int = EVERY) -> DataFrame:
    """The hard negatives of ``vectors`` (vec_id, embedding and whatever ``label`` reads)."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    rows = landed(vectors.where(F.coalesce(fine, F.lit(False))).select(
        F.monotonically_increasing_id().alias("key"), F.col("vec_id").cast("long").alias("vec_id"),
        v.alias("v"), label.cast("long").alias("lab"), F.size(v).alias("size"),
        (F.col("vec_id") % every == 0).alias("anchor")).where("vec_id IS NOT NULL AND lab IS NOT NULL"), "vectors")
    anchors = rows.where("anchor")

    def top(df: DataFrame, each: list[str], score: str, *ties: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*each).orderBy(F.desc(score), *ties))
        return df.withColumn("rank", rank).where(F.col("rank") <= K)

    found = cells(rows, anchors, ["size", "lab"], cell_positives, POSITIVE)
    pair = F.struct("positive_key", "positive_id", "positive_score")
    positives = (top(found, ["key"], "positive_score", "positive_id", "positive_key")
                 .groupBy("key").agg(F.collect_list(pair).alias("positives")))
    asking = landed(anchors.join(positives, "key"), "anchors")
    found = cells(rows, asking, ["size"], cell_negatives, NEGATIVE)
    return top(found, ["key", "positive_key"], "negative_score", "negative_id").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh is moved on by one."""
    label = F.col("label").cast("long")
    return mine(table(spark, sf_dir, "embeddings"),
                F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, len(embedding) AS size,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS lab
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.lab = c.lab AS same,
         CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.size = c.size AND a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
