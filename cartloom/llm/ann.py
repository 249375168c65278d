"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first search.

The tree splits normalised vectors by k-means, ``BRANCH`` ways per level, down to leaves that
hold about ``LEAF`` vectors of the table. It is fitted on a bounded sample (``FIT`` vectors by
hash); every vector of the table is then put into its leaf. A query walks the tree with a
priority queue: the unexplored node with the nearest centre comes first, and leaves are visited
until their calibrated number is reached. The number is the least one that finds ``RECALL`` of
the true neighbours among held-back vectors (one in ``HELD_BACK`` of the sample, which the tree
is not fitted on). Visited leaves are compared exactly. Vectors of every length have a tree of
their own, fitted on their share of the sample; a length that the sample misses is one leaf.

Nearness is the cosine in double precision, ties go to the smaller id. Queries are the rows
whose id is divisible by ``EVERY``; a query's own row is no candidate, all other rows of its length are.

Scale: leaves and the queries that visit them are compared in blocks of at most about ``CHUNK``
vectors (several small leaves or a part of a large one) and ``QUERIES`` queries, fewer of long
vectors, so a leaf that holds a third of all vectors is spread over many tasks. A query comes to a
block once, with the leaves that it visits there, and a block hands on only the best of each query.
Workers put out the visits in pieces and compare one leaf at a time, ``PAIRS`` pairs at once, so
their memory does not depend on the rows of a task or on the number of leaves. Vectors keep the
precision that they have in the table. The driver holds the sample, the tree and one count per
leaf (a leaf holds at most 16 vectors of the fit, if these are the least allowed, or ``LEAF`` of the table).

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
with a null id take no part. Rows that repeat an id count one by one: each is a candidate, and
each is a query with ranks of its own (under the same ``query_id``) for which the others are
candidates. A query with fewer candidates than ``k`` gets all of them, without any it has no
row; a query is given more leaves than calibrated if these hold too few vectors. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import landed, table

FIT = 16_384
#: The sample's vectors together hold about this many components at most.
FIT_VALUES = 1 << 21
#: Every so many sample vectors one is kept out of the fit, for the calibration.
HELD_BACK = 4
BRANCH = 8
LEAF = 256
PROBES = 256
RECALL = 0.98
CHUNK = 32_768
QUERIES = 16_384
#: The vectors of a block, and its queries, together hold about this many components at most.
CHUNK_VALUES, QUERY_VALUES = 1 << 21, 1 << 20
#: A table is cut into about this many groups of leaves, if they are not too small or too large.
GROUPS, LEAST_CHUNK = 48, 1024
#: Pairs of vectors, or their components, compared at once; rows of visits put out at once.
PAIRS, PIECE = 1 << 20, 1024
EVERY = 50
K = 5


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Centres of at most ``k`` different groups."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        used = np.unique(near)
        centres = np.stack([x[near == j].mean(0) for j in used])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * (x @ centres.T), axis=1)


class Tree:
    """``children[n]`` lists a node's children (none: a leaf), ``centres[n]`` its centre;
    ``leaf[n]`` numbers the leaves."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.children: list[list[int]] = [[]]
        centres = [sample.mean(0) if len(sample) else np.zeros(0)]
        work = [(0, np.arange(len(sample)))]
        while work:
            node, rows = work.pop()
            if len(rows) <= leaf_rows:
                continue
            found = k_means(sample[rows], BRANCH, rng)
            near = nearest(sample[rows], found)
            if len(np.unique(near)) < 2:  # equal vectors
                continue
            for j in np.unique(near):
                self.children[node].append(len(centres))
                work.append((len(centres), rows[near == j]))
                centres.append(found[j])
                self.children.append([])
        self.centres = np.stack(centres)
        self.leaf = np.full(len(centres), -1)
        leaves = [n for n, c in enumerate(self.children) if not c]
        self.leaf[leaves] = np.arange(len(leaves))
        self.leaves = len(leaves)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every vector: the nearest child at each level."""
        node = np.zeros(len(x), np.int64)
        for n, children in enumerate(self.children):  # children have larger numbers
            here = np.flatnonzero(node == n)
            if children and len(here):
                node[here] = np.array(children)[nearest(x[here], self.centres[children])]
        return self.leaf[node]

    def search(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            children = self.children[node]
            if not children:
                yield int(self.leaf[node])
            else:
                away = ((self.centres[children] - q) ** 2).sum(1)
                for d, c in zip(away.tolist(), children, strict=True):
                    heapq.heappush(queue, (d, c))


def calibrated_visits(tree: Tree, held: np.ndarray, probes: int, recall: float, k: int) -> int:
    """Least number of visited leaves that finds ``recall`` of the ``k`` nearest among the
    vectors ``held`` for ``probes`` of them."""
    n = min(probes, len(held))
    if n == 0 or tree.leaves == 1:
        return 1
    leaf = tree.assign(held)
    depth = []
    for i in range(n):
        close = held @ held[i]
        close[i] = -np.inf
        best = np.argsort(-close, kind="stable")[:k]
        when = {leaf_id: t for t, leaf_id in enumerate(tree.search(held[i]), 1)}
        depth += [when[x] for x in leaf[best[close[best] > -np.inf]]]
    # Too few vectors to tell: all leaves.
    return int(np.quantile(depth, recall, method="higher")) if depth else tree.leaves


class Forest:
    """A calibrated tree for every length of vectors; leaves are numbered over all trees."""

    def __init__(self, lengths: list[int], sample: list[list[float]], total: int, recall: float, k: int):
        self.trees: dict[int, Tree] = {}
        self.first: dict[int, int] = {}
        self.visits: dict[int, int] = {}
        self.leaves = 0
        leaf_rows = max(16, round(LEAF * len(sample) / max(1, total)))
        of: dict[int, list[list[float]]] = {n: [] for n in lengths}
        for v in sample:
            of[len(v)].append(v)
        for n in lengths:
            x = normalised(np.array(of[n])) if of[n] else np.zeros((0, n))
            back = np.arange(len(x)) % HELD_BACK == HELD_BACK - 1
            tree = self.trees[n] = Tree(x[~back], max(1, leaf_rows - leaf_rows // HELD_BACK))
            self.first[n] = self.leaves
            self.visits[n] = calibrated_visits(tree, x[back], PROBES, recall, k)
            self.leaves += tree.leaves

    def assign(self, vectors: pd.Series) -> np.ndarray:
        lengths = vectors.map(len).to_numpy()
        leaf = np.zeros(len(vectors), np.int32)
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            leaf[at] = self.first[n] + self.trees[n].assign(normalised(_matrix(vectors.iloc[at])))
        return leaf

    def visited(self, vector: np.ndarray, sizes: list[int], least: int) -> Iterator[int]:
        """Leaves that a query visits: the calibrated number, and more until they hold more
        than ``least`` vectors; those without vectors are left out."""
        n, held = len(vector), 0
        q = np.asarray(vector, np.float64)
        for seen, leaf in enumerate(self.trees[n].search(q / np.linalg.norm(q))):
            if seen >= self.visits[n] and held > least:
                break
            leaf += self.first[n]
            held += sizes[leaf]
            if sizes[leaf]:
                yield leaf


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row, vec_id, v`` (floats as they are, else doubles): every row with a usable vector;
    land it to fix ``row``."""
    kind = rows.schema[vector_col].dataType
    v = F.col(f"`{vector_col}`")
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)):
        v = v.cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL").where(good)
            .where(F.exists("v", lambda x: x != 0))
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"))


def parts_of(sizes: np.ndarray, chunk: int) -> np.ndarray:
    """Number of the group of every leaf: consecutive leaves of together at most ``chunk``
    vectors share one."""
    part, held, out = 0, 0, []
    for n in sizes.tolist():
        if held and held + n > chunk:
            part, held = part + 1, 0
        held += n
        out.append(part)
    return np.array(out, np.int64)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


class Lists:
    """A column of lists as one array of their values."""

    def __init__(self, column: pa.ChunkedArray):
        lists = column.combine_chunks()
        self.values = lists.flatten().to_numpy(zero_copy_only=False)
        self.lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        self.at = np.append(0, np.cumsum(self.lengths))

    def rows(self, first: int, end: int) -> np.ndarray:
        """Consecutive lists of one length."""
        return self.values[self.at[first]:self.at[end]].reshape(end - first, -1)


def first_copies(x: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of equal rows: ties go to smaller ids, so no other is a result."""
    x = np.ascontiguousarray(x)
    _, of = np.unique(x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(of, kind="stable")
    new = np.append(True, np.diff(of[order]) != 0)
    start = np.flatnonzero(new)[np.cumsum(new) - 1]
    return np.sort(order[np.arange(len(order)) - start < n])


def compared(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of a block (``row, vec_id, v, leaf``) for every one of its queries
    (``q_row, query_id, v, leaves``), among the leaves that it visits."""
    leaf, ids, own = (left[c].to_numpy() for c in ("leaf", "vec_id", "row"))
    order = np.lexsort((own, ids, leaf))
    leaf, ids, own = leaf[order], ids[order], own[order]
    vectors = Lists(left.select(["v"]).take(pa.array(order))["v"])
    q_own, q_ids = (right[c].to_numpy() for c in ("q_row", "query_id"))
    queries, visits = Lists(right["v"]), Lists(right["leaves"])
    place, of_length = np.zeros(len(right), np.int64), {}
    for n in np.unique(queries.lengths).tolist():
        here = np.flatnonzero(queries.lengths == n)
        place[here] = np.arange(len(here))
        of_length[n] = queries.values[(queries.at[here][:, None] + np.arange(n))].astype(np.float64)
    # The best so far of every query; the least of them is what a vector has to reach.
    score, found = np.full((len(right), k), -np.inf), np.zeros((len(right), k), np.int64)
    asks = np.repeat(np.arange(len(right)), visits.lengths)
    by_leaf = np.argsort(visits.values, kind="stable")
    asked = visits.values[by_leaf]
    for n in np.unique(asked).tolist():
        (first, ask), (end, ask_end) = ((np.searchsorted(leaf, n, side), np.searchsorted(asked, n, side)) for side in ("left", "right"))
        if first == end:
            continue
        here = vectors.rows(first, end)
        kept = first_copies(here, k + 1)
        v, v_ids, v_own = here[kept].astype(np.float64), ids[first:end][kept], own[first:end][kept]
        vv, unit, by_own = (v * v).sum(1), normalised(v).T, np.argsort(v_own)
        step = max(1, PAIRS // len(v))
        for at in range(ask, ask_end, step):
            a = asks[by_leaf[at:min(at + step, ask_end)]]
            q = of_length[v.shape[1]][place[a]]
            rough = normalised(q) @ unit
            same = by_own[np.minimum(np.searchsorted(v_own, q_own[a], sorter=by_own), len(v) - 1)]
            itself = np.flatnonzero(v_own[same] == q_own[a])
            rough[itself, same[itself]] = -np.inf
            # The matrix product may round equal vectors apart: score its best again.
            least = score[a, -1]
            fresh = np.flatnonzero(least == -np.inf)
            if len(fresh):
                least[fresh] = np.partition(rough[fresh], len(v) - min(k, len(v)), axis=1)[:, len(v) - min(k, len(v))]
            i, j = np.nonzero(rough >= np.maximum(least - 1e-9, -2)[:, None])
            qq, exact = (q * q).sum(1), np.empty(len(i))
            for x in range(0, len(i), piece := max(1, PAIRS // v.shape[1])):
                i_, j_ = i[x:x + piece], j[x:x + piece]
                exact[x:x + piece] = (v[j_] * q[i_]).sum(1) / np.sqrt(vv[j_] * qq[i_])
            some = np.unique(i)
            row = np.append(np.repeat(some, k), i)
            all_ids, all_scores = np.append(found[a[some]], v_ids[j]), np.append(score[a[some]], exact)
            order = np.lexsort((all_ids, -all_scores, row))
            start = np.searchsorted(row[order], some)
            best = order[start[:, None] + np.arange(k)]
            found[a[some]], score[a[some]] = all_ids[best], all_scores[best]
    i, j = np.nonzero(score > -np.inf)
    return pa.table({"q_row": q_own[i], "query_id": q_ids[i], "vec_id": found[i, j], "score": score[i, j]})


def visits(batches: Iterator[pd.DataFrame], forest: Forest, parts: np.ndarray, sizes: list[int], k: int) -> Iterator[pd.DataFrame]:
    """The visits of queries, a row for each group of leaves, in pieces of about ``PIECE`` rows."""
    names, out = ["q_row", "query_id", "v", "part", "leaves"], []
    for batch in batches:
        for row, query, v in zip(batch["row"].tolist(), batch["vec_id"].tolist(), batch["v"], strict=True):
            leaves = np.sort(np.fromiter(forest.visited(v, sizes, k), np.int32))
            part, at = np.unique(parts[leaves], return_index=True)  # leaves of a group follow each other
            out += [(row, query, v, p, x) for p, x in zip(part.tolist(), np.split(leaves, at[1:]))]
            if len(out) >= PIECE:
                yield pd.DataFrame(out, columns=names)
                out = []
    yield pd.DataFrame(out, columns=names)


def nearest_neighbours(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                       k: int = K, every: int = EVERY, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every query."""
    vectors = valid_vectors(rows, id_col, vector_col)
    kind = vectors.schema["v"].dataType.simpleString()
    counts = {r["n"]: r["count"] for r in vectors.groupBy(F.size("v").alias("n")).count().collect()}
    total = sum(counts.values())
    dims = sum(n * c for n, c in counts.items()) // max(1, total)
    fit = min(FIT, max(256, FIT_VALUES // max(1, dims)))
    # The least hashes are below twice their share of the range, so no task sends more than its part.
    picked = vectors.withColumn("hash", F.xxhash64("vec_id", F.col("v").cast("array<double>"), "row"))
    if 2 * fit < total:
        picked = picked.where(F.col("hash") < F.lit(2 * fit * 2**64 // total - 2**63))
    sample = picked.orderBy("hash", "row").limit(fit).select("v").collect()
    forest = Forest(sorted(counts), [r["v"] for r in sample], total, recall, k)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                yield part.assign(leaf=forest.assign(part["v"]))

    placed = landed(vectors.mapInPandas(place, f"row long, vec_id long, v {kind}, leaf int"), "ann-leaves")
    sizes = np.zeros(forest.leaves, np.int64)  # one count per leaf
    for r in placed.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    longest = max(1, *counts, 1)
    chunk = min(CHUNK, max(LEAST_CHUNK, -(-total // GROUPS)), max(1, CHUNK_VALUES // longest))
    parts, held = parts_of(sizes, chunk), sizes.tolist()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return visits(batches, forest, parts, held, k)

    walked = placed.where(F.pmod("vec_id", F.lit(every)) == 0).select("row", "vec_id", "v").mapInPandas(
        walk, f"q_row long, query_id long, v {kind}, part long, leaves array<int>")
    walked = landed(walked, "ann-visits")
    asked = np.zeros(parts.max(initial=0) + 1, np.int64)
    for r in walked.groupBy("part").count().collect():
        asked[r["part"]] = r["count"]
    # Every block of vectors meets every block of the queries that visit its leaves.
    chunks = np.zeros(len(asked), np.int64)
    np.maximum.at(chunks, parts, -(-sizes // chunk))
    blocks = -(-asked // max(1, min(QUERIES, QUERY_VALUES // longest)))
    of_part = lambda counts: F.get(F.array(*[F.lit(int(n)) for n in counts]), F.col("part").cast("int"))
    up_to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    part = F.get(F.array(*[F.lit(int(n)) for n in parts]), F.col("leaf"))
    index = (placed.withColumn("part", part.cast("long")).where(of_part(blocks) > 0)
             .withColumn("chunk", F.pmod(F.xxhash64("row"), of_part(chunks))).withColumn("block", up_to(of_part(blocks))))
    asking = (walked.withColumn("block", F.pmod(F.xxhash64("q_row"), of_part(blocks)).cast("int"))
              .withColumn("chunk", up_to(of_part(chunks))).withColumn("chunk", F.col("chunk").cast("long")))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return compared(left, right, k)

    keys = ["part", "chunk", "block"]
    found = index.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
        compare, "q_row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector among all."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
