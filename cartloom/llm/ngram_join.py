"""N-gram Jaccard join by MinHash banding.

Documents whose sets of ``SHINGLE``-word n-grams have a Jaccard similarity of at least
``THRESHOLD`` are linked; links join documents to classes. Words are runs of other characters
than space and 0x09-0x0D; a text of fewer words than a shingle has one n-gram, all its words.

1. Equal sets are folded into one by a 128-bit digest of the set.
2. ``banding`` chooses the least costly bands and rows that find a pair at the threshold with
   probability ``RECALL``; sets that share a band's hash meet in a bucket.
3. In each bucket every set is compared with the bucket's most central one (the one that
   shares its buckets with the most sets) on the full n-gram sets, and verified links are
   joined to classes (large-star and small-star rounds).
4. Sets of one bucket that are in different classes are compared with each other too, so that
   a class is never split by the choice of step 3. Blocks of ``BLOCK`` signatures (one byte of
   each of ``HASHES`` MinHash values) meet in numpy, and only pairs whose estimate is at most
   ``DEVIATIONS`` standard deviations below the threshold (one true link in 300,000 is farther)
   are handed on to the comparison of the full sets.
   Sets of one class need no further comparison to find the classes.
5. All links lie within classes, so the links of a set are counted there: ``LINK_BLOCK`` sets
   of a class meet as many others at once, and the sizes of all intersections of their full
   sets come from products of indicator matrices (``link_counts``). Counts are handed on, one
   per set and block, never pairs; the work grows with the square of a class, the rows do not.

Result per document: ``class_id`` (least id of its class), ``n_links`` (all other sets that are
similar enough to its n-gram set) and ``n_copies`` (other documents with an equal set).

Edge cases: texts that are null or have no word, and rows with a null id, form no link: their
class is their own id. Rows that repeat an id with the same text count as one document, with
another text as documents of the same id. Texts are used whole. Extra columns are ignored; an
empty table gives an empty result.

Scale: every step is a join or aggregate on hashes; hot sides are landed, so Spark can split
the joins on them; the driver only sees counts that end the star rounds. What is kept of every
document are its band hashes; signatures and full sets are kept of those sets alone that share
a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table
from cartloom.llm.tokens import SPACES, Words, groups, mix64, slide

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
#: MinHash values that bands should use at most (more where the recall needs them), and how many
#: a signature keeps a byte of.
MAX_HASHES = 128
HASHES = 512
DEVIATIONS = 4.5
#: Sets of one bucket whose signatures are compared at once.
BLOCK = 1024
#: Sets of one class whose links are counted at once, and the bytes of packed sets they may hold.
LINK_BLOCK = 2048
LINK_BYTES = 1 << 25


def banding(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence the fewest chance meetings, that reach
    ``recall`` at the threshold with at most ``most`` hashes; if bands of one row need more than
    these, as many of them as it takes."""
    best = None
    for rows in range(1, most + 1):
        chance = threshold ** rows
        if best and chance < 1e-9:
            break
        bands = math.ceil(math.log(1 - recall) / math.log1p(-chance)) if chance < 1 else 1
        if best is None or bands * rows <= most:
            best = (bands, rows)
    return best


def shingle_sets(raws: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of every text; empty without words."""
    words = Words(raws, SPACES)
    if len(words.hashes) >= size:
        every = slide(words.hashes, size)
    for a, b in zip(words.of[:-1].tolist(), words.of[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(every[a:b - size + 1])
        elif b > a:
            yield slide(words.hashes[a:b], b - a) + np.uint64(b - a)
        else:
            yield np.empty(0, np.uint64)


class Hasher:
    """MinHash bands and digests of sets."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(5)
        self.bands, self.rows = bands, rows
        n = max(HASHES, bands * rows)
        self.mul = rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def least(self, values: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` MinHash values."""
        x = (values >> np.uint64(32)).astype(np.uint32)
        least = np.full(n, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 4096):
            part = np.multiply.outer(x[at:at + 4096], self.mul[:n])
            part += self.add[:n]
            np.minimum(least, part.min(axis=0), out=least)
        return least

    def keys(self, values: np.ndarray) -> np.ndarray:
        """One 64-bit key per band."""
        key = np.arange(self.bands, dtype=np.uint64)
        banded = self.least(values, self.bands * self.rows)
        for r in range(self.rows):
            key = mix64(key + banded[r::self.rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return key

    def signature(self, values: np.ndarray) -> bytes:
        """One byte of every MinHash value."""
        return mix64(self.least(values, len(self.mul)).astype(np.uint64)).astype(np.uint8).tobytes()


def alike(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two signature blocks (rows of bytes) whose similarity may reach the
    threshold: those not more than ``DEVIATIONS`` below it."""
    n = a.shape[1]
    least = n * (threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / n))
    step = max(1, (1 << 24) // max(1, b.size))
    for at in range(0, len(a), step):
        same = (a[at:at + step, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int32)
        x, y = np.nonzero(same >= least)
        yield x + at, y


def set_digest(values: np.ndarray) -> bytes:
    a = mix64(values).sum(dtype=np.uint64)
    b = mix64(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


#: Bits of an n-gram hash that are kept for the comparison of two sets.
KEPT_BITS = 48


def pack_set(values: np.ndarray) -> bytes:
    """Sorted hashes as compressed byte planes of their differences."""
    cut = np.unique(values >> np.uint64(64 - KEPT_BITS))
    delta = np.diff(cut, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(delta.view(np.uint8).reshape(-1, 8)[:, :KEPT_BITS // 8].T.tobytes())


def unpack_set(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(KEPT_BITS // 8, -1)
    delta = np.zeros((planes.shape[1], 8), np.uint8)
    delta[:, :KEPT_BITS // 8] = planes.T
    return np.cumsum(delta.reshape(-1).view(np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def link_counts(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Links of every set of ``a``, then of every set of ``b``, to the sets of the other list;
    without ``b`` the links of the sets of ``a`` to each other."""
    sets = a + (b or [])
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, of = every[order], of[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    starts = np.flatnonzero(new)
    held = np.diff(np.append(starts, len(every)))
    # A hash that one set alone holds is in no intersection.
    column = np.where(held > 1, np.cumsum(held > 1) - 1, -1)[np.cumsum(new) - 1]
    of, column = of[column >= 0], column[column >= 0]
    n, size = len(a), np.array([len(x) for x in sets], np.int64)
    both = np.zeros((n, len(b) if b is not None else n), np.int64)
    width = max(64, (1 << 24) // len(sets))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[of[lo:hi], column[lo:hi] - at] = 1
        both += (part[:n] @ (part[n:] if b is not None else part).T).astype(np.int64)
    other = size[n:] if b is not None else size
    linked = both / (size[:n, None] + other[None, :] - both) >= threshold
    if b is None:
        np.fill_diagonal(linked, False)
        return linked.sum(axis=1)
    return np.concatenate((linked.sum(axis=1), linked.sum(axis=0)))


def degrees(label: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """``sid, n_links`` of every set that is in a class (``node, label``) with others."""
    placed = landed(label.withColumnRenamed("node", "sid")
                    .join(full.select("sid", F.length("blob").alias("size")), "sid"), "join-class-members")
    classes = landed(placed.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
                     .select("label", "n", F.ceil(F.greatest(F.col("n") / LINK_BLOCK, F.col("size") / LINK_BYTES))
                             .cast("int").alias("blocks")), "join-class-sizes")
    known = landed(placed.join(classes, "label").select("sid", "label", "n", "blocks"), "join-class-blocks")
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    sided = (known.where("n > 2").withColumn("own", own).join(full, "sid")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("label", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     "own", "sid", "blob"))

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        sid = rows.column("sid").to_pylist()
        sets = [unpack_set(x) for x in rows.column("blob").to_pylist()]
        x, y = key[1].as_py(), key[2].as_py()
        own = rows.column("own").to_numpy()
        first, second = np.flatnonzero(own == x).tolist(), np.flatnonzero(own == y).tolist()
        if x == y:
            second = []
        n = np.zeros(0, np.int64)
        if first and (second or x == y):
            n = link_counts([sets[i] for i in first], None if x == y else [sets[i] for i in second], threshold)
        return pa.table({"sid": pa.array([sid[i] for i in first + second][:len(n)], pa.binary()),
                         "n": pa.array(n, pa.int64())})

    counted = sided.groupBy("label", "x", "y").applyInArrow(count, "sid binary, n long")
    # Two sets are one class by their link.
    return (counted.unionByName(known.where("n = 2").select("sid", F.lit(1).cast("long").alias("n")))
            .groupBy("sid").agg(F.sum("n").alias("n_links")))


def band_keys(docs: DataFrame, hasher: Hasher, size: int) -> DataFrame:
    """``doc_id, th`` (as given), ``sid`` (digest of the set; null without words) and ``bands``
    of every document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, keys = [], []
            for _, _, raws in groups(batch.column("text").to_pylist()):
                for values in shingle_sets(raws, size):
                    sids.append(set_digest(values) if len(values) else None)
                    keys.append(hasher.keys(values).view(np.int64).tolist() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(sids, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "th", "sid", "bands"])

    return docs.mapInArrow(sign, "doc_id long, th long, sid binary, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (the least node of its component) for every node of ``edges`` (a, b)."""
    now = landed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "star")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = landed(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u <> v").distinct(), "star-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = landed(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                     .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "star-small")
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of the pairs (a, b) those whose sets are similar enough."""

    @F.pandas_udf("double")
    def similarity(left, right):
        import pandas as pd

        kept: dict[bytes, np.ndarray] = {}  # the left set repeats in consecutive pairs
        out = []
        for x, y in zip(left, right, strict=True):
            if x not in kept:
                kept = {x: unpack_set(x)}
            out.append(jaccard(kept[x], unpack_set(y)))
        return pd.Series(out, dtype="float64")

    right = sets.select(F.col("sid").alias("b"), F.col("blob").alias("blob_b"))
    left = sets.select(F.col("sid").alias("a"), F.col("blob").alias("blob_a"))
    return (pairs.join(right, "b").join(left, "a")
            .where(similarity("blob_a", "blob_b") >= threshold).select("a", "b").distinct())


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE, threshold: float = THRESHOLD,
                    recall: float = RECALL, with_text: bool = False, links: bool = True) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies``, one row per document; ``with_text`` adds ``th``,
    a hash of its text that tells documents of one id apart. Without ``links`` the classes are
    the same, but the links within them are not counted (no ``n_links``)."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    hasher = Hasher(*banding(threshold, recall))
    signed = landed(band_keys(texts.withColumn("th", F.xxhash64("text")), hasher, size), "join-signatures")
    use = signed.where("doc_id IS NOT NULL AND sid IS NOT NULL")
    sets = landed(use.groupBy("sid").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"),
                                         F.first("bands").alias("bands")), "join-sets")
    member = sets.select("sid", F.explode("bands").alias("key"))
    shared = landed(member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "join-buckets")
    meeting = landed(member.join(shared, "key"), "join-meeting")
    scored = landed(meeting.join(meeting.groupBy("sid").agg(F.sum("n").alias("score")), "sid")
                    .select("key", "sid", "score"), "join-scored")
    pivots = landed(scored.groupBy("key").agg(F.max(F.struct("score", "sid")).alias("m"))
                    .select("key", F.col("m.sid").alias("pivot")), "join-pivots")
    bucket = landed(scored.join(pivots, "key").select("key", "sid", "pivot"), "join-members")
    # Full n-gram sets and signatures of everything that shares a bucket.
    wanted = bucket.select("sid").distinct().join(sets.select("sid", "rep"), "sid")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, blobs, keys, signs = [], [], [], []
            wanted_sids = batch.column("sid").to_pylist()
            for first, _, raws in groups(batch.column("text").to_pylist()):
                for i, values in enumerate(shingle_sets(raws, size), first):
                    if len(values) and set_digest(values) == wanted_sids[i]:  # ids may repeat
                        sids.append(wanted_sids[i])
                        blobs.append(pack_set(values))
                        keys.append(hasher.keys(values).view(np.int64).tolist())
                        signs.append(hasher.signature(values))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.binary()), pa.array(blobs, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(signs, pa.binary())], names=["sid", "blob", "bands", "signature"])

    found = (texts.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id")
             .select("sid", "text")
             .mapInArrow(full_sets, "sid binary, blob binary, bands array<long>, signature binary"))
    full = landed(found, "join-full-sets")
    star = bucket.where("sid <> pivot").select(F.least("pivot", "sid").alias("a"),
                                               F.greatest("pivot", "sid").alias("b")).distinct()
    star = landed(star, "join-star")
    paired = landed(_verified(star, full, threshold), "join-links")
    label = landed(components(paired), "join-labels")
    # Sets of one bucket in different classes, in blocks of signatures.
    placed = bucket.select("key", "sid").join(label.withColumnRenamed("node", "sid"), "sid", "left").select(
        "key", "sid", F.coalesce("label", "sid").alias("label"))
    mixed = landed(placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                             F.count(F.lit(1)).alias("n")).where("lo <> hi")
                   .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "join-mixed")
    block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    marks = full.groupBy("sid").agg(F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    sided = (landed(placed.join(mixed, "key"), "join-placed").withColumn("own", block)
             .join(marks, "sid")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     "own", "sid", "label", "signature", "bands"))

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        own, y = rows.column("own").to_numpy(), key[2].as_py()
        # Sets of one class at a time cannot pair up: leave these groups at once.
        _, klass = np.unique(np.array(rows.column("label").to_pylist(), object), return_inverse=True)
        sid = np.array(rows.column("sid").to_pylist(), object)
        found_a, found_b = [], []
        if klass.min() != klass.max():
            signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(own), -1)
            bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
            left, right = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == y)
            for i, j in alike(signs[left], signs[right], threshold):
                i, j = left[i], right[j]
                # A pair of different classes, once: in the first bucket that both are in.
                shared_key = bands[i] == bands[j]
                first = bands[i, np.argmax(shared_key, axis=1)] == key[0].as_py()
                once = (klass[i] != klass[j]) & first & (sid[i] < sid[j]) if y == key[1].as_py() else \
                    (klass[i] != klass[j]) & first
                for a, b in zip(sid[i[once]], sid[j[once]], strict=True):
                    found_a.append(min(a, b))
                    found_b.append(max(a, b))
        return pa.table({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary())})

    across = landed(sided.groupBy("key", "x", "y").applyInArrow(meet, "a binary, b binary").distinct()
                    .join(star, ["a", "b"], "left_anti"), "join-across")
    # Most sets are in no such pair, and their full sets need not move.
    named = across.select(F.col("a").alias("sid")).union(across.select("b"))
    more = landed(_verified(across, full.join(named, "sid", "left_semi"), threshold), "join-links-across")
    every = paired.unionByName(more)
    label = landed(components(every), "join-classes")
    degree = landed(degrees(label, full, threshold), "join-degrees") if links else None
    classed = (sets.select("sid", "rep", "copies").join(label.withColumnRenamed("node", "sid"), "sid", "left")
               .withColumn("label", F.coalesce("label", "sid")))
    least = landed(classed.groupBy("label").agg(F.min("rep").alias("class_id")), "join-least")
    known = landed(classed, "join-classed").join(least, "label")
    known = known.join(degree, "sid", "left") if links else known.withColumn("n_links", F.lit(0).cast("long"))
    known = landed(known.select("sid", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"), "join-known")
    # Rows without an id or a word take no part and must not all meet on the null key.
    out = use.select("doc_id", "th", "sid").join(known, "sid").select(
        "doc_id", "class_id", "n_links", (F.col("copies") - 1).alias("n_copies"), "th")
    alone = signed.where("doc_id IS NULL OR sid IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_copies"), "th")
    every = out.unionByName(alone)
    return every.drop(*([] if with_text else ["th"]), *([] if links else ["n_links"]))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies among all documents."""
    return jaccard_classes(table(spark, sf_dir, "documents"))
