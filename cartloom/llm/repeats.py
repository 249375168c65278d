"""Passages that repeat across documents, found by anchors.

Documents are sequences of units (bytes or words). A *window* is ``width`` consecutive units;
a window is repeated if its units also start in a document with a smaller id. The work runs in
three rounds over the texts; every round keeps only what may still belong to a repeated window:

1. *Anchors*: every window holds an anchor, a short run of units at a place that is chosen by
   a rule, in the same way wherever the window occurs. Anchors meet by hash; an anchor that
   occurs in one document only can hold no repeated window and is dropped.
2. *Windows*: the windows around the remaining anchors meet by a 64-bit hash; all but the
   document with the smallest id are marked.
3. *Cut*: the marked units are removed.

An anchor rule may also give the hash of an anchor's whole surroundings (all windows that hold
it). If these repeat, all their windows do, and the anchor skips round 2.

Between the rounds travel packed columns: sorted deltas and hash bytes, compressed, one row per
group of texts and bucket of hashes (``BUCKET_BYTES`` of text each). Anchors or windows that
repeat within a group of texts are settled there, so a passage that a third of all documents
share reaches its bucket with a few entries per group of texts, not one per document. Texts
move between rounds in shards by document id (``SHARD_BYTES`` of text each). All counts follow
from the number of text bytes; nothing is collected on the driver but that number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cartloom.llm.common import landed
from cartloom.llm.tokens import mix64

#: Text bytes per bucket of hashes and per shard of documents.
BUCKET_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
#: Text bytes that one task handles at a time.
GROUP_BYTES = 8 << 20
#: Anchors with more different surroundings than this in one group of texts go to round 2 there.
CROWD = 64

PACKED = "key long, blob binary"
_EMPTY = np.empty(0, np.int64)


def pack(doc: np.ndarray, ver: np.ndarray, pos: np.ndarray, *more: tuple[np.ndarray, int]) -> bytes:
    """Entries, sorted by document and position, as one compressed value; ``more`` are columns
    of hashes with the number of low bytes to keep."""
    planes = [np.int64(len(doc)).tobytes()]
    for column in (doc, ver, pos):
        delta = np.diff(column.astype(np.int64), prepend=0)
        planes.append(delta.view(np.uint8).reshape(-1, 8).T.tobytes())
    for column, size in more:
        planes.append(column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, *sizes: int) -> list[np.ndarray]:
    """The columns of ``pack``."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = int(raw[:8].view(np.int64)[0]), 8, []
    for size in (8, 8, 8, *sizes):
        column = np.zeros((n, 8), np.uint8)
        column[:, :size] = raw[at:at + n * size].reshape(size, n).T
        column = column.reshape(-1).view(np.int64 if len(out) < 3 else np.uint64)
        out.append(np.cumsum(column) if len(out) < 3 else column)
        at += n * size
    return out


def unpack_all(blobs: list[bytes], *sizes: int) -> list[np.ndarray]:
    parts = [unpack(b, *sizes) for b in blobs]
    if not parts:
        return [_EMPTY] * 3 + [np.empty(0, np.uint64)] * len(sizes)
    return [np.concatenate(columns) for columns in zip(*parts, strict=True)]


def edges_of(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    if not len(values):
        return _EMPTY
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Number of its run of equal rows, for every row."""
    if not len(columns[0]):
        return _EMPTY
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def first_of(run: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For every row the least value of its run."""
    if not len(run):
        return values
    at = np.flatnonzero(np.diff(run, prepend=-1))
    return np.minimum.reduceat(values, at)[run]


def kinds_of(run: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """For every row whether its run holds rows that differ in a column."""
    if not len(run):
        return np.empty(0, bool)
    at = np.flatnonzero(np.diff(run, prepend=-1))
    differ = np.zeros(len(at), bool)
    for c in columns:
        differ |= np.minimum.reduceat(c, at) != np.maximum.reduceat(c, at)
    return differ[run]


class Rows:
    """Packed rows by key: collects columns, splits them and gives Arrow batches."""

    SCHEMA = pa.schema([("key", pa.int64()), ("blob", pa.binary())])

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.blobs: list[bytes] = []

    def add(self, key: np.ndarray, doc: np.ndarray, ver: np.ndarray, pos: np.ndarray,
            *more: tuple[np.ndarray, int]) -> None:
        order = np.lexsort((pos, ver, doc, key))
        key = key[order]
        edges = edges_of(key)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = order[a:b]
            self.keys.append(int(key[a]))
            self.blobs.append(pack(doc[part], ver[part], pos[part], *[(c[part], s) for c, s in more]))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.keys, pa.int64()), pa.array(self.blobs, pa.binary())], schema=self.SCHEMA)


class Texts:
    """A group of documents, by id: ``doc``, ``ver`` and the raw texts."""

    def __init__(self, doc: np.ndarray, ver: np.ndarray, raws: list[bytes]):
        order = np.lexsort((ver, doc))
        self.doc, self.ver = doc[order], ver[order]
        self.raws = [raws[i] for i in order]


class Rule:
    """What an operator chooses: its units, its anchors and its windows."""

    #: Whether ``anchors`` gives the hash of the surroundings.
    surroundings = False

    def anchors(self, raws: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text index, position, hash, hash of the surroundings) of every anchor."""
        raise NotImplementedError

    def windows(self, raws: list[bytes], text: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text index, start, 64-bit hash) of every window that holds one of the anchors."""
        raise NotImplementedError

    def cut(self, raw: bytes, covered: np.ndarray, windows: np.ndarray) -> tuple:
        """(units, removed units, removed runs, kept bytes) of a text, given the anchors whose
        surroundings repeat and the starts of repeated windows."""
        raise NotImplementedError


def shard_of(doc: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(doc.astype(np.uint64) + np.uint64(0x5EED)) % np.uint64(shards)).astype(np.int64)


#: Kinds of marks; a mark's kind is kept in the last bits of its position.
COVERED, EXPAND, REPEATED = 0, 1, 2


def _marks(rows: Rows, forward: Callable[[np.ndarray], np.ndarray], texts: tuple, kind: int,
           chosen: np.ndarray) -> None:
    doc, ver, pos = texts
    rows.add(forward(doc[chosen]), doc[chosen], ver[chosen], pos[chosen] * 4 + kind)


def _settle(doc: np.ndarray, h: np.ndarray, u: np.ndarray, surroundings: bool, crowd: bool) -> tuple:
    """Decide anchors among each other. Returns the order by (h, u), and in that order: those
    whose surroundings repeat a smaller document's, those that must be expanded, and those that
    must meet the anchors of other groups."""
    order = np.lexsort((doc, u, h))
    doc, h, u = doc[order], h[order], u[order]
    by_h = runs(h)
    shared = kinds_of(by_h, doc)
    if not surroundings:
        if crowd:  # two documents stand for an anchor that is settled here
            first = doc == first_of(by_h, doc)
            second = ~first & (doc == first_of(by_h, np.where(first, np.iinfo(np.int64).max, doc)))
            start = np.diff(by_h * 4 + first + 2 * second, prepend=-1) != 0
            send = ~shared | (start & (first | second))
        else:
            send = np.zeros(len(doc), bool)
        return order, np.zeros(len(doc), bool), shared, send
    by_u = runs(h, u)
    covered = doc > first_of(by_u, doc)
    expand = ~covered & shared & kinds_of(by_h, u)
    send = ~covered
    if crowd:
        at = np.flatnonzero(np.diff(by_h, prepend=-1))
        crowds = (np.add.reduceat((np.diff(by_u, prepend=-1) != 0).astype(np.int64), at) > CROWD)[by_h] if len(at) else expand
        # Different surroundings that stand for the crowd: those of its first two rows that differ.
        new_u = np.diff(by_u, prepend=-1) != 0
        nth = np.cumsum(new_u) - (np.cumsum(new_u)[at] - 1)[by_h] if len(at) else _EMPTY
        send &= ~crowds | (new_u & (nth <= 2)) | ~expand
    return order, covered, expand, send


def find_repeats(docs: DataFrame, rule: Rule, schema: T.StructType, finish: Callable,
                 id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Run the three rounds. ``finish(table, results)`` makes the output table of a shard from
    its rows (``_id``, ``_text`` and, as a struct ``_row``, the columns ``keep``) and one
    ``rule.cut`` result per row; ``schema`` is the output's."""
    docs = versioned(docs, id_col, text_col, keep)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(4, -(-total // BUCKET_BYTES))
    shards = max(4, -(-total // SHARD_BYTES))
    sizes = (5, 6) if rule.surroundings else (5,)

    def forward(doc: np.ndarray) -> np.ndarray:
        """Marks pass through the buckets' step under the key of their shard."""
        return -1 - shard_of(doc, shards)

    def bucket_of(h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Texts]:
        for table in _groups(batches):
            ids = table.column("_id")
            use = np.flatnonzero(ids.is_valid().to_numpy())
            table = table.take(use)
            yield Texts(table.column("_id").to_numpy(), table.column("_ver").to_numpy(),
                        _raws(table.column("_text")))

    def meet_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in texts_of(batches):
            text, pos, h, u = rule.anchors(texts.raws)
            order, covered, expand, send = _settle(texts.doc[text], h, u, rule.surroundings, True)
            text, pos, h, u = text[order], pos[order], h[order], u[order]
            doc, ver = texts.doc[text], texts.ver[text]
            rows = Rows()
            for kind, chosen in ((COVERED, covered), (EXPAND, expand)):
                _marks(rows, forward, (doc, ver, pos), kind, chosen)
            more = [(h[send], 5), (u[send], 6)][:len(sizes)]
            rows.add(bucket_of(h[send]), doc[send], ver[send], pos[send], *more)
            yield rows.batch()

    def settle_anchors(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table
        doc, ver, pos, h, *u = unpack_all(table.column("blob").to_pylist(), *sizes)
        u = u[0] if u else np.zeros(len(doc), np.uint64)
        order, covered, expand, _ = _settle(doc, h, u, rule.surroundings, False)
        doc, ver, pos = doc[order], ver[order], pos[order]
        rows = Rows()
        for kind, chosen in ((COVERED, covered), (EXPAND, expand)):
            _marks(rows, forward, (doc, ver, pos), kind, chosen)
        return pa.Table.from_batches([rows.batch()])

    def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            ids = table.column("_id")
            valid = ids.is_valid().to_numpy()
            n = len(valid)
            shard = np.arange(n, dtype=np.int64) % shards  # rows without an id go anywhere
            shard[valid] = shard_of(ids.drop_null().to_numpy(), shards)
            order = np.argsort(shard, kind="stable")
            table, shard = table.take(order), shard[order]
            edges = edges_of(shard)
            rows = Rows()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_table(table.slice(a, b - a).combine_chunks())
                rows.keys.append(-1 - int(shard[a]))
                rows.blobs.append(zstandard.ZstdCompressor(level=2).compress(sink.getvalue().to_pybytes()))
            yield rows.batch()

    def shard_table(table: pa.Table) -> pa.Table | None:
        parts = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(b)).read_all()
                 for b in table.column("blob").to_pylist()]
        return pa.concat_tables(parts).combine_chunks() if parts else None

    def marks_of(table: pa.Table) -> tuple[np.ndarray, ...]:
        doc, ver, pos = unpack_all(table.column("blob").to_pylist())
        order = np.lexsort((pos, ver, doc))
        return doc[order], ver[order], pos[order] >> 2, pos[order] & 3

    def meet_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = Rows()
        doc, ver, pos, kind = marks_of(right)
        keep = kind == EXPAND
        table = shard_table(left) if keep.any() else None
        if table is not None:
            table = table.take(np.flatnonzero(table.column("_id").is_valid().to_numpy()))
            texts = Texts(table.column("_id").to_numpy(), table.column("_ver").to_numpy(),
                          _raws(table.column("_text")))
            index, place = _locate(texts, doc[keep], ver[keep], pos[keep])
            at, start, h = _windows_in_groups(rule, texts, index, place)
            order = np.lexsort((at, h))
            at, start, h = at[order], start[order], h[order]
            d, v = texts.doc[at], texts.ver[at]
            later = d > first_of(runs(h), d)
            _marks(rows, forward, (d, v, start), REPEATED, later)
            send = ~later
            rows.add(bucket_of(h[send]), d[send], v[send], start[send], (h[send], 8))
        return pa.Table.from_batches([rows.batch()])

    def settle_windows(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table
        doc, ver, start, h = unpack_all(table.column("blob").to_pylist(), 8)
        order = np.lexsort((doc, h))
        doc, ver, start, h = doc[order], ver[order], start[order], h[order]
        rows = Rows()
        _marks(rows, forward, (doc, ver, start), REPEATED, doc > first_of(runs(h), doc))
        return pa.Table.from_batches([rows.batch()])

    def cut_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        table = shard_table(left)
        if table is None:
            return to_arrow_schema(schema).empty_table()
        doc, ver, pos, kind = marks_of(right)
        of = {}
        edges = edges_of(runs(doc, ver))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            of[int(doc[a]), int(ver[a])] = (a, b)
        results = []
        for i, v, raw in zip(table.column("_id").to_pylist(), table.column("_ver").to_pylist(),
                             _raws(table.column("_text")), strict=True):
            a, b = of.get((i, v), (0, 0))
            results.append(rule.cut(raw, pos[a:b][kind[a:b] == COVERED], pos[a:b][kind[a:b] == REPEATED]))
        return finish(table, results)

    light = docs.select("_id", "_ver", "_text")
    met = light.mapInArrow(meet_anchors, PACKED)
    first_marks = landed(met.groupBy("key").applyInArrow(settle_anchors, PACKED), "repeat-anchors")
    windows = (light.mapInArrow(shard_rows, PACKED).groupBy("key").cogroup(first_marks.groupBy("key"))
               .applyInArrow(meet_windows, PACKED))
    settled = windows.groupBy("key").applyInArrow(settle_windows, PACKED)
    marks = first_marks.unionByName(settled) if rule.surroundings else settled
    whole = docs.mapInArrow(shard_rows, PACKED)
    return whole.groupBy("key").cogroup(marks.groupBy("key")).applyInArrow(cut_shard, schema)


def _raws(column: pa.ChunkedArray) -> list[bytes]:
    """The texts as UTF-8; null: empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in groups of about ``GROUP_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        lengths = np.array([0 if n is None else n for n in
                            pc.binary_length(batch.column("_text")).to_pylist()], np.int64)
        at = 0
        ends = np.cumsum(lengths)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + GROUP_BYTES - size, "right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - base)
            at = to
            if size >= GROUP_BYTES or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _locate(texts: Texts, doc: np.ndarray, ver: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and position of marks; rows that repeat a document share its marks through
    the first of them."""
    index = {}
    for i, key in enumerate(zip(texts.doc.tolist(), texts.ver.tolist(), strict=True)):
        index.setdefault(key, i)
    at = np.fromiter((index[k] for k in zip(doc.tolist(), ver.tolist(), strict=True)), np.int64, len(doc))
    return at, pos


def _windows_in_groups(rule: Rule, texts: Texts, index: np.ndarray, place: np.ndarray) -> tuple:
    """``rule.windows`` over the texts that have marks, ``GROUP_BYTES`` / 4 of them at a time."""
    order = np.lexsort((place, index))
    index, place = index[order], place[order]
    used, starts = np.unique(index, return_index=True)
    ends = np.append(starts[1:], len(index))
    out, at = [], 0
    while at < len(used):
        to, size = at, 0
        while to < len(used) and (to == at or size < GROUP_BYTES // 4):
            size += len(texts.raws[used[to]])
            to += 1
        a, b = starts[at], ends[to - 1]
        local = np.searchsorted(used[at:to], index[a:b])
        t, s, h = rule.windows([texts.raws[i] for i in used[at:to]], local, place[a:b])
        out.append((used[at:to][t], s, h))
        at = to
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def versioned(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``_id``, ``_text``, the kept columns and ``_ver``: texts that share an id are told apart
    by ``_ver``, which is 0 unless an id repeats with different texts."""
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")] if keep else []
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("_text"), *row)
    again = docs.where("_id IS NOT NULL").groupBy("_id").count().where("count > 1").select("_id")
    if again.limit(1).count() == 0:
        return docs.withColumn("_ver", F.lit(0).cast("long"))
    digest = F.xxhash64(F.coalesce("_text", F.lit("")))
    texts = docs.select("_id", digest.alias("_th")).join(again, "_id", "left_semi").distinct()
    versions = texts.groupBy("_id").agg(F.sort_array(F.collect_set("_th")).alias("_all"))
    return (docs.withColumn("_th", digest).join(versions, "_id", "left")
            .withColumn("_ver", F.coalesce(F.array_position("_all", F.col("_th")) - 1, F.lit(0)).cast("long"))
            .drop("_all", "_th"))
