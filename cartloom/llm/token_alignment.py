"""Cross-tokenizer alignment by sparse incidence products.

Tokens of two tokenizers A and B over the same bytes are aligned by matrices in compressed sparse
rows (CSR, built here from numpy arrays): token-byte incidences of A and B, whose product A * B^T
holds a value for every pair of tokens whose byte ranges overlap (an overlap link), and
token-group incidences, whose product holds the pairs of tokens of one group (shared-group
links). Groups are what the byte offsets cut where tokens of both end. Products are taken row by
row (Gustavson): a row of the left matrix gathers the rows of the right one that its columns name.

An id pair's count is the number of overlap links of the whole corpus that hold it; a link is
best if its count is the highest of its B id.

Texts are cut into pieces before a blank that stands between a visible character and a letter:
neither tokenizer has a token across it, so the matrices are block-diagonal with a block per
piece, and equal pieces have equal blocks. A block of texts multiplies each different piece once.
Where that does not hold for the given vocabularies, and for a text without such blanks, a text is
one piece. Texts are always encoded whole.

Scale: one scan, in blocks of about ``BLOCK`` bytes of text. It lands a short row per text (its
digest and its pieces by number) and a row per block with the counts of its id pairs; these alone
are shuffled by id pair, summed and joined back, at most one row per pair and block. The last step
meets blocks with their counts. No group is larger than a block or, for one B id, the vocabulary of
A. Shared-group links are counted from the row sizes of their product and written out in bounded
parts (``Alignment.shared_links``), as their number grows with the square of a group. The driver
reads the two vocabulary files (2 MB), nothing of the corpus.

Edge cases: null and empty texts, and texts whose tokens do not give back exactly the bytes of
blank and text, have no tokens: zeros and an empty ``groups_sha256``. Rows that repeat an id, and
rows without one, are texts of their own; each counts. Special tokens' strings are plain text.
Extra columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import landed, table

#: Folder of the two vocabulary files, readable by Spark.
TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of text that a block ends after, and that are multiplied at once.
BLOCK, AT_ONCE = 1 << 23, 1 << 18
#: Product entries that are written out at once.
PART = 1 << 20

LATIN = "\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"
#: A blank after a visible character and before a letter.
SEAM = re.compile(f" (?=[A-Za-z{LATIN}])(?<=[!-~{LATIN}] )")


class Csr(NamedTuple):
    """Row r has the columns ``indices[indptr[r]:indptr[r + 1]]`` with ``data`` beside them."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def incidence(indptr: np.ndarray, indices: np.ndarray, columns: int) -> Csr:
    return Csr(indptr, indices, np.ones(len(indices), np.int64), columns)


def ends(sizes: np.ndarray) -> np.ndarray:
    """0 and the running sums."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    return Csr(ends(np.bincount(m.indices, minlength=m.columns)), m.rows[order], m.data[order], len(m.indptr) - 1)


def gathered(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each entry of ``a`` gathers from ``b``."""
    return b.indptr[a.indices + 1] - b.indptr[a.indices]


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson's row products: row r is the sum of the rows of ``b`` that row r of ``a`` names."""
    many = gathered(a, b)
    first = ends(many)
    place = np.arange(first[-1]) + np.repeat(b.indptr[a.indices] - first[:-1], many)
    key = np.repeat(a.rows, many) * b.columns + b.indices[place]
    value = np.repeat(a.data, many) * b.data[place]
    if len(key) and (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    data = np.add.reduceat(value, new) if len(new) else value
    row, column = np.divmod(key[new], max(1, b.columns))
    return Csr(ends(np.bincount(row, minlength=len(a.indptr) - 1)), column, data, b.columns)


def row_sums(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``starts``."""
    total = ends(values)
    return total[starts[1:]] - total[starts[:-1]]


class Alignment:
    """Texts' tokens of A and B over the same bytes, given as ids and sizes in bytes."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        n = int(sizes_a.sum())
        self.a = incidence(ends(sizes_a), np.arange(n), n)
        self.b = incidence(ends(sizes_b), np.arange(n), n)
        #: Row: token of A, column: token of B, value: bytes that both hold.
        self.links = product(self.a, transposed(self.b))
        self.cuts = np.intersect1d(self.a.indptr[1:], self.b.indptr[1:], assume_unique=True)
        self.group_a, self.group_b = (
            incidence(np.arange(len(m.indptr)), np.searchsorted(self.cuts, m.indptr[1:]), len(self.cuts)) for m in (self.a, self.b))

    def shared(self) -> np.ndarray:
        """Shared-group links of each token of A: the row sizes of the group product."""
        return gathered(self.group_a, transposed(self.group_b))

    def shared_links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tokens of A and B that share a group, in parts of about ``PART`` links."""
        across, sizes = transposed(self.group_b), ends(self.shared())
        at = 0
        while at < len(sizes) - 1:
            stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + PART, "right")) - 1)
            part = product(incidence(np.arange(stop - at + 1), self.group_a.indices[at:stop], across.indptr.size - 1), across)
            yield part.rows + at, part.indices
            at = stop


class Pieces(NamedTuple):
    """What each of several pieces adds to a text that holds it. Row p of ``links`` has the id
    pairs of piece p (columns are places in ``pairs``) with their numbers of links."""

    fine: np.ndarray
    numbers: np.ndarray
    groups: list[bytes]
    links: Csr
    pairs: np.ndarray


class Tokenizers:
    """Both tokenizers with their tokens' bytes."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        spec = json.loads(a)
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        as_byte = byte_of()
        names = (self.a.id_to_token(i) for i in range(self.a.get_vocab_size()))
        self.bytes_a = [special.get(i, bytes(as_byte.get(c, 63) for c in t or "")) for i, t in enumerate(names)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        cut = spec.get("pre_tokenizer") or {}
        #: Whether pieces can be encoded one by one.
        self.apart = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not spec.get("normalizer")
                      and not any("▁" in p.lstrip("▁") for p in pieces))
        ids = max(len(self.bytes_a), len(pieces))
        wide = len(str(ids))
        text = [str(i).rjust(wide) + " " for i in range(ids)]
        self.digits = np.frombuffer("".join(text).encode(), np.uint8).reshape(ids, wide + 1)
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b))
        self.at_a, self.at_b = ends(self.sizes_a), ends(self.sizes_b)

    def split(self, text: str) -> list[str]:
        """The pieces; each follows a blank, the first the one that is put before the text."""
        return SEAM.split(text) if self.apart else [text]

    def align(self, pieces: list[str]) -> Pieces:
        """The blocks of pieces; one whose tokens are not the bytes of blank and piece is not
        fine and adds nothing."""
        n = len(pieces)
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)]
        ids_b = self.b.encode(pieces, num_threads=1)
        (a, of_a), (b, of_b) = (
            (np.fromiter(chain.from_iterable(ids), np.int64), np.repeat(np.arange(n), [len(x) for x in ids])) for ids in (ids_a, ids_b))
        del ids_a, ids_b
        fine = self.checked(pieces, a, of_a, b, of_b)
        in_a, in_b = fine[of_a], fine[of_b]
        a, of_a, b, of_b = a[in_a], of_a[in_a], b[in_b], of_b[in_b]
        found = Alignment(self.sizes_a[a], self.sizes_b[b])
        row = found.links.rows
        # Links of a piece, by id pair.
        wide = len(self.bytes_a) * len(self.bytes_b)
        key, times = np.unique(of_a[row] * wide + a[row] * len(self.bytes_b) + b[found.links.indices], return_counts=True)
        of_pair, pair = np.divmod(key, wide)
        pairs, place = np.unique(pair, return_inverse=True)
        group_of = of_a[np.searchsorted(found.a.indptr[1:], found.cuts)]
        per = [np.bincount(x, minlength=n) for x in (of_a, of_b, group_of, of_a[row])]
        per.append(row_sums(ends(per[0]), found.shared()))
        links = Csr(ends(np.bincount(of_pair, minlength=n)), place, times, len(pairs))
        return Pieces(fine, np.stack(per, axis=1), self.written(found, a, b, of_a, of_b, n), links, pairs)

    def checked(self, pieces: list[str], a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> np.ndarray:
        """Which pieces' tokens are the bytes of blank and piece."""
        raw = np.frombuffer((" " + " ".join(pieces)).encode(), np.uint8)
        sizes = np.array([len(p.encode()) + 1 for p in pieces], np.int64)
        fine = np.ones(len(pieces), bool)
        for ids, of, own, at, flat in ((a, of_a, self.sizes_a, self.at_a, self.flat_a), (b, of_b, self.sizes_b, self.at_b, self.flat_b)):
            fine &= np.bincount(of, weights=own[ids], minlength=len(pieces)).astype(np.int64) == sizes
            kept = ids[fine[of]]
            place = np.repeat(at[kept] - ends(own[kept])[:-1], own[kept])
            place += np.arange(len(place))
            same = np.repeat(fine, sizes)
            other = flat[place] != raw[same]
            if other.any():
                fine[np.unique(np.repeat(np.arange(len(pieces)), sizes)[same][other])] = False
        return fine

    def written(self, found: Alignment, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each of ``n`` pieces."""
        side = np.concatenate([2 * found.group_a.indices, 2 * found.group_b.indices + 1])
        order = np.argsort(side, kind="stable")
        ids, side, of = np.concatenate([a, b])[order], side[order], np.concatenate([of_a, of_b])[order]
        last = np.append(of[1:] != of[:-1], True)[:len(of)]
        step = np.append(side[1:] - side[:-1], 0)[:len(of)]
        lines = self.digits[ids]
        # The next token is of the same side, of the other side, or of the next group.
        lines[:, -1] = np.where(last, 32, np.where(step == 0, ord(","), np.where(side % 2 == 0, ord("|"), ord(";"))))
        kept = lines != 32
        text = lines[kept].tobytes()
        at = ends(np.bincount(of, weights=kept.sum(axis=1), minlength=n).astype(np.int64)).tolist()
        return [text[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]

    def align_all(self, pieces: list[str]) -> Pieces:
        """``align`` in parts of bounded size."""
        parts, at = [], 0
        while at < len(pieces) or not parts:
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size < AT_ONCE):
                size += len(pieces[stop])
                stop += 1
            parts.append(self.align(pieces[at:stop]))
            at = max(stop, 1)
        if len(parts) == 1:
            return parts[0]
        pairs, place = np.unique(np.concatenate([p.pairs[p.links.indices] for p in parts]), return_inverse=True)
        links = Csr(ends(np.concatenate([np.diff(p.links.indptr) for p in parts])), place,
                    np.concatenate([p.links.data for p in parts]), len(pairs))
        return Pieces(np.concatenate([p.fine for p in parts]), np.concatenate([p.numbers for p in parts]),
                      list(chain.from_iterable(p.groups for p in parts)), links, pairs)


def byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: visible Latin-1
    characters stand for themselves, the others in order for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


_loaded: dict[bytes, Tokenizers] = {}


def load(a: bytes, b: bytes) -> Tokenizers:
    """Tokenizers of the files' contents, once per worker."""
    key = hashlib.sha256(a + b).digest()
    if key not in _loaded:
        _loaded[key] = Tokenizers(a, b)
    return _loaded[key]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]
LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
SCHEMA = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *[(n, pa.int64()) for n in NUMBERS], ("groups_sha256", pa.string()),
                    ("words", INTS), ("times", INTS), ("pairs", LONGS), ("counts", LONGS), ("starts", INTS), ("places", INTS), ("links", INTS)])
DDL = ("block long, doc_id long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string, words array<int>, times array<int>, "
       "pairs array<long>, counts array<long>, starts array<int>, places array<int>, links array<int>")


def _lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def block_rows(tok: Tokenizers, block: int, ids: list[pa.Array], texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """A row per text and one with the id pairs of the block: ``words`` and ``times`` number a text's
    pieces; row p of the CSR matrix (``starts``, ``places``, ``links``) holds the links of piece p by
    place in ``pairs``, ``counts`` are the pairs' links in all texts."""
    sizes, cut = [], []
    for part in texts:
        flat: list[str] = []
        for text in part.to_pylist():
            own = tok.split(text) if text else []
            sizes.append(len(own))
            flat += own
        cut.append(pa.array(flat, pa.large_string()))
    coded = pa.concat_arrays(cut).dictionary_encode()
    del cut
    word = coded.indices.to_numpy().astype(np.int64)
    found = tok.align_all(coded.dictionary.to_pylist())
    del coded
    starts, n = ends(np.array(sizes, np.int64)), len(sizes)
    of = np.repeat(np.arange(n), sizes)
    fine = (np.bincount(of[~found.fine[word]], minlength=n) == 0) & (np.diff(starts) > 0)
    kept = fine[of]
    key, times = np.unique(of[kept] * len(found.fine) + word[kept], return_counts=True)
    of_word, words = np.divmod(key, max(1, len(found.fine)))
    held = ends(np.bincount(of_word, minlength=n))
    numbers = np.stack([row_sums(held, found.numbers[words, c] * times) for c in range(len(NUMBERS))], axis=1)
    groups = found.groups
    order = word.tolist()
    digests = [hashlib.sha256(b";".join([groups[w] for w in order[starts[i]:starts[i + 1]]])).hexdigest() if fine[i] else "" for i in range(n)]
    empty = [pa.nulls(n, SCHEMA.field(c).type) for c in SCHEMA.names[-5:]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block), pa.int64()), pa.concat_arrays(ids), *[pa.array(numbers[:, c], pa.int64()) for c in range(len(NUMBERS))],
         pa.array(digests, pa.string()), _lists(held, words, pa.int32()), _lists(held, times, pa.int32()), *empty], schema=SCHEMA)
    used = np.bincount(words, weights=times, minlength=len(found.fine)).astype(np.int64)
    counts = np.zeros(len(found.pairs), np.int64)
    np.add.at(counts, found.links.indices, found.links.data * used[found.links.rows])
    one = lambda x, kind: _lists(np.array([0, len(x)]), x, kind)
    rest = [pa.nulls(1, t) for t in SCHEMA.types[1:-5]]
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), *rest, one(found.pairs, pa.int64()), one(counts, pa.int64()), one(found.links.indptr, pa.int32()),
         one(found.links.indices, pa.int32()), one(found.links.data, pa.int32())], schema=SCHEMA)


def encode(a: bytes, b: bytes):
    """The map of doc_id and text to ``block_rows``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(a, b)
        block, size, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, 64)
                ids.append(part.column(0))
                texts.append(part.column(1))
                size += part.column(1).nbytes
                at += 64
                if size >= BLOCK:
                    yield from block_rows(tok, block, ids, texts)
                    block, size, ids, texts = block + 1, 0, [], []
        if ids:
            yield from block_rows(tok, block, ids, texts)

    return work


RESULT = ["doc_id", *NUMBERS, "groups_sha256", "n_best", "count_sum"]


def finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of a block with the corpus-wide counts of its id pairs."""
    left = left.combine_chunks()
    summary = left.filter(pc.is_valid(left["pairs"]))
    docs = left.filter(pc.is_null(left["pairs"])).combine_chunks()
    pairs, starts, places, links = (summary[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("pairs", "starts", "places", "links"))
    place = np.searchsorted(pairs, right["pair"].to_numpy())
    best, total = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    best[place], total[place] = right["best"].to_numpy(), right["total"].to_numpy()
    words, times = (docs[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("words", "times"))
    cut = ends(np.array([len(x) for x in docs["words"]], np.int64)) if len(docs) else np.zeros(1, np.int64)
    out = [row_sums(cut, row_sums(starts, links * of[places])[words] * times) for of in (best, total)]
    return (docs.select(RESULT[:-2]).append_column("n_best", pa.array(out[0], pa.int64()))
            .append_column("count_sum", pa.array(out[1], pa.int64())))


def align_documents(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Tokens, groups and links of every text (doc_id, text) and the counts of its links."""
    spark = docs.sparkSession
    a, b = (bytes(spark.read.format("binaryFile").load(f"{tokenizers}/{f}").select("content").first()[0]) for f in (FILE_A, FILE_B))
    vocabulary_b = len(load(a, b).bytes_b)
    rows = landed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode(a, b), DDL), "alignment")
    held = rows.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "block", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n")).where("n > 0")
    totals = held.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("id_b", F.col("pair") % vocabulary_b)
    most = totals.groupBy("id_b").agg(F.max("total").alias("most"))
    judged = totals.join(most, "id_b").select("pair", "total", (F.col("total") == F.col("most")).cast("int").alias("best"))
    known = held.select("block", "pair").join(judged, "pair").toDF("pair", "block", "total", "best")
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        finish, "doc_id long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string, n_best long, count_sum long")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenizers over all documents."""
    return align_documents(table(spark, sf_dir, "documents"))
