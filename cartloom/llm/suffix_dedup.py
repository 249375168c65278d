"""Exact byte-substring dedup by winnowed anchors and window hashes.

Texts are UTF-8 bytes. Every byte covered by a ``WIDTH``-byte string that also starts in a
document with a smaller id is removed.

This replaces distributed prefix doubling: no position is ranked from the ranks of two halves,
and lengths do not double. Strings are found by their hashes in three rounds:

* length 25: suffixes are grouped by their first 25 bytes. A 50-byte string holds 26 such
  prefixes; it is enough to follow the one with the smallest hash, which is the same one
  wherever the string occurs, so only these positions take part (about 2 of 27).
* length 75: positions that still share their rank are ranked with the 25 bytes before and
  after them. Where this longer string has a copy in a smaller document, all its windows have,
  and the position is settled.
* length 50: at the positions that are neither unique nor settled, where repeats begin and
  end, the single 50-byte windows are ranked.

"Ranks" are hashes that Spark brings together bucket by bucket, where they are sorted;
the rounds are described in ``repeats``. Prefix doubling over every byte position is in
``suffix_ranks``, with the same results; README gives its measured figures.

Edge cases: null is the empty text; texts shorter than the width keep all; rows with a null id
are neither removed from nor a source; rows that share an id are not each other's source;
repeated rows are cut alike. Texts are used whole (long ones in pieces that overlap); an empty
table gives an empty result. Strings are equal by hashes of at least 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartloom.llm.common import table
from cartloom.llm.repeats import Rule, find_repeats
from cartloom.llm.substring_dedup import digests
from cartloom.llm.tokens import _BYTE, mix64, powers

WIDTH = 50
#: Bytes handled at once, and bytes around a piece of a long text that its anchors may need.
PIECE = 1 << 18
MARGIN = 64


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * powers("up", len(buf)), out=total[1:])
    return total


def _slide(x: np.ndarray, n: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of every ``n`` consecutive values."""
    size = 1
    while size * 2 <= n:
        x = take(x[:-size], x[size:])
        size *= 2
    return take(x[:len(x) - (n - size)], x[n - size:]) if n > size else x


class ByteWindows(Rule):
    """Windows of ``width`` bytes; anchors are the least-hashed half-width grams."""

    surroundings = True

    def __init__(self, width: int = WIDTH):
        self.width, self.half = width, width // 2
        self.choices = width - self.half + 1  # grams within a window
        if not 2 <= width <= MARGIN:
            raise ValueError(f"width must be 2 to {MARGIN}")

    def _pieces(self, raws):
        """Groups of about ``PIECE`` bytes of (text, offset of the slice, slice, first and end
        window start); every window belongs to one piece."""
        held, size = [], 0
        for i, raw in enumerate(raws):
            last = len(raw) - self.width + 1
            for s0 in range(0, max(0, last), PIECE):
                s1 = min(last, s0 + PIECE)
                lo = max(0, s0 - MARGIN)
                cut = raw[lo:s1 + self.width - 1 + MARGIN]
                held.append((i, lo, cut, s0 - lo, s1 - lo))
                size += len(cut)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def anchors(self, raws):
        found = [self._anchors(p) for p in self._pieces(raws)]
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none.astype(np.uint64), none.astype(np.uint64)
        text, pos, h, u = (np.concatenate(c) for c in zip(*found, strict=True))
        # Neighbouring pieces of a text may find the same anchor.
        order = np.lexsort((pos, text))
        text, pos, h, u = text[order], pos[order], h[order], u[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (pos[1:] != pos[:-1])
        return text[new], pos[new], h[new], u[new]

    def _anchors(self, pieces):
        buf = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        base = np.cumsum([0] + [len(p[2]) for p in pieces])
        total = prefix_sums(buf)
        down = powers("down", len(buf) + 1)
        k, w = self.half, self.choices
        gram = mix64((total[k:] - total[:-k]) * down[:len(total) - k]) | np.uint64(1)
        least = _slide(gram, w, np.minimum)
        valid = np.zeros(len(least), bool)
        for b, (_, _, _, s0, s1) in zip(base, pieces, strict=False):
            valid[b + s0:b + s1] = True
        least[~valid] = 0
        # A gram is chosen if it is the least of some window: the largest of the least values
        # of the windows that hold it.
        pad = np.zeros(w - 1, np.uint64)
        at = np.flatnonzero(_slide(np.concatenate((pad, least, pad)), w, np.maximum) == gram)
        piece = np.searchsorted(base, at, "right") - 1
        lo = np.maximum(base[piece], at - (w - 1))
        hi = np.minimum(base[piece + 1], at + self.width)
        around = (total[hi] - total[lo]) * down[lo]
        u = mix64(around + (at - lo).astype(np.uint64) * np.uint64(0x100000001B3)
                  + (hi - at).astype(np.uint64) * np.uint64(0x1000193))
        text = np.array([p[0] for p in pieces])[piece]
        pos = at - base[piece] + np.array([p[1] for p in pieces])[piece]
        return text, pos, gram[at], u

    def windows(self, raws, text, pos):
        buf = np.frombuffer(b"".join(raws), np.uint8)
        n = np.array([len(r) for r in raws], np.int64)
        base = np.concatenate(([0], np.cumsum(n)))
        start = np.zeros(len(buf), bool)
        for shift in range(self.choices):
            s = pos - shift
            fits = (s >= 0) & (s + self.width <= n[text])
            start[base[text[fits]] + s[fits]] = True
        at = np.flatnonzero(start)
        h = np.empty(len(at), np.uint64)
        for a in range(0, len(buf), PIECE):
            i, j = np.searchsorted(at, (a, a + PIECE))
            if i < j:
                total = prefix_sums(buf[a:a + PIECE + self.width])
                s = at[i:j] - a
                h[i:j] = mix64((total[s + self.width] - total[s]) * powers("down", PIECE)[s])
        of = np.searchsorted(base, at, "right") - 1
        return of, at - base[of], h

    def cut(self, raw, covered, windows):
        n = len(raw)
        lo = np.maximum(0, covered - (self.choices - 1))
        hi = np.minimum(n, covered + self.width)
        use = hi - lo >= self.width  # the surroundings hold a window
        lo, hi = np.concatenate((lo[use], windows)), np.concatenate((hi[use], windows + self.width))
        if not len(lo):
            return n, 0, 0, raw
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, lo, 1)
        np.add.at(change, hi, -1)
        gone = np.cumsum(change[:-1]) > 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        return n, int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), kept


DIGEST = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                       T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                       T.StructField("kept_sha256", T.StringType())])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: counts and the digest of the kept bytes."""

    def finish(rows: pa.Table, results: list[tuple]) -> pa.Table:
        return digests(rows, results, "n_bytes")

    return find_repeats(table(spark, sf_dir, "documents"), ByteWindows(), DIGEST, finish)
