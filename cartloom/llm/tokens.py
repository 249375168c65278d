"""Vectorised words and hashes of texts for numpy code inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes handled at once; power tables and temporary arrays have this length (a single longer
#: word makes them grow).
BLOCK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
#: One random 64-bit value per byte.
_BYTE = np.random.default_rng(20240101).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of plain words: ASCII without digits and letters.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def powers(name: str, n: int) -> np.ndarray:
    """The first ``n`` powers (mod 2^64) of the base ("up") or of its inverse ("down")."""
    found = _POWERS.get(name)
    if found is None or len(found) < n:
        step = np.full(max(n, BLOCK_BYTES + 1), _BASE if name == "up" else _INVERSE, np.uint64)
        step[0] = 1
        found = _POWERS[name] = np.multiply.accumulate(step)
    return found[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(buf: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without a separator."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = ~separators[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span's bytes (equal bytes, equal hash); spans in order."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, at + BLOCK_BYTES, "right")))
        to = int(ends[j - 1])
        total = np.zeros(to - at + 1, np.uint64)
        np.cumsum(_BYTE[buf[at:to]] * powers("up", to - at), out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (total[e] - total[s]) * powers("down", to - at)[s]
        out[i:j] += (e - s).astype(np.uint64)
        i = j
    return mix64(out)


def slide(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values; shorter input gives none."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out *= np.uint64(_BASE)
        out += hashes[k:k + m]
    return mix64(out)


def groups(texts: Iterable[str | None], limit: int = 2 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive texts as UTF-8 (null: empty), in groups of about ``limit`` bytes:
    (first, end, bytes). One text may be longer than the limit."""
    held: list[bytes] = []
    size = first = 0
    i = -1
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        held.append(raw)
        size += len(raw)
        if size >= limit:
            yield first, i + 1, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, i + 1, held


class Words:
    """Word hashes of a group of texts: ``hashes`` of all words in order, ``of[d]:of[d + 1]``
    those of text ``d``."""

    def __init__(self, raws: list[bytes], separators: np.ndarray):
        buf = np.frombuffer(b" ".join(raws), np.uint8)
        lengths = np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws))
        self.at = np.concatenate(([0], np.cumsum(lengths)))  # of each text's first byte
        self.buf = buf
        self.starts, self.ends = spans(buf, separators)
        self.hashes = span_hashes(buf, self.starts, self.ends)
        self.of = np.searchsorted(self.starts, self.at)
