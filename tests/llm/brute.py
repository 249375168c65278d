"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re


def words_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def words_plain(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def spans(gone):
    return sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))


def dedup(docs, units, width):
    """{row: (n, removed, spans, kept units)} of (id, sequence) rows; null ids take no part."""
    first = {}
    for i, seq in docs:
        if i is not None:
            for s in range(len(seq) - width + 1):
                k = tuple(seq[s:s + width])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, seq in docs:
        gone = [False] * len(seq)
        if i is not None:
            for s in range(len(seq) - width + 1):
                if first[tuple(seq[s:s + width])] < i:
                    gone[s:s + width] = [True] * width
        out.append((i, len(seq), sum(gone), spans(gone), [u for u, g in zip(seq, gone) if not g]))
    return out


def op9(docs):
    return sorted(((i, n, r, s, hashlib.sha256(bytes(k)).hexdigest())
                   for i, n, r, s, k in dedup([(i, (t or "").encode()) for i, t in docs], bytes, 50)), key=str)


def op10(docs):
    return sorted(((i, n, r, s, hashlib.sha256(" ".join(k).encode()).hexdigest())
                   for i, n, r, s, k in dedup([(i, words_space(t)) for i, t in docs], str, 13)), key=str)


def op6(docs, items, window=10):
    cut = {}
    for item, text in items:
        w = words_plain(text)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            cut.setdefault(tuple(w[s:s + window]), set()).add(item)
    sizes = {len(k) for k in cut}
    out = []
    for i, text in docs:
        w = words_plain(text)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                items_here = cut.get(tuple(w[s:s + n]))
                if items_here is not None:
                    hit[s:s + n] = [True] * n
                    found |= {str(x) for x in items_here if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), sum(hit), len(found), digest, any(hit)))
    return sorted(out, key=str)


def shingles(text, size=5):
    w = words_space(text)
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def classes(docs, threshold=0.8):
    """{id: least id of its class}; ids must be distinct."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}
