"""Alignment against a plain version that encodes texts whole and compares all token pairs."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from cartloom.llm import token_alignment as T
from tests.conftest import SF001

ODD = [(1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "a\n b\t c\r\n"), (6, "▁ piece"), (7, "<|endoftext|> <s> </s> <0x41> <unk>"),
       (8, "naïve Öl größe ñandú 中文 字 😀 é"), (8, "The thing. The thing!"), (None, "The thing. The thing!"), (9, "x" * 3000),
       (10, "don't 's 'S we'll  nbsp 　wide  line"), (11, "é ﬁ Ａ ½"), (12, "\x00nul \x1f unit"), (13, "12 ab 3 4x c, d - e (f) g"),
       (14, "word " * 5000), (15, "  \n  indent\n    more"), (16, "ÿa Þb ×c ÷d"), (17, "trailing \n"), (18, "a İ b ſ K")]


@pytest.fixture(scope="module")
def tok():
    return T.load(*(open(f"{T.TOKENIZERS}/{f}", "rb").read() for f in (T.FILE_A, T.FILE_B)))


def brute(tok, docs):
    whole, corpus = [], Counter()
    for i, text in docs:
        entry = None
        if text:
            a = tok.a.encode(" " + text, add_special_tokens=False).ids
            b = tok.b.encode(text)
            raw = (" " + text).encode()
            if b"".join(tok.bytes_a[x] for x in a) == raw == b"".join(tok.bytes_b[x] for x in b):
                ends = [np.cumsum([len(t[x]) for x in ids]).tolist() for ids, t in ((a, tok.bytes_a), (b, tok.bytes_b))]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                links, n = [], 0
                for k, e in enumerate(ends[0]):
                    s = ends[0][k - 1] if k else 0
                    while n < len(b) and ends[1][n] <= s:
                        n += 1
                    m = n
                    while m < len(b) and (ends[1][m - 1] if m else 0) < e:
                        links.append((a[k], b[m]))
                        m += 1
                parts, at = [], [0, 0]
                for c in cuts:
                    own = []
                    for side, ids in ((0, a), (1, b)):
                        stop = ends[side].index(c, at[side]) + 1
                        own.append(ids[at[side]:stop])
                        at[side] = stop
                    parts.append(own)
                entry = (len(a), len(b), len(parts), links, sum(len(x) * len(y) for x, y in parts),
                         ";".join("|".join(",".join(map(str, x)) for x in p) for p in parts))
                corpus.update(links)
        whole.append((i, entry))
    most = Counter()
    for (_, b), n in corpus.items():
        most[b] = max(most[b], n)
    out = []
    for i, e in whole:
        if e is None:
            out.append((i, 0, 0, 0, 0, 0, "", 0, 0))
        else:
            links = e[3]
            out.append((i, *e[:3], len(links), e[4], hashlib.sha256(e[5].encode()).hexdigest(),
                        sum(corpus[x] == most[x[1]] for x in links), sum(corpus[x] for x in links)))
    return sorted(out, key=str)


def test_documents_equal_brute_force(spark, tok, monkeypatch):
    assert tok.apart
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    docs = ODD + [tuple(r) for r in rows]
    schema = "doc_id long, text string, block int, pairs string, n_a int"
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], schema).repartition(3)
    monkeypatch.setattr(T, "BLOCK", 50_000)
    got = sorted((tuple(r) for r in T.align_documents(df).collect()), key=str)
    assert got == brute(tok, docs)
    assert T.align_documents(df.limit(0)).collect() == []


def test_a_whole_text_equals_its_pieces(spark, tok, monkeypatch):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("text").limit(40).collect()
    def links_of(found, tok):
        return Counter(dict(zip(found.pairs.tolist(), np.bincount(found.links.indices, found.links.data, len(found.pairs)).astype(int).tolist(), strict=True)))

    for text in [t for _, t in ODD if t] + [r["text"] for r in rows]:
        whole, parts = tok.align([text]), tok.align(tok.split(text))
        assert whole.fine[0] == parts.fine.all()
        if whole.fine[0]:
            assert (whole.numbers[0] == parts.numbers.sum(axis=0)).all()
            assert whole.groups[0] == b";".join(parts.groups)
            assert links_of(whole, tok) == links_of(parts, tok)
        monkeypatch.setattr(T, "AT_ONCE", 5)
        again = tok.align_all(tok.split(text))
        assert again.groups == parts.groups and (again.numbers == parts.numbers).all() and links_of(again, tok) == links_of(parts, tok)


def test_pieces_and_whole_texts_have_the_same_tokens(tok):
    for _, text in ODD:
        if text:
            pieces = tok.split(text)
            assert " ".join(pieces) == text
            assert tok.a.encode(" " + text, add_special_tokens=False).ids == [
                i for p in pieces for i in tok.a.encode(" " + p, add_special_tokens=False).ids]
            assert tok.b.encode(text) == [i for p in pieces for i in tok.b.encode(p)]
    assert len(tok.split("a b c d")) == 4 and len(tok.split("a  b\n c")) == 1


def test_row_products_equal_dense_ones():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = rng.integers(0, 3, (5, 7)) * (rng.random((5, 7)) < 0.4), rng.integers(0, 3, (7, 4)) * (rng.random((7, 4)) < 0.4)
        def sparse(m):
            r, c = np.nonzero(m)
            return T.Csr(T.ends(np.bincount(r, minlength=len(m))), c, m[r, c].astype(np.int64), m.shape[1])
        p = T.product(sparse(x), sparse(y))
        dense = np.zeros((5, 4), int)
        dense[p.rows, p.indices] = p.data
        assert (dense == x @ y).all()
        t = T.transposed(sparse(x))
        dense = np.zeros((7, 5), int)
        dense[t.rows, t.indices] = t.data
        assert (dense == x.T).all()


def test_links_and_shared_groups_of_a_small_case(monkeypatch):
    found = T.Alignment(np.array([2, 3, 1, 2]), np.array([1, 4, 3]))
    assert list(zip(found.links.rows, found.links.indices, found.links.data)) == [
        (0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 2, 2)]
    assert found.cuts.tolist() == [5, 8] and found.shared().tolist() == [2, 2, 1, 1]
    want = [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 2)]
    for part in (1, 3, 100):
        monkeypatch.setattr(T, "PART", part)
        assert [x for a, b in found.shared_links() for x in zip(a.tolist(), b.tolist(), strict=True)] == want
