"""Secret scan against a plain version that looks at the whole corpus at once."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cartloom.llm import secret_scan as S

KEY = "Ab3dEf6hIj9kLm2nOp5qRs8t"
HEX = "0123456789abcdef" * 2
AWS = "AKIA" + "B7" * 8

ASSIGN = r"""(?a)(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def spans(text):
    """[(start, kind, end, value)] with no regard for speed."""
    text = text or ""
    found = [(m.start(), 0, m.end(), m[2]) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    bare = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_=-]+", text)
            if len(m[0]) >= 20 and S.looks_random(m[0]) and not any(s < m.end() and m.start() < e for s, _, e, _ in found)]
    return sorted(found + bare)


def brute(docs):
    owners = {}
    for _, text, source in docs:
        for *_, v in spans(text):
            owners.setdefault(v, set()).update([] if source is None else [source.split("/")[0]])
    out = []
    for i, text, _ in docs:
        all_ = [(s, k, e, len(owners[v]) < 3) for s, k, e, v in spans(text)]
        name = lambda h: f"{S.KINDS[h[1]]}:{h[0]}:{h[2]}"
        base = [h for h in all_ if h[1] < 3]
        out.append((i, *[sum(h[1] == k for h in base) for k in range(3)],
                    hashlib.sha256(",".join(map(name, base)).encode()).hexdigest(),
                    ",".join(name(h) for h in all_ if h[1] < 3 or h[3]), sum(h[3] for h in all_), sum(not h[3] for h in base)))
    return sorted(out, key=str)


PIECES = ["password", "PassWD: ", "API_key='", "apikey =", "token", "secret", '"', "'", " ", "  ", ":", "=", "é", "ſecret=", "\n",
          "AKIA", AWS, HEX, HEX[:20], KEY, KEY + ".", "abcdefgh", "short", "=12345678", "/", "-", "_", "x", "0", "😀"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_candidates_equal_the_plain_version(pieces):
    text = "".join(pieces)
    assert S.candidates(text) == spans(text)


def test_documents_equal_brute_force(spark):
    docs = [(1, None, "a/x"), (2, "", "a/y"), (3, f"password = {KEY} and {AWS}", "a/x"), (3, f"é😀 {KEY}.", "a/z"),
            (4, f"token: abc, token=\"{HEX}\"", None), (None, f"x{HEX}y {KEY}", "b"), (5, "w " * 300_000 + HEX, "c"),
            (6, f"key {KEY[::-1]} here", "a/x"), (7, f"key {KEY[::-1]} here", "a/q"), (8, f"key {KEY[::-1]} here", "b/q")]
    docs += [(100 + i, f"see {'Zz9' + KEY} or {AWS}1 for an example", f"o{i}/r") for i in range(5)]
    docs += [(200 + i, f"secret={'Qq8' + KEY}", f"one/r{i}") for i in range(5)]
    schema = "doc_id long, text string, source string"
    df = spark.createDataFrame(docs, schema).selectExpr("*", "'k' AS key", "1 AS hits", "0 AS live")
    got = sorted((tuple(r) for r in S.scan_documents(df).collect()), key=str)
    assert got == brute(docs)
    of = {r[0]: r for r in got}
    # Of five owners: a copied example, not added; base spans stay. Of one owner in five repositories: live.
    assert of[100][5] == f"access:{of[100][5].split(':')[1]}:{of[100][5].split(':')[2]}" and of[100][7] == 1
    assert of[200][6] == 1 and of[200][7] == 0
    assert of[6][5].startswith("bare:") and of[5][3] == 1
    assert S.scan_documents(df.limit(0)).collect() == []


def test_ownership_counts_repositories_and_owners(spark):
    docs = [(i, f"secret={KEY}", f"o{i % 2}/r{i % 3}") for i in range(12)] + [(90, f"token={KEY}", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = S.find_candidates(df, df["source"], S.source_owner())
    assert [tuple(r)[1:] for r in S.ownership(found).collect()] == [(6, 2, 13)]
    # The copied-example bound is a parameter.
    assert {r["live"] for r in S.judged(found, copied=2).collect()} == {False}
