"""Classes of near copies against brute force."""

import os
import random

import numpy as np

from cartloom.llm import ngram_join
from cartloom.llm.ngram_join import Hasher, banding, components, jaccard_classes
from cartloom.session import local_path
from tests.llm import brute

SCHEMA = "doc_id long, text string, sid string, label int"


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("qrstuvwxyz") + rng.choice("0123456789")
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((i, rng.choice([" ", "\n"]).join(copy)))
            i += 1
    big = [word() for _ in range(150)]
    for _ in range(60):  # a large group of near copies
        copy = list(big)
        copy[rng.randrange(150)] = word()
        rows.append((i, " ".join(copy)))
        i += 1
    rows += [(i, "a b c"), (i + 1, "a b c"), (i + 2, "a b"), (i + 3, "w" * 100_000), (i + 4, "w" * 100_000),
             (i + 5, rows[0][1]), (i + 6, " ".join(word() for _ in range(30_000)))]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    extra = [(900, None), (901, ""), (902, " \t")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows + extra + rows[:3] + [(None, rows[0][1])]], SCHEMA)
    got = jaccard_classes(df.repartition(3)).collect()
    assert len(got) == len(rows) + len(extra) + 4
    want = brute.classes(rows + extra)
    assert {(r["doc_id"], r["class_id"]) for r in got} == set(want.items()) | {(None, None)}
    links = {r["doc_id"]: r for r in got}
    sets = {i: brute.shingles(t) for i, t in rows}
    for i, c in want.items():
        others = {j for j in want if want[j] == c and j != i}
        assert (links[i]["n_links"] + links[i]["n_copies"] > 0) == bool(others)
        assert links[i]["n_copies"] == sum(sets.get(j) == sets.get(i) for j in others)


def test_no_rows(spark):
    assert jaccard_classes(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = jaccard_classes(spark.createDataFrame([(5, "alone in the world", "x", 1)], SCHEMA)).collect()
    assert tuple(row) == (5, 5, 0, 0)


def test_banding_reaches_its_recall():
    for threshold in (0.6, 0.8, 0.9):
        bands, rows = banding(threshold, 0.99, 256)
        assert bands * rows <= 256 and 1 - (1 - threshold ** rows) ** bands >= 0.99
    bands, rows = banding(0.02, 0.999, 128)  # more than 128 hashes are needed
    assert rows == 1 and 1 - (1 - 0.02) ** bands >= 0.999


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {j: 100 for j in range(100, 140)} | {200: 200, 201: 200}
    assert got == want


def test_links_are_all_links_of_a_set(spark, monkeypatch):
    """Also those between different texts of one class, over several blocks of a class."""
    monkeypatch.setattr(ngram_join, "LINK_BLOCK", 16)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    sets = {i: brute.shingles(t) for i, t in rows}
    different = set(sets.values())
    want = {i: sum(len(a & b) / len(a | b) >= 0.8 for b in different if b != a) for i, a in sets.items()}
    assert {r["doc_id"]: r["n_links"] for r in jaccard_classes(df).collect()} == want
    assert max(want.values()) >= 55


def test_documents_without_company_are_kept_as_band_hashes_alone(spark, monkeypatch):
    """Signatures and full sets of sets that share no bucket are neither written nor moved."""
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(12))) for i in range(2000)]
    rows += [(2000, rows[0][1] + " x"), (2001, rows[1][1])]
    sizes, counts = {}, {}
    write = ngram_join.landed

    def landed(df, name):
        out = write(df, name)
        sizes[name] = sum(os.path.getsize(local_path(f)) for f in out.inputFiles())
        counts[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "landed", landed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in jaccard_classes(df).collect()}
    assert got == {i: i for i, _ in rows} | {2000: 0, 2001: 1}
    assert counts["join-full-sets"] < 20
    for name in ("join-signatures", "join-sets"):  # 18 band hashes of 8 bytes, and the digest
        assert sizes[name] < 300 * len(rows), name


def test_band_keys_are_of_the_first_values_of_the_signature():
    hasher = Hasher(*banding())
    values = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 9000).astype(np.uint64))
    whole = hasher.least(values, len(hasher.mul))
    part = hasher.least(values, hasher.bands * hasher.rows)
    assert (whole[:len(part)] == part).all() and len(hasher.signature(values)) == ngram_join.HASHES
    assert len(hasher.keys(values)) == hasher.bands
