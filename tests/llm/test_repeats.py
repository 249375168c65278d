"""Byte and word dedup against brute force."""

import random

import pytest

from cartloom.llm import repeats
from cartloom.llm.substring_dedup import DIGEST, WordWindows, dedup_texts, digests, op10_substring_dedup
from cartloom.llm.suffix_dedup import ByteWindows, op9_suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, _id string, key int"


def corpus():
    rng = random.Random(3)
    word = lambda: rng.choice("ab é cc ddd ñu e2 f g\tx".split(" ")) + rng.choice(["", "a", "b", "ü"])
    passages = [" ".join(word() for _ in range(n)) for n in (13, 14, 30, 60)]
    rows = [(0, None), (1, ""), (2, "short text"), (3, "a" * 300), (4, "a" * 120 + "b" * 70), (5, "x " * 40),
            (6, "x " * 12), (None, passages[2]), (None, None)]
    for i in range(7, 60):
        text = " ".join(word() for _ in range(rng.randrange(1, 60)))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            text += rng.choice([" ", "\n", "\x0b"]) + p[rng.randrange(0, 9):] + rng.choice([" ", " \t"])
        rows.append((i, text))
    rows += [(60, rows[20][1]), (61, rows[20][1]), (61, rows[20][1]), (62, rows[25][1]), (62, passages[3])]
    long = " ".join(word() + str(k % 7) for k in range(90_000))
    rows += [(63, long), (64, "q" + long[200_000:520_000])]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return rows, spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [1 << 12, 1 << 23])
def test_words_equal_brute_force(docs, monkeypatch, size):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", size)
    monkeypatch.setattr(repeats, "SHARD_BYTES", size * 4)
    rows, df = docs
    got = repeats.find_repeats(df, WordWindows(), DIGEST, digests).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute.op10(rows)


def test_bytes_equal_brute_force(spark, docs, tmp_path):
    rows, df = docs
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute.op9(rows)


def test_texts_keep_columns_and_untouched_texts(docs):
    rows, df = docs
    got = sorted(((r["doc_id"], r["text"], r["_id"], r["key"]) for r in dedup_texts(df).collect()), key=str)
    cut = {}
    for (i, t), (_, _, removed, _, kept) in zip(rows, brute.dedup([(i, brute.words_space(t)) for i, t in rows], str, 13)):
        cut.setdefault(i, []).append((i, " ".join(kept) if removed else t, "clash", 1))
    assert got == sorted((x for xs in cut.values() for x in xs), key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert op9_suffix_dedup(spark, str(tmp_path)).collect() == []
    assert op10_substring_dedup(spark, str(tmp_path)).collect() == []


def test_anchors_of_equal_windows_agree():
    """Every 50-byte window holds an anchor, at the same place wherever it stands."""
    rng = random.Random(5)
    window = bytes(rng.choice(b"abc") for _ in range(50))
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) + window + b"abc" * n for n in (0, 1, 30, 77)]
    text, pos, h, _ = ByteWindows().anchors(texts)
    places = []
    for i, t in enumerate(texts):
        at = t.index(window)
        places.append({int(p) - at for k, p in zip(text, pos) if k == i and at <= p <= at + 25})
    assert set.intersection(*places)


def test_crowds_of_surroundings(spark):
    """One passage within many different neighbourhoods, in one group of texts."""
    rng = random.Random(9)
    passage = " ".join(rng.choice("abcdefgh") * 3 for _ in range(25))
    noise = lambda: " ".join(str(rng.random()) for _ in range(6))
    rows = [(i, f"{noise()} {passage} {noise()}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.find_repeats(df, ByteWindows(), DIGEST.__class__([f for f in DIGEST.fields]), digests).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute.op9(rows)
