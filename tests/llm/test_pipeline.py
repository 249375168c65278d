"""The pipeline's stages against brute force, each on what its predecessor kept."""

import shutil

import pytest

import corpus_pipeline as P
from tests.conftest import SF001
from tests.llm import brute


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    shutil.copy(f"{SF001}/benchmark.parquet", f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").orderBy("item_id").limit(3).collect()]
    long = rows[1][1] + " " + " ".join(r[1] for r in rows[:12])
    rows += [(5000, None, "en", "src0", None), (5001, "", None, None, 0), (5002, "12 34 !!", "en", "src1", 8),
             (5003, rows[3][1], rows[3][2], "src9", rows[3][4]), (5004, long, "en", None, len(long)),
             (5005, rows[7][1] + "\n" + items[0], rows[7][2], "src0", 1), (5006, items[1], None, "src0", 1),
             (None, rows[9][1], rows[9][2], "src0", 1), rows[11], rows[11]]
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, items


def test_stages(spark, data):
    folder, _ = data
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        if name != "mixing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        kept[name] = sorted((tuple(r) for r in docs.collect()), key=str), spark.read.parquet(f"{folder}/{name}")
        docs = kept[name][1]
    rows = {n: (before, sorted((tuple(r) for r in after.collect()), key=str)) for n, (before, after) in kept.items()}

    before, after = rows["language_id"]
    gone = [r for r in before if r not in after]
    assert {5000, 5001, 5002} <= {r[0] for r in gone} and len(gone) <= 6  # clean texts stay
    before, after = rows["near_duplicates"]
    classes = brute.classes({(r[0], r[1]) for r in before if r[0] is not None})
    assert after == sorted({r for r in before if r[0] is None or classes[r[0]] == r[0]}, key=str)
    assert 5003 not in {r[0] for r in after}
    before, after = rows["substring_dedup"]
    cut = brute.dedup([(r[0], brute.words_space(r[1])) for r in before], str, 13)
    texts = [" ".join(k) if n else r[1] for r, (_, _, n, _, k) in zip(before, cut)]
    assert after == sorted(((r[0], t, r[2], r[3], len(t)) for r, t in zip(before, texts)), key=str)
    assert any(n for _, _, n, _, _ in cut)
    before, after = rows["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {(r[0], r[1]) for r in before if brute.op6([(r[0], r[1])], items)[0][-1]}
    assert after == [r for r in before if (r[0], r[1]) not in dirty] and 5006 in {i for i, _ in dirty}
    before, after = rows["mixing"]
    assert sorted((r[:5] for r in after), key=str) == before
    assert sorted(r[6] for r in after) == list(range(len(before)))


def test_run_applies_all_stages(spark, data):
    folder, _ = data
    got = P.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_slot", "mix_position"]
    assert got.count() == spark.read.parquet(f"{folder}/mixing").count()


def test_empty_table(spark, data, tmp_path):
    folder, _ = data
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, none, folder)
        assert out.count() == 0 and out.columns[:5] == none.columns, name


def test_another_text_of_a_dropped_id_stays(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(1, a, "en", "s", 1), (2, a, "en", "s", 1), (2, b, "en", "s", 1), (3, b, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[2]]


def test_survivors_of_repeated_rows_are_fixed(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "es", "s2", 1), (1, text, "de", "s9", 1), (1, text, "de", "s1", 1),
            (None, text, "en", "s", 1), (None, text, "en", "s", 1), (None, None, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        got = P.near_duplicates(spark, spark.createDataFrame(order, schema).repartition(3), "")
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([rows[2], *rows[3:]], key=str)
