"""Windows of benchmark items in documents."""

import random

import pytest

from cartloom.llm.decontaminate import OP6_SQL, contamination, op6_decontamination
from tests.conftest import SF001
from tests.llm import brute
from tools.oracle_check import digest, duck

DOCS, ITEMS = "doc_id long, text string, n long, item_id int", "item_id long, text string, doc_id string"


def fixture():
    rng = random.Random(1)
    word = lambda: rng.choice(["The", "of", "é", "É", "a1", "B", "日本", "x-y", "don't"])
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(1, text(30)), (2, text(12)), (3, "one two"), (4, "Zebra"), (5, ""), (6, None), (7, text(10)),
             (10, "zebra"), (8, "the the the the the the the the the the the"), (None, "null item words here"), (1, text(15)),
             (9, " ".join(str(i) for i in range(40)))]
    docs = [(0, None), (1, ""), (2, "..."), (3, "one, TWO! three"), (4, "a zebra"), (5, "the " * 50),
            (6, "Ein null item words here!"), (7, items[0][1]), (7, items[0][1]), (7, "other text"), (None, items[1][1]),
            (8, " ".join(str(i) for i in range(20_000))), (9, " ".join(str(i) for i in range(9))),
            (10, "ONE\nTWO " * 10)]
    for i in range(20, 60):
        s = items[rng.choice([0, 1, 6, 10])][1].split(" ")
        a = rng.randrange(len(s))
        docs.append((i, text(rng.randrange(30)) + " " + " ".join(s[a:a + rng.randrange(5, 25)]).swapcase().replace("é", "É").replace("É", "é")
                     + "; " + text(rng.randrange(20))))
    return docs, items


@pytest.mark.parametrize("window", [10, 2])
def test_equals_brute_force(spark, window):
    docs, items = fixture()
    df = spark.createDataFrame([(i, t, 9, 1) for i, t in docs], DOCS).repartition(3)
    it = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = sorted(map(tuple, contamination(df, it, window=window).collect()), key=str)
    assert got == brute.op6(docs, items, window)


def test_no_rows(spark):
    docs, items = fixture()
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a zebra", 1, 1)], DOCS)
    it = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    assert contamination(none, it).collect() == []
    (row,) = contamination(some, spark.createDataFrame([], ITEMS)).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


def test_query_equals_sql(spark):
    df = op6_decontamination(spark, SF001)
    cur = duck(SF001).execute(OP6_SQL)
    rows = cur.fetchall()
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([c[0] for c in cur.description], rows)[0]
