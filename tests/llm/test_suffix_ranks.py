"""Prefix doubling against brute force."""

from cartloom.llm.suffix_ranks import dedup_bytes
from tests.llm import brute
from tests.llm.test_repeats import SCHEMA, corpus


def test_doubling_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in dedup_bytes(df).collect()), key=str) == brute.op9(rows)


def test_no_rows(spark):
    assert dedup_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
