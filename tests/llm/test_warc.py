"""Archive round trips."""

import hashlib

import duckdb
import pandas as pd
import pytest

from cartloom.llm.warc import OP3_SQL, op3_warc, read_archive, reconstruct, write_archive
from cartloom.session import scratch_path

BIG, OTHER = "é" * 700, "y" * 1000


@pytest.fixture(scope="module")
def rows():
    return [(1, "http://a", BIG, "z"), (2, "http://b\r\nX: 1%0D", BIG, "z"), (5, None, BIG, "z"), (4, "u", OTHER, "z"),
            (6, "u", OTHER, "z"), (7, "s", "small", "z"), (8, "s", "small", "z"), (9, "n", None, "z"),
            (10, "n", "", "z"), (11, "l", "long " * 200_000, "z"), (12, "x", "y" * 999, "z"), (13, "x", "y" * 999, "z")]


def test_query_equals_sql(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, content string").repartition(3)
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, op3_warc(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html", "c"]))
    assert got == sorted(con.execute(OP3_SQL).fetchall())
    assert {r[0]: (r[3], r[4]) for r in got}[1] == ("revisit", 5)


def test_records_are_rebuilt_exactly(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, content string")
    path = write_archive(df, scratch_path(spark, "test"))
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert len(stored) == len({r[2] or "" for r in rows})  # every payload once
    got = {r["record"]: r for r in reconstruct(spark, path).collect()}
    for i, _, html, _ in rows:
        assert got[i]["payload"].decode() == (html or "")
        head, _, block = bytes(got[i]["bytes"]).partition(b"\r\n\r\n")
        assert f"sha1:{hashlib.sha1((html or '').encode()).hexdigest()}".encode() in head
        assert block == (b"" if b"Type: revisit" in head else (html or "").encode()) + b"\r\n\r\n"


def test_changed_payload_is_found(spark, rows):
    df = spark.createDataFrame(rows[:2], "page_id long, url string, html string, content string")
    path = write_archive(df, scratch_path(spark, "test"))
    (spark.createDataFrame([(r["content"], b"changed") for r in spark.read.parquet(f"{path}/payloads").collect()],
                           "content string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads"))
    with pytest.raises(Exception, match="does not fit its key"):
        read_archive(spark, path).collect()


def test_repeated_null_and_no_rows(spark):
    schema = "page_id long, url string, html string"
    rows = [(3, "a", BIG)] * 3 + [(1, "a", BIG), (None, "b", BIG), (None, None, OTHER)]
    path = write_archive(spark.createDataFrame(rows, schema), scratch_path(spark, "test"))
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in read_archive(spark, path).collect()), key=str)
    assert got == sorted([(3, "response", None)] * 3 + [(1, "revisit", 3), (None, "revisit", 3),
                                                       (None, "response", None)], key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == 2
    path = write_archive(spark.createDataFrame([], schema), scratch_path(spark, "test"))
    assert read_archive(spark, path).collect() == []
