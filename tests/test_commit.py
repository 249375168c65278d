"""Publishing as one commit with retraction, completeness per request, metadata manifest."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.plans import pipelines as P
from cartloom.sinks import publish as S
from cartloom.sources.envelope import (documents, latest_pages, read_order_envelopes, read_probe_totals,
                                       request_audit)
from tests import golden

D, NEXT = dt.date(2024, 3, 10), dt.date(2024, 3, 11)
VERDICT = "run_date date, passed boolean"
TOTAL = "run_date date, total_records long"
ROWS = "run_date date, no string"


def publish(spark, base, rows, passed, fail_after=None):
    """One run: ``rows`` maps a table to (day, no) rows, ``passed`` a day to its verdict."""
    verdicts = spark.createDataFrame(list(passed.items()), VERDICT)
    totals = spark.createDataFrame([(d, sum(r[0] == d for t in rows.values() for r in t)) for d in passed], TOTAL)
    version = S.new_version()
    tables = {t: spark.createDataFrame(r, ROWS) for t, r in rows.items()}
    for n, (table, df) in enumerate(tables.items()):
        if n == fail_after:
            raise InterruptedError
        S.publish_days({table: df}, verdicts, base, version=version)
    S.commit_days(totals, verdicts, base, "orders", version, list(passed), list(tables))
    return version


def visible(spark, base, table):
    got = S.read_published(spark, base, table, T.StructType([T.StructField("no", T.StringType())]), "orders")
    return sorted((r["run_date"], r["no"]) for r in got.collect())


def markers(spark, base):
    return sorted((r["run_date"], r["total"], r["state"], r["seq"]) for r in S.current_markers(spark, base).collect())


def test_a_day_is_visible_by_its_last_commit(spark, tmp_path):
    base = str(tmp_path)
    assert S.current_markers(spark, base).collect() == [] and visible(spark, base, "orders") == []
    first = publish(spark, base, {"orders": [(D, "1"), (D, "2"), (NEXT, "9")], "items": [(D, "a")]}, {D: True, NEXT: True})
    assert visible(spark, base, "orders") == [(D, "1"), (D, "2"), (NEXT, "9")] and visible(spark, base, "items") == [(D, "a")]
    assert markers(spark, base) == [(D, 3, "published", 1), (NEXT, 1, "published", 1)]
    # Killed between two tables: the old day stays whole.
    with pytest.raises(InterruptedError):
        publish(spark, base, {"orders": [(D, "3")], "items": [(D, "b")]}, {D: True}, fail_after=1)
    assert visible(spark, base, "orders") == [(D, "1"), (D, "2"), (NEXT, "9")] and visible(spark, base, "items") == [(D, "a")]
    # A re-run without rows of one table leaves none of its old ones.
    second = publish(spark, base, {"orders": [(D, "4")], "items": []}, {D: True})
    assert visible(spark, base, "orders") == [(D, "4"), (NEXT, "9")] and visible(spark, base, "items") == []
    assert {r["version"] for r in S.published_files(spark, base, "orders").collect()} == {first, second}
    expired = {(r["run_date"], r["version"]) for r in S.expired_files(spark, base, "orders", "orders").collect()}
    assert (D, first) in expired and (NEXT, first) not in expired and len(expired) == 2
    # A re-run that fails: no rows, no marker, of this day alone.
    publish(spark, base, {"orders": [(D, "5")], "items": [(D, "c")]}, {D: False})
    assert visible(spark, base, "orders") == [(NEXT, "9")] and markers(spark, base) == [(NEXT, 1, "published", 1)]
    # It passes again; a day without records is marked empty.
    publish(spark, base, {"orders": [(D, "6")], "items": []}, {D: True, NEXT: True})
    assert visible(spark, base, "orders") == [(D, "6")]
    assert markers(spark, base) == [(D, 1, "published", 4), (NEXT, 0, "empty", 2)]


def test_an_order_run_that_fails_later_shows_nothing(spark, tmp_path):
    docs = [d for d in golden.order_documents() if d["order_no"] in ("1", "2")]
    found = documents(read_order_envelopes(spark, golden.write_envelopes(str(tmp_path / "landing"), docs)))
    out, source = str(tmp_path / "out"), P.source_totals_of(found)
    good = P.run_orders(found, source, out, run_dates=[D])
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in good.tables["orders"].drop("run_date").schema.fields])
    assert S.read_published(spark, out, "orders", schema).count() == 2
    bad = P.run_orders(found, source.withColumn("total_created", F.lit(99).cast("long")), out, run_dates=[D])
    assert [r["passed"] for r in bad.verdicts.collect()] == [False]
    assert S.read_published(spark, out, "orders", schema).count() == 0
    assert S.current_markers(spark, out).count() == 0
    assert S.read_published(spark, out, "payments", schema.__class__(), "orders").count() == 0


def test_manifest_reads_no_content(spark, tmp_path):
    (tmp_path / "run_date=2024-03-10").mkdir()
    (tmp_path / "run_date=2024-03-10" / "a.csv").write_text("x\n" * 100)
    (tmp_path / "run_date=2024-03-10" / "empty.csv").write_text("")
    (tmp_path / "b.txt").write_text("no")
    files = S.manifest(spark, str(tmp_path))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert sorted((r["file_name"], r["n_bytes"], r["run_date"], r["version"]) for r in files.collect()) == [
        ("a.csv", 200, D, None)]  # the scan leaves out files without a byte


def land(folder, name, start, total, hits, slice_=None, field="creation_date"):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    body = {"total": total, "count": len(hits), "start": start, "hits": [{"data": {"order_no": h}} for h in hits]}
    if slice_:
        body["query"] = {"filtered_query": {"filter": {"range_filter": {
            "field": field, "from": f"2024-03-10T{slice_}:00.000Z", "to": f"2024-03-10T{slice_}:59.000Z"}}}}
    with open(path, "w") as out:
        json.dump(body, out)


def later(folder, name, seconds):
    stamp = time.time() + seconds
    os.utime(os.path.join(folder, name), (stamp, stamp))


def audit(spark, folder):
    rows = request_audit(read_order_envelopes(spark, folder + "/*")).collect()
    return {r["request"].rsplit("/", 1)[-1]: (r["n_pages"], r["n_repeats"], r["n_corrupt"], r["expected"], r["landed"], r["n_breaks"], r["whole"])
            for r in rows}


def test_requests_are_whole_over_all_their_files(spark, tmp_path):
    f = str(tmp_path)
    land(f, "a/two.json", 0, 3, ["1", "2"], "00:00")
    land(f, "b/files.json", 2, 3, ["3"], "00:00")
    land(f, "a/lost0.json", 0, 5, ["1", "2"], "00:01")                       # its middle page is lost
    land(f, "a/lost2.json", 4, 5, ["5"], "00:01")
    land(f, "a/tail.json", 0, 4, ["1", "2"], "00:02")                        # its end is lost
    land(f, "a/over0.json", 0, 3, ["1", "2"], "00:03")                       # offsets 1 twice, sum of hits too large
    land(f, "a/over1.json", 1, 3, ["2", "3"], "00:03")
    land(f, "a/again0.json", 0, 3, ["1", "2"], "00:04")                      # a page landed twice
    land(f, "a/again1.json", 2, 3, ["x"], "00:04")
    land(f, "c/again1.json", 2, 3, ["y"], "00:04")
    later(f, "c/again1.json", 60)
    land(f, "a/grown.json", 0, 1, ["1"], "00:05")                            # a later landing reports more
    land(f, "b/grown.json", 0, 2, ["1", "2"], "00:05")
    later(f, "b/grown.json", 60)
    land(f, "a/none.json", 0, 0, [], "00:06")
    land(f, "a/same.json", 0, 1, ["1"], "00:06", "last_modified")            # another field: another request
    label = "orders_on_creation_date_2024-03-11_00_15_00_to_00_30_00"
    land(f, f"d/{label}_P0.json", 0, 2, ["7"])                               # known by the file's label
    land(f, f"d/{label}_P1.json", 1, 2, ["8"])
    (tmp_path / "d" / f"{label.replace('00_15', '01_15')}.json").write_text('{"total": 1, "co')
    land(f, "e/p0.json", 0, 3, ["1", "2"])                                   # unknown: by folder
    land(f, "e/p1.json", 2, 3, ["3"])
    land(f, "g/p0.json", 0, 3, ["1", "2"])
    got = audit(spark, f)
    of = lambda slice_, field="creation_date": got[f"{field} 2024-03-10T{slice_}:00.000Z 2024-03-10T{slice_}:59.000Z"]
    assert of("00:00") == (2, 0, 0, 3, 3, 0, True)
    assert of("00:01") == (2, 0, 0, 5, 3, 2, False)
    assert of("00:02") == (1, 0, 0, 4, 2, 2, False)
    assert of("00:03")[-1] is False and of("00:03")[4] == 4
    assert of("00:04") == (2, 1, 0, 3, 3, 0, True)
    assert of("00:05") == (1, 1, 0, 2, 2, 0, True)
    assert of("00:06") == (1, 0, 0, 0, 0, 0, True)
    assert of("00:06", "last_modified") == (1, 0, 0, 1, 1, 0, True)
    assert got[label] == (2, 0, 0, 2, 2, 0, True)
    assert got[label.replace("00_15", "01_15")] == (0, 0, 1, None, 0, 0, False)
    assert got["e"] == (2, 0, 0, 3, 3, 0, True) and got["g"] == (1, 0, 0, 3, 2, 1, False)
    days = {r["request_day"] for r in request_audit(read_order_envelopes(spark, f + "/*")).collect()}
    assert days == {D, NEXT, None}
    # Documents come from the last landing of a page.
    kept = [r["order_no"] for r in documents(latest_pages(read_order_envelopes(spark, f + "/*"))).collect()]
    assert "y" in kept and "x" not in kept and len(kept) == sum(v[4] for v in got.values())


def test_a_paged_request_over_two_files_is_published(spark, tmp_path):
    docs = [d for d in golden.order_documents() if d["order_no"] in ("1", "2", "3")]
    for n, part in ((0, docs[:2]), (2, docs[2:])):
        path = tmp_path / "landing" / f"page{n}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps({"total": 3, "count": len(part), "start": n, "hits": [{"data": d} for d in part],
                                    "query": {"filtered_query": {"filter": {"range_filter": {
                                        "field": "creation_date", "from": "2024-03-10T09:59:59.000Z", "to": "2024-03-10T10:00:00.000Z"}}}}}))
    # A broken request of another day does not count against this one.
    land(str(tmp_path), "landing/orders_on_creation_date_2024-03-12_00_15_00_to_00_30_00.json", 0, 9, [])
    envelopes = read_order_envelopes(spark, str(tmp_path / "landing"))
    found = documents(latest_pages(envelopes))
    run = P.run_orders(found, P.source_totals_of(found), run_dates=[D], envelopes=envelopes)
    assert [r["passed"] for r in run.verdicts.collect()] == [True]
    os.remove(tmp_path / "landing" / "page2.json")
    envelopes = read_order_envelopes(spark, str(tmp_path / "landing"))
    found = documents(envelopes)
    run = P.run_orders(found, P.source_totals_of(found), run_dates=[D], envelopes=envelopes)
    assert [r["passed"] for r in run.verdicts.collect()] == [False]


def test_a_repeated_probe_counts_once(spark, tmp_path):
    for field, totals in (("creation_date", (7, 10)), ("last_modified", (4,))):
        for n, total in enumerate(totals):
            folder = tmp_path / f"field={field}" / "run_date=2024-03-10"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"r{9 - n}.json").write_text(json.dumps({"total": total, "count": 1}))
            later(str(folder), f"r{9 - n}.json", 60 * n)
    r = read_probe_totals(spark, str(tmp_path)).first()
    assert (r["run_date"], r["total_created"], r["total_modified"], r["total_records"]) == (D, 10, 4, 14)
