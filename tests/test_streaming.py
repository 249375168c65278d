"""Landing-folder ingestion: two response files, two micro-batches, replay-safe."""

import os

from cartloom.streaming.landing import stream_order_slices
from tests import golden


def test_stream_flattens_each_landed_file(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    docs = golden.order_documents()
    golden.write_envelopes(os.path.join(landing, "a"), docs[:6])
    os.replace(os.path.join(landing, "a", "responses.json"), os.path.join(landing, "r1.json"))
    golden.write_envelopes(os.path.join(landing, "b"), docs[6:])
    os.replace(os.path.join(landing, "b", "responses.json"), os.path.join(landing, "r2.json"))
    os.rmdir(os.path.join(landing, "a"))
    os.rmdir(os.path.join(landing, "b"))
    out = os.path.join(tmp_dir, "slices")
    ckpt = os.path.join(tmp_dir, "ckpt")
    q = stream_order_slices(spark, landing, out, checkpoint=ckpt, files_per_batch=1)
    q.awaitTermination(120)
    orders = spark.read.parquet(os.path.join(out, "orders"))
    assert {r["batch_id"] for r in orders.select("batch_id").distinct().collect()} == {0, 1}
    assert orders.select("order_order_no").distinct().count() == 10
    quarantined = spark.read.parquet(os.path.join(out, "quarantine")).collect()
    assert [r["order_no"] for r in quarantined] == ["5"]
    # a second run finds nothing new
    q2 = stream_order_slices(spark, landing, out, checkpoint=ckpt, files_per_batch=1)
    q2.awaitTermination(120)
    assert spark.read.parquet(os.path.join(out, "orders")).count() == orders.count()


def test_streamed_slices_merge_into_the_day_tables(spark, tmp_dir):
    from pyspark.sql import functions as F

    from cartloom.operators import flatten as FL
    from cartloom.plans import pipelines as P
    from cartloom.sources.envelope import documents, read_order_envelopes

    landing = os.path.join(tmp_dir, "landing")
    golden.write_envelopes(landing, golden.order_documents())
    out = os.path.join(tmp_dir, "slices")
    q = stream_order_slices(spark, landing, out, checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    docs = documents(read_order_envelopes(spark, landing))
    merged = P.merge_day_files(spark, out, "2024-03-10",
                               P.slice_schemas(FL.valid_documents(docs)), fmt="parquet")
    direct = P.order_tables(docs)
    for entity in ("orders", "products", "option_items", "payments"):
        a = {tuple(r) for r in merged[entity].collect()}
        b = {tuple(r) for r in direct[entity].filter(F.col("run_date") == "2024-03-10").collect()}
        assert a == b, entity
