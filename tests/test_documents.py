"""The document builder under skew: one order holding most lines, all copies of
one line, is split into bounded documents with the order's own header values."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cartloom.operators import flatten as FL
from cartloom.plans import documents as D


def test_hot_order_of_copies_is_split_into_bounded_documents(spark):
    ship = dt.datetime(2024, 1, 2)
    hot = [(1, 10, 4, 1, 1.0, 100.0, 0.06, 0.01, "A", "O", ship)] * 5000
    rest = [(2, 11, 5, 1, 2.0, 50.0, 0.01, 0.02, "N", "F", ship + dt.timedelta(days=3))]
    late = [(1, 12, 4, 2, 1.0, 10.0, 0.0, 0.0, "A", "O", ship + dt.timedelta(days=9))]
    lines = spark.createDataFrame(hot + rest + late, ", ".join(
        f"{c} {t}" for c, t in zip(D.LINE_COLS, ["long", "long", "long", "int", "double", "double",
                                                  "double", "double", "string", "string",
                                                  "timestamp_ntz"])))
    orders = spark.createDataFrame([(1, 7, "O", 123.45, dt.datetime(2024, 1, 1), "1-URGENT"),
                                    (2, 8, "F", 10.0, dt.datetime(2024, 1, 1), "2-HIGH"),
                                    (3, 9, "F", 1.0, dt.datetime(2024, 1, 1), "3-MEDIUM")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, "
                                   "o_totalprice double, o_orderdate timestamp_ntz, "
                                   "o_orderpriority string")
    docs = D.order_documents(orders, lines, max_items=100).cache()
    sizes = docs.select("order_no", F.size("product_items").alias("n"), "last_modified").collect()
    hot_docs = [r for r in sizes if r["order_no"] == "1"]
    assert len(hot_docs) > 40                      # ~ceil(5001 / 100) parts
    assert max(r["n"] for r in hot_docs) < 200     # bounded, hash-balanced
    assert sum(r["n"] for r in hot_docs) == 5001   # nothing dropped
    assert {r["last_modified"] for r in hot_docs} == {ship + dt.timedelta(days=9)}
    assert [r["n"] for r in sizes if r["order_no"] == "2"] == [1]
    assert [r["n"] for r in sizes if r["order_no"] == "3"] == [-1] or \
        [r["n"] for r in sizes if r["order_no"] == "3"] == [None]
    products = FL.product_rows(docs)
    assert products.filter(F.col("order_order_no") == "1").count() == 5001
    docs.unpersist()


def test_order_queries_do_not_depend_on_the_split(spark, tmp_path):
    """One order with 5,000 lines: every query over order documents equals its oracle."""
    from cartloom.plans.queries import oracle_queries, spark_queries
    from tests.conftest import SF001
    from tools.oracle_check import digest, duck

    data = str(tmp_path / "data")
    os.mkdir(data)
    for name in os.listdir(SF001):
        if name != "lineitem.parquet":
            os.symlink(f"{SF001}/{name}", f"{data}/{name}")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    first = lines.filter("l_discount > 0.05").limit(1)
    copies = (first.crossJoin(spark.range(5000)).withColumn("l_orderkey", F.lit(1).cast("long"))
              .withColumn("l_linenumber", (F.col("id") + 100).cast("int"))
              .withColumn("l_suppkey", F.col("id") % 7).withColumn("l_partkey", F.col("id")).drop("id"))
    hot = str(tmp_path / "hot")
    cast = [F.col(f.name).cast(f.dataType) for f in lines.schema.fields]
    lines.unionByName(copies.select(*cast)).coalesce(1).write.parquet(hot)
    (part,) = [p for p in (tmp_path / "hot").iterdir() if p.suffix == ".parquet"]
    os.symlink(part, f"{data}/lineitem.parquet")
    con = duck(data)
    for name in ("order_product_lines", "order_entity_product", "first_item_adjustments", "option_items",
                 "payment_details", "array_to_json", "reconcile_all", "publish_gate", "day_counts"):
        df = spark_queries()[name](spark, data)
        cur = con.execute(oracle_queries()[name])
        want = digest([c[0] for c in cur.description], cur.fetchall())[0]
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == want, name


def _order_tables(spark, path=None):
    """Four orders (two days, none, and none with lines) of 0 to 5 lines in two or three groups."""
    day = dt.datetime(2024, 1, 1)
    lines = [(o, 10 * o + n, n % 3, n, 1.0, 100.0, 0.06 if n % 2 else 0.01, 0.01, "A", "O", day)
             for o, count in ((1, 5), (2, 2), (4, 4)) for n in range(1, count + 1)]
    lines = spark.createDataFrame(lines, ", ".join(f"{c} {t}" for c, t in zip(
        D.LINE_COLS, ["long", "long", "long", "int", *["double"] * 4, "string", "string", "timestamp_ntz"])))
    orders = spark.createDataFrame([(o, 7, "O", 10.0, when, "1-URGENT") for o, when in (
        (1, day), (2, dt.datetime(1996, 9, 17)), (3, day), (4, None))],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    if path is not None:
        for name, table in (("orders", orders), ("lineitem", lines)):
            table.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return orders, lines


def test_entity_product_has_the_orders_of_every_day(spark, tmp_path):
    import duckdb

    from cartloom.plans.queries import oracle_queries, spark_queries
    from tools.oracle_check import digest

    _order_tables(spark, tmp_path)
    rows = spark_queries()["entity_product_slice"](spark, str(tmp_path))
    con = duckdb.connect()
    for name in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    cur = con.execute(oracle_queries()["entity_product_slice"])
    found = [tuple(r) for r in rows.collect()]
    assert {r[0] for r in found} == {"1", "2", "3", "4"}
    assert digest(rows.columns, found) == digest([c[0] for c in cur.description], cur.fetchall())


def test_entity_product_does_not_depend_on_the_split(spark):
    whole, parts = (FL.entity_product(D.order_documents(*_order_tables(spark), max_items=n)) for n in (100, 2))
    assert parts.count() > 0 == whole.exceptAll(parts).count() == parts.exceptAll(whole).count()
    for n in (100, 2):
        sizes = FL.entity_product_size(D.order_documents(*_order_tables(spark), max_items=n))
        assert sizes.agg(F.sum("n_rows")).first()[0] == whole.count()
