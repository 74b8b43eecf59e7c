"""what an order's lines share is built once per order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import ingest
from kestrel.sources import feeds

D = dt.datetime(2024, 1, 2, 3, 4)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sales"))
    lines = [(50, 1, 7, 2.0, 10.9), (50, 1, 7, 2.0, 10.9), (51, 2, 40, 3.0, 5.0), (51, None, 8, 1.0, 1.0),
             (51, 3, None, 1.0, 1.0), (None, 1, 1, 1.0, 1.0), (99, 1, 1, 1.0, 1.0), (52, 1, 65, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double") \
        .write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(50, 3, D), (51, None, D), (52, 1234567, None), (None, 4, D), (53, 5, D)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{d}/orders.parquet")
    return d


def test_raw_rows_keep_nulls_and_copies(spark, folder):
    day = D.date()
    rows = sorted(map(tuple, feeds.sales_raw(spark, folder).collect()), key=str)
    copy = ("S50-1-7 ", " C000003", "P7", day, 2, 10)
    assert rows == sorted([copy] * 4 + [("S51-2-40 ", None, None, day, 3, 5), (None, None, "P8", day, 1, 1),
                                        (None, None, None, day, 1, 1), ("S52-1-65 ", " C123456", "P65", None, None, None)], key=str)


def test_silver_drops_null_keys_and_copies(spark, folder):
    raw = feeds.sales_raw(spark, folder)
    rows = sorted(tuple(r) for r in ingest.silver(raw, "sales").select("sale_id", "amount").collect())
    assert rows == [("S50-1-7", 10), ("S51-2-40", 5), ("S52-1-65", None)]
    good, _ = ingest.split_on_key(ingest.clean_sales(raw), "sale_id")
    assert ingest.silver(raw, "sales").exceptAll(good).isEmpty() and good.exceptAll(ingest.silver(raw, "sales")).isEmpty()


def test_key_of_any_text_is_tested_as_cleaned(spark):
    raw = spark.createDataFrame([("",), ("  ",), (None,), (" a ",)], "sale_id string").select(
        "sale_id", *[F.lit(None).cast(t).alias(c) for c, t in (("customer_id", "string"), ("product_id", "string"),
                                                              ("sale_date", "date"), ("quantity", "int"), ("amount", "int"))])
    assert sorted(r.sale_id for r in ingest.silver(raw, "sales").collect()) == ["", "a"]


def test_order_texts_are_built_before_the_join(spark, folder):
    plan = ingest.silver(feeds.sales_raw(spark, folder), "sales")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert not any("lpad" in x for x in lines[:join]) and any("lpad" in x for x in lines[join:])
