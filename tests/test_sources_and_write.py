import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from starloom import schemas
from starloom.sources import read_listings, read_orders, read_people, read_returns, read_reviews
from starloom.sources.testdata import TestData
from starloom.plans.star import StarV1

from .conftest import SF_SMALL
from .fixtures import people, random_orders, returns


def test_csv_listings_with_quotes_commas_and_newlines(spark):
    td = TestData(spark, SF_SMALL)
    src = td.listings()
    tricky = spark.createDataFrame([(10 ** 9, 'Loft "sunny", near\nthe park', "Paris", "Centre", "Entire place", 2, 4,
                                     D("120.50"), D("95.0"), D("9.0"), D("9.0"), D("9.0"), D("9.0"), D("9.0"),
                                     D("9.0"))], schemas.LISTINGS_SCHEMA)
    expected = src.unionByName(tricky)
    path = tempfile.mkdtemp(prefix="starloom-csv-") + "/listings"
    expected.write.option("header", True).option("escape", '"').csv(path)
    got = read_listings(spark, path)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.LISTINGS_SCHEMA]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in expected.collect())


def test_csv_reviews_roundtrip(spark):
    r = TestData(spark, SF_SMALL).reviews()
    path = tempfile.mkdtemp(prefix="starloom-csv-") + "/reviews"
    r.write.option("header", True).csv(path)
    got = read_reviews(spark, path)
    assert got.exceptAll(r).count() == 0 and r.exceptAll(got).count() == 0


def test_parquet_readers_cast_to_engine_types(spark):
    base = tempfile.mkdtemp(prefix="starloom-pq-")
    td = TestData(spark, SF_SMALL)
    td.flat_orders().write.parquet(base + "/orders")
    td.people().write.parquet(base + "/people")
    td.returns().write.parquet(base + "/returns")
    orders = read_orders(spark, base + "/orders")
    assert [(f.name, f.dataType) for f in orders.schema] == [(f.name, f.dataType) for f in schemas.ORDERS_SCHEMA]
    assert orders.count() == 6000
    assert read_people(spark, base + "/people").count() == 5
    assert read_returns(spark, base + "/returns").where(F.col("returned") == "Yes").count() == 1968


def test_full_refresh_write_is_rerunnable(spark):
    f = random_orders(spark, n_orders=15)
    ids = [r.order_id for r in f.select("order_id").distinct().collect()][:4]
    v1 = StarV1(f, people(spark), returns(spark, [("Yes", i) for i in ids]), "Vermont")
    out = tempfile.mkdtemp(prefix="starloom-dw-")
    v1.write(out)
    first = {n: spark.read.parquet(f"{out}/{n}").count() for n in v1.tables()}
    StarV1(f, people(spark), returns(spark, [("Yes", i) for i in ids]), "Vermont").write(out)
    second = {n: spark.read.parquet(f"{out}/{n}").count() for n in v1.tables()}
    assert first == second
    assert first["sales_fact"] == f.count()
    assert first["order_dim"] == f.select("order_id").distinct().count()
