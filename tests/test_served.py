"""Served marts, one-year reports, the stored scorecard, money with all its digits, tolerant CSV loading."""

import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import catalog, schemas
from starloom.plans import marts, rental, reports
from starloom.plans.cubes import MARTS, SalesMarts
from starloom.plans.rental import HomeFilter
from starloom.sources import read_listings, read_orders, read_reviews
from starloom.sources.files import load_sheet
from starloom.sources.testdata import TestData

from .conftest import SF_SMALL
from .fixtures import flat, order_line, people, random_orders, returns


@pytest.fixture
def whole_plans(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# marts

def test_every_covered_report_is_the_same_from_a_mart(spark):
    f = random_orders(spark)
    served = SalesMarts(f)
    covered = [r for r in reports.REPORTS if served.covers(r)]
    assert set(catalog.MART_REPORTS) <= set(covered)
    assert "profit_per_order" not in covered and "avg_discount" not in covered
    for r in covered:
        assert _rows(served.answer(r)) == _rows(reports.REPORTS[r](f)), r
    assert _rows(served.dashboard()) == _rows(marts.sales_dashboard(f))
    with pytest.raises(ValueError, match="order_id"):
        served.answer("profit_per_order")


def test_the_smallest_covering_mart_answers(spark, whole_plans):
    served = SalesMarts(random_orders(spark))
    assert served.rows == {n: df.count() for n, df in served.tables.items()}
    assert served.choose(["category", "sales"]) == "sales_areas"
    assert served.choose(["customer_id", "profit"]) == "sales_customers"
    assert served.choose(["order_date", "segment", "sales"]) == "sales_monthly"
    assert served.choose(["order_date", "customer_id"]) == "sales_cube"
    assert served.choose(["discount"]) is None
    scan = served.answer("sales_by_region")._jdf.queryExecution().executedPlan().toString()
    assert "sales_areas" in scan and "ReadSchema: struct<region:string,sales:" in scan
    assert set(served.tables) == set(MARTS)


def test_marts_of_nothing(spark):
    served = SalesMarts(flat(spark, []))
    assert set(served.rows.values()) == {0}
    assert served.answer("sales_by_category").count() == 0


# money

def _small_money(spark):
    rows = [order_line(i, order_id=f"O{i}") for i in range(3)]
    return (flat(spark, rows).withColumn("sales", F.lit(D("0.0044")).cast("decimal(15,4)"))
            .withColumn("profit", F.lit(D("0.00001")).cast("decimal(32,16)")))


def test_dashboard_and_managers_keep_every_digit(spark):
    f = _small_money(spark)
    wide = marts.wide_orders(f, people(spark), returns(spark, []))
    for row in (marts.manager_performance(wide).first(), marts.sales_dashboard(f).first(), SalesMarts(f).dashboard().first()):
        assert (row.sales, row.profit) == (D("0.0132"), D("0.00003"))


# scorecard

@pytest.fixture(scope="module")
def card(spark):
    td = TestData(spark, SF_SMALL)
    return td.listings(), td.reviews(), rental.stored_scorecard(td.listings(), td.reviews())


@pytest.mark.parametrize("flt", [
    HomeFilter(), HomeFilter(city="PROMO"), HomeFilter(city="PROMO", min_reviews=5, min_bedrooms=2, min_capacity=3),
    HomeFilter(min_reviews=20), HomeFilter(city="none"), HomeFilter(year=1996, min_reviews=2), HomeFilter(room_type="Private room"),
    HomeFilter(year=1996, city="PROMO")])
def test_filters_are_the_same_over_the_stored_scorecard(spark, card, flt):
    listings, reviews, stored = card
    assert _rows(rental.filter_homes(listings, reviews, flt, stored)) == _rows(rental.filter_homes(listings, reviews, flt))


def test_a_city_without_listing_parameters_reads_no_review(spark, card, whole_plans):
    listings, reviews, stored = card
    plan = rental.filter_homes(listings, reviews, HomeFilter(city="PROMO", min_reviews=5, min_bedrooms=2), stored)
    plan = re.sub(r"#\d+L?", "", plan._jdf.queryExecution().executedPlan().toString())
    assert "lineitem" not in plan and "Aggregate" not in plan
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan)[1]
    for name in ["EqualTo(city,PROMO)", "GreaterThanOrEqual(reviews,5)", "GreaterThanOrEqual(bedrooms,2)"]:
        assert name in pushed


# CSV

SHEET = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), True),
                      T.StructField("day", T.DateType(), True), T.StructField("amount", T.DecimalType(9, 2), True)])


def _sheet(tmp_path, *lines, name="sheet.csv"):
    (tmp_path / name).write_text("".join(f"{x}\n" for x in lines), encoding="utf-8")
    return str(tmp_path / name)


def test_bad_lines_are_counted_not_fatal(spark, tmp_path):
    path = _sheet(tmp_path, "id,name,day,amount", '1,"a, ""b""",2020-01-02,1.50', "2,b,2020-13-02,1.50", "3,c,2020-01-02",
                  "4,d,2020-01-02,1.50,extra", ",e,2020-01-02,1.50", "6,f,,", "x,g,2020-01-02,1.50", "8,é 中,2020-01-02,-0.01")
    got = load_sheet(spark, path, SHEET)
    assert [r.id for r in got.rows.orderBy("id").collect()] == [1, 6, 8]
    assert got.rows.where("id = 1").first().name == 'a, "b"' and got.rows.columns == SHEET.fieldNames()
    bad = {(r.reason, r.line) for r in got.rejects.collect()}
    assert bad == {("malformed", "2,b,2020-13-02,1.50"), ("malformed", "3,c,2020-01-02"), ("malformed", "4,d,2020-01-02,1.50,extra"),
                   ("malformed", "x,g,2020-01-02,1.50"), ("missing id", '{"name":"e","day":"2020-01-02","amount":1.50}')}
    assert got.rejects.select("file").distinct().first().file.endswith("sheet.csv")
    assert got.rejects.count() + got.rows.count() == 8


def test_pruned_reads_of_a_loaded_sheet_reject_the_same(spark, tmp_path):
    path = _sheet(tmp_path, "id,name,day,amount", "1,a,2020-01-02,1", "2,b,never,1")
    got = load_sheet(spark, path, SHEET)
    assert got.rows.select("id").collect() == [(1,)] and got.rejects.select("reason").count() == 1


def test_empty_sheet_and_clashing_names(spark, tmp_path):
    got = load_sheet(spark, _sheet(tmp_path, "id,name,day,amount"), SHEET)
    assert got.rows.count() == got.rejects.count() == 0
    with pytest.raises(ValueError, match="_reason"):
        load_sheet(spark, "x", T.StructType([T.StructField("_reason", T.StringType())]))


def test_line_breaks_in_quotes_need_one_task_a_file(spark, tmp_path):
    path = _sheet(tmp_path, "id,name,day,amount", '1,"two', 'lines",2020-01-02,1.50')
    assert load_sheet(spark, path, SHEET, multi_line=True).rows.first().name == "two\nlines"
    assert load_sheet(spark, path, SHEET).rejects.count() == 2


def test_large_sheets_are_split(spark, tmp_path):
    td = TestData(spark, SF_SMALL)
    reviews, orders = str(tmp_path / "r"), str(tmp_path / "o")
    td.reviews().coalesce(1).write.option("header", True).csv(reviews)
    td.flat_orders().coalesce(1).write.option("header", True).option("escape", '"').csv(orders)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert read_reviews(spark, reviews).rdd.getNumPartitions() > 2
        assert read_orders(spark, orders, "csv").rdd.getNumPartitions() > 2
        assert read_orders(spark, orders, "csv").count() == td.flat_orders().count()
        assert read_reviews(spark, reviews).exceptAll(td.reviews()).count() == 0
        loaded = load_sheet(spark, orders, schemas.ORDERS_SCHEMA)
        assert loaded.rows.count() == td.flat_orders().count() and loaded.rejects.count() == 0
        one = str(tmp_path / "l")
        td.listings().coalesce(1).write.option("header", True).option("escape", '"').csv(one)
        assert read_listings(spark, one).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# the latest listing

@pytest.mark.parametrize("reviewed", [{}, {5: "2020-01-01", 3: "2020-01-01"}, {5: "9999-12-31"}, {2 ** 63 - 1: "1901-01-01"},
                                      {5: "0001-01-01"}, {3: "2019-02-28", -2 ** 63: "2019-02-27"}])
def test_latest_listing_is_a_hash_aggregate_and_exact(spark, reviewed):
    listed = {5: (None, -2 ** 31), 3: (2 ** 31 - 1, None), -2 ** 63: (7, 8), 2 ** 63 - 1: (0, 0)}
    listings = spark.createDataFrame([(i, "n", "c", "h", "r", b, a, D("1.00"), *[D("5.0000")] * 7) for i, (b, a) in listed.items()],
                                     schemas.LISTINGS_SCHEMA)
    reviews = spark.createDataFrame([(i, day, 1) for i, day in reviewed.items()], "listing_id long, day string, reviewer_id long")
    reviews = reviews.select("listing_id", F.col("day").cast("date").alias("review_date"), "reviewer_id")
    card = rental.home_scorecard(listings, reviews)
    (row,) = card.collect()
    want = min(listed, key=lambda i: ([-ord(c) for c in reviewed.get(i, "1900-01-01")], i))
    assert (row.latest_listing_id, row.bedrooms, row.accommodates) == (want, *listed[want])
    plan = card._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
