"""Money and scores keep their digits; nothing is dropped on the way to a mart."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from starloom.operators.clean import conform_orders
from starloom.plans import marts, rental, reports
from starloom.schemas import ORDERS_SCHEMA, SCORE_COLUMNS
from starloom.sources.files import read_orders
from starloom.sources.testdata import TestData

from .conftest import SF_SMALL

ROW = {"row_id": "1", "order_id": "o", "order_date": dt.date(2020, 1, 2), "ship_date": dt.date(2020, 1, 3), "ship_mode": "m",
       "customer_id": "c", "customer_name": "n", "segment": "s", "country": "x", "state": "x", "city": "x", "postal_code": 1,
       "region": "r", "product_name": "p", "category": "NEW", "subcategory": "b", "sales": D("957.5775"), "quantity": 1,
       "discount": D("0.10"), "profit": D("1.0000000000000001")}


def orders(spark, *changes):
    return spark.createDataFrame([ROW | c for c in changes], ORDERS_SCHEMA)


def test_reader_and_sums_keep_every_digit(spark, tmp_path):
    orders(spark, *[{}] * 4).write.parquet(str(tmp_path / "o"))
    orders(spark, *[{}] * 4).write.option("header", True).csv(str(tmp_path / "c"))
    for df in (read_orders(spark, str(tmp_path / "o")), read_orders(spark, str(tmp_path / "c"), "csv")):
        assert reports.sales_per_customer(df).first().total_sales == D("3830.3100")
        r = reports.sales_profit_by_customer(df).first()
        assert (r.sales, r.profit) == (D("3830.31"), D("4.0000000000000004"))
        assert reports.monthly_sales_by_category(df).first().total_sales == D("3830.31")


def test_profit_ratio_at_any_scale(spark):
    df = orders(spark, {"sales": D("0.4440"), "profit": D("-1.11")})
    assert reports.profit_ratio(df).first().ratio == "-250.000%"
    narrow = df.withColumn("sales", F.lit(D("0.444")).cast("decimal(9,3)")).withColumn("profit", F.lit(D("-1.11")).cast("decimal(9,2)"))
    assert reports.profit_ratio(narrow).first().ratio == "-250.000%"


def test_conform_lists_what_it_cannot_hold(spark):
    wide = orders(spark, {}).withColumn("sales", F.lit("99999999999999.00")).withColumn("profit", F.lit("0.12345678901234567"))
    (r,) = conform_orders(wide).collect()
    assert r.sales is None and {"sales", "profit"} <= set(r.violations.split(","))
    (r,) = conform_orders(orders(spark, {})).collect()
    assert r.sales == D("957.5775") and "sales" not in r.violations.split(",")


def test_pivot_holds_all_sales(spark):
    df = orders(spark, {}, {"category": "A"}, {"category": None})
    (r,) = marts.pivot_sales_category_year(df, ["A", "B"]).collect()
    assert (r.A, r.B, r.other, r.total) == (D("957.5775"), None, D("1915.1550"), D("2872.7325"))


def test_ratings_keep_two_decimals(spark):
    row = [1, D("95.0")] + [D("4.83")] * 6
    df = spark.createDataFrame([row], "listing_id long, review_scores_rating decimal(7,4), "
                               + ", ".join(f"{c} decimal(6,4)" for c in SCORE_COLUMNS))
    assert rental.overall_rating(df).first().overall_rating == D("99.8300")


def test_reviews_are_all_lines_with_an_order(spark):
    td = TestData(spark, SF_SMALL)
    lines = td.table("lineitem").join(td.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert td.reviews().count() == lines.count()
