from decimal import Decimal as D

from starloom.plans import reports

from .fixtures import flat, order_line


def test_profit_ratio_and_label(spark):
    df = flat(spark, [order_line(1, sales="100.00", profit="3.0000"), order_line(2, sales="200.00", profit="-1.0000")])
    r = reports.profit_ratio(df).collect()[0]
    # 2 / 300 * 100 = 0.6666.. -> 0.667
    assert (r.ratio, r.ratio_pct) == ("0.667%", D("0.667"))


def test_profit_ratio_empty_and_zero_sales(spark):
    empty = flat(spark, [])
    r = reports.profit_ratio(empty).collect()[0]
    assert (r.ratio, r.ratio_pct) == ("%", None)
    zero = flat(spark, [order_line(1, sales="0.00", profit="0.0000")])
    assert reports.profit_ratio(zero).collect()[0].ratio == "%"


def test_avg_discount_rounds_half_up_before_times_100(spark):
    # mean 0.045 exactly -> 0.05 -> 5.00%
    df = flat(spark, [order_line(1, discount="0.04"), order_line(2, discount="0.05")])
    r = reports.avg_discount(df).collect()[0]
    assert (r.average_discount, r.average_discount_pct) == ("5.00%", D("5.00"))


def test_customer_ranking_uses_unrounded_sum_and_breaks_ties_by_id(spark):
    df = flat(spark, [order_line(1, customer_id="B", sales="10.00"), order_line(2, customer_id="A", sales="10.00"),
                      order_line(3, customer_id="C", sales="10.01"), order_line(4, customer_id="D", sales="1.00")])
    got = [(r["rank"], r.customer_id) for r in reports.customer_ranking(df).orderBy("rank").collect()]
    assert got == [(1, "C"), (2, "A"), (3, "B"), (4, "D")]


def test_monthly_sales_groups_by_year_month(spark):
    import datetime as dt
    df = flat(spark, [order_line(1, order_date=dt.date(2019, 1, 5), sales="1.00"),
                      order_line(2, order_date=dt.date(2019, 1, 30), sales="2.00"),
                      order_line(3, order_date=dt.date(2019, 2, 1), sales="4.00", segment="Corporate")])
    got = sorted(tuple(r) for r in reports.monthly_sales_by_segment(df).collect())
    assert got == [(2019, 1, "Consumer", D("3.00")), (2019, 2, "Corporate", D("4.00"))]


def test_sales_by_region_ascending(spark):
    df = flat(spark, [order_line(1, region="West", sales="5.00"), order_line(2, region="East", sales="2.00")])
    assert [r.region for r in reports.sales_by_region(df).collect()] == ["East", "West"]
