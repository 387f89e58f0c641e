"""The tables as SQL views: statements in the source dialect give the same
answers as the DataFrame reports, on the flat table and on the star."""

from collections import Counter

from starloom.plans import reports
from starloom.plans.star import StarV1
from starloom.plans.views import register_views
from starloom.sources.testdata import VERMONT_ANALOG, TestData

from .conftest import SF_SMALL


def _ms(df):
    return Counter(tuple(r) for r in df.collect())


def test_sql_over_views_matches_reports(spark):
    td = TestData(spark, SF_SMALL)
    flat = td.flat_orders()
    v1 = StarV1(flat, td.people(), td.returns(), VERMONT_ANALOG)
    names = register_views(spark, flat, td.people(), td.returns(), v1)
    assert {"orders", "people", "returns", "sales_fact", "customer_dim", "deliver_dim"} <= set(names)

    by_region = spark.sql("select region, cast(round(sum(sales), 2) as decimal(38,2)) as sales "
                          "from orders group by region order by sales asc")
    assert _ms(by_region) == _ms(reports.sales_by_region(flat))

    monthly = spark.sql(
        "select cast(extract(year from order_date) as bigint) as year, "
        "cast(extract(month from order_date) as bigint) as month, segment, "
        "cast(sum(sales) as decimal(38,2)) as total_sales from orders "
        "group by year, month, segment order by year asc, month asc")
    assert _ms(monthly) == _ms(reports.monthly_sales_by_segment(flat))

    ranking = spark.sql(
        "select cast(row_number() over (order by sum(sales) desc, customer_id) as bigint) as rank, customer_id, "
        "cast(round(sum(sales), 2) as decimal(38,2)) as sales from orders group by customer_id")
    assert _ms(ranking) == _ms(reports.customer_ranking(flat))

    star_region = spark.sql(
        "select d.region, cast(round(sum(f.sales), 2) as decimal(38,2)) as sales "
        "from sales_fact f join deliver_dim d on d.deliver_id = f.deliver_id group by d.region")
    assert _ms(star_region) == _ms(reports.sales_by_region(flat))
