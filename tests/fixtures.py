"""Hand fixtures (FIXTURES.md section 3) built as small DataFrames."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from starloom import schemas

D = Decimal


def order_line(row_id, order_id="CA-2019-1", order_date=dt.date(2019, 1, 5), ship_date=dt.date(2019, 1, 9),
               ship_mode="Standard Class", customer_id="C1", customer_name="Ann", segment="Consumer",
               country="United States", state="Texas", city="Austin", postal_code=73301, region="Central",
               product_name="Pen", category="Office Supplies", subcategory="Art", sales="10.00", quantity=1,
               discount="0.00", profit="1.0000"):
    return (str(row_id), order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, country,
            state, city, postal_code, region, product_name, category, subcategory, D(sales), quantity, D(discount),
            D(profit))


def flat(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDERS_SCHEMA)


# fixed values: the four people rows of the source sheet
PEOPLE_REF = [("Anna Andreadi", "West"), ("Chuck Magee", "East"), ("Kelly Williams", "Central"),
              ("Cassandra Brandow", "South")]


# fixed values: the first ten rows of the returns sheet (one order four times)
RETURNS_REF = [("Yes", "CA-2016-100762"), ("Yes", "CA-2016-100762"), ("Yes", "CA-2016-100762"),
               ("Yes", "CA-2016-100762"), ("Yes", "CA-2016-100867"), ("Yes", "CA-2016-102652"),
               ("Yes", "CA-2016-102652"), ("Yes", "CA-2016-102652"), ("Yes", "CA-2016-102652"),
               ("Yes", "CA-2016-103373")]


def people(spark, rows=PEOPLE_REF):
    return spark.createDataFrame(rows, schemas.PEOPLE_SCHEMA)


def returns(spark, rows):
    return spark.createDataFrame(rows, schemas.RETURNS_SCHEMA)


REGIONS = ["West", "East", "Central", "South"]
SEGMENTS = ["Consumer", "Corporate", "Home Office"]
MODES = ["First Class", "Same Day", "Second Class", "Standard Class"]


def random_orders(spark, n_orders=60, seed=7):
    """Seeded random flat orders obeying the order-level dependencies
    (one customer, destination, dates, ship mode per order)."""
    rnd = random.Random(seed)
    customers = [(f"C{i:03d}", f"Name{i % 17}", rnd.choice(SEGMENTS)) for i in range(20)]
    places = [("United States", f"State{i}", f"City{i}", 10000 + i, REGIONS[i % 4]) for i in range(9)]
    places.append(("United States", "Vermont", "Burlington", None, "East"))
    products = [(f"Product {i}", f"Cat{i % 3}", f"Sub{i % 5}") for i in range(15)]
    rows, rid = [], 0
    for o in range(n_orders):
        cid, cname, seg = rnd.choice(customers)
        country, state, city, postal, region = rnd.choice(places)
        od = dt.date(2016 + o % 4, 1 + o % 12, 1 + o % 28)
        sd = od + dt.timedelta(days=rnd.randint(0, 6))
        mode = rnd.choice(MODES)
        for _ in range(rnd.randint(1, 5)):
            rid += 1
            pname, cat, sub = rnd.choice(products)
            sales = D(rnd.randint(100, 500000)) / 100
            disc = D(rnd.choice([0, 10, 20, 45])) / 100
            profit = (sales * (D("0.08") - disc)).quantize(D("0.0001"))
            rows.append((str(rid), f"US-{2016 + o % 4}-{o:05d}", od, sd, mode, cid, cname, seg, country, state,
                         city, postal, region, pname, cat, sub, sales, rnd.randint(1, 9), disc, profit))
    return flat(spark, rows)
