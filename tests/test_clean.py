from starloom.operators.clean import conform_orders, dedup_returns, repair_postal_code, with_return_flag

from .fixtures import RETURNS_REF, flat, order_line, returns


def test_repair_overwrites_every_row_of_the_state(spark):
    df = flat(spark, [order_line(1, state="Vermont", postal_code=None),
                      order_line(2, state="Vermont", postal_code=5401),
                      order_line(3, state="Texas", postal_code=73301),
                      order_line(4, state="Texas", postal_code=None)])
    got = {r.row_id: r.postal_code for r in repair_postal_code(df, "Vermont").collect()}
    assert got == {"1": 0, "2": 0, "3": 73301, "4": None}


def test_returns_dedup_reference_rows_and_conflict(spark):
    # first rows of the returns sheet, plus one order with two flags and a NULL id
    r = returns(spark, RETURNS_REF + [("No", "X-1"), ("Yes", "X-1"), ("Yes", None)])
    got = sorted(tuple(x) for x in dedup_returns(r).collect())
    assert got == [("Yes", "CA-2016-100762"), ("Yes", "CA-2016-100867"), ("Yes", "CA-2016-102652"),
                   ("Yes", "CA-2016-103373"), ("Yes", "X-1")]


def test_return_flag_default(spark):
    df = flat(spark, [order_line(1, order_id="A"), order_line(2, order_id="B"), order_line(3, order_id="B")])
    r = dedup_returns(returns(spark, [("Yes", "B"), ("Yes", "B")]))
    got = sorted((x.row_id, x.returned) for x in with_return_flag(df, r).collect())
    assert got == [("1", "No"), ("2", "Yes"), ("3", "Yes")]


def test_conform_flags_widths_nulls_and_precision(spark):
    df = flat(spark, [order_line(1), order_line(2, city="A" * 18, sales="123456.00", customer_name=None)])
    got = {r.row_id: r.violations for r in conform_orders(df).collect()}
    assert got == {"1": "", "2": "customer_name,city,sales"}
