from starloom import schemas
from starloom.operators import audit
from starloom.plans.star import DELIVER_KEY, StarV1, StarV2

from .fixtures import flat, order_line, people, random_orders, returns


def _rows(df, key="column_name"):
    return {r[key]: r.violations for r in df.collect()}


def test_primary_keys_clean_and_customer_with_two_segments(spark):
    f = flat(spark, [order_line(1, customer_id="C1", segment="Consumer"),
                     order_line(2, customer_id="C1", segment="Corporate"),
                     order_line(3, customer_id="C2")])
    v1 = StarV1(f, people(spark), returns(spark, []), "Vermont")
    got = {r.table_name: r.violations for r in audit.primary_keys(v1.tables(), {
        n: s["pk"] for n, s in schemas.MODEL_V1.items()}).collect()}
    assert got["customer_dim"] == 1
    assert all(v == 0 for t, v in got.items() if t != "customer_dim")


def test_orphans_zero_on_built_model(spark):
    f = random_orders(spark, n_orders=20)
    v1 = StarV1(f, people(spark), returns(spark, []), "Vermont")
    fks = [(c, cols, p, pc) for c, s in schemas.MODEL_V1.items() for cols, p, pc in s["fk"]]
    assert all(r.violations == 0 for r in audit.orphans(v1.tables(), fks).collect())


def test_orphans_found_exactly(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (12,), (12,)], "pk int")
    r = audit.orphans({"c": child, "p": parent}, [("c", ["fk"], "p", ["pk"])]).collect()[0]
    assert (r.checked_rows, r.violations) == (3, 1)


def test_not_null_and_type_fit(spark):
    f = flat(spark, [order_line(1), order_line(2, city="X" * 18, customer_name=None, sales="100000.00")])
    got = {(r.rule, r.column_name): r.violations
           for r in audit.declared_columns(f, "orders", schemas.ORDER_COLUMNS).collect()}
    assert got[("not_null", "customer_name")] == 1
    assert got[("type_fit:varchar(17)", "city")] == 1
    assert got[("type_fit:numeric(9,4)", "sales")] == 1
    assert got[("not_null", "city")] == 0 and got[("type_fit:int", "row_id")] == 0


def test_declared_rules_of_every_model_table(spark):
    f = flat(spark, [order_line(1), order_line(2, order_id="B", segment="S" * 12, customer_name=None, sales="100000.00")])
    v1 = StarV1(f, people(spark), returns(spark, []), "Vermont")
    v2 = StarV2.alongside(v1)
    tables = {**v1.tables(), **v2.tables()}
    specs = {**schemas.MODEL_V1, **schemas.MODEL_V2}
    got = audit.declared_tables({n: (tables[n], s["columns"]) for n, s in specs.items()}).collect()
    assert sum(r.rule == "not_null" for r in got) == 58 and sum(r.rule != "not_null" for r in got) == 60
    broken = {(r.table_name, r.rule, r.column_name): r.violations for r in got if r.violations}
    assert broken == {(t, rule, c): 1 for t, rule, c in [
        ("customer_dim", "not_null", "customer_name"), ("customer_dim", "type_fit:varchar(11)", "segment"),
        ("customer_dim_v2", "not_null", "customer_name"), ("customer_dim_v2", "type_fit:varchar(11)", "segment"),
        ("sales_fact", "type_fit:numeric(9,4)", "sales"), ("order_details_v2", "type_fit:numeric(9,4)", "sales")]}


def test_functional_dependency_order_with_two_destinations(spark):
    f = flat(spark, [order_line(1, order_id="A", city="Austin"), order_line(2, order_id="A", city="Dallas"),
                     order_line(3, order_id="B", postal_code=None), order_line(4, order_id="B")])
    got = _rows(audit.functional_dependency(f, "order_id", ["city", "postal_code", "region"], "orders"))
    assert got == {"city": 1, "postal_code": 0, "region": 0}


def test_join_loss_two_managers_missing_region_and_null_postal(spark):
    f = flat(spark, [order_line(1, region="West"), order_line(2, region="North"),
                     order_line(3, region="East", postal_code=None)])
    p = people(spark, [("P1", "West"), ("P2", "West"), ("P3", "East")])
    got = {r.join_name: (r.lost, r.multiplied) for r in audit.join_loss(f, {
        "manager": (p, {"region": "region"}),
        "deliver": (f.select(*DELIVER_KEY).distinct(), {c: c for c in DELIVER_KEY})}).collect()}
    assert got == {"manager": (1, 1), "deliver": (1, 0)}
