from collections import Counter

from pyspark.sql import functions as F

from starloom.operators.clean import dedup_returns, repair_postal_code, with_return_flag
from starloom.plans import reports
from starloom.plans.star import StarV1, StarV2
from starloom.schemas import FLAT_COLUMNS

from .fixtures import people, random_orders, returns


def _ms(df, cols=None):
    cols = cols or df.columns
    return Counter(tuple(r) for r in df.select(*cols).collect())


def _models(spark):
    f = random_orders(spark)
    p = people(spark)
    ids = [r.order_id for r in f.select("order_id").distinct().orderBy("order_id").collect()]
    r = returns(spark, [("Yes", i) for i in ids[::3] for _ in range(2)])
    return f, p, r, StarV1(f, p, r, "Vermont"), StarV2(f, p, r, "Vermont")


def _expected_flat(f, p, r):
    e = repair_postal_code(f, "Vermont").join(p.select("region", F.col("person").alias("manager")), "region")
    return with_return_flag(e, dedup_returns(r))


def test_flatten_v1_reproduces_the_flat_rows(spark):
    f, p, r, v1, _ = _models(spark)
    cols = FLAT_COLUMNS + ["manager", "returned"]
    assert _ms(v1.flatten(), cols) == _ms(_expected_flat(f, p, r), cols)


def test_flatten_v2_reproduces_the_flat_rows_as_multiset(spark):
    f, p, r, _, v2 = _models(spark)
    cols = [c for c in FLAT_COLUMNS if c != "row_id"] + ["manager", "returned"]
    assert _ms(v2.flatten(), cols) == _ms(_expected_flat(f, p, r), cols)


def test_report_pack_agrees_on_flat_v1_v2(spark):
    f, _, _, v1, v2 = _models(spark)
    for name, fn in reports.REPORTS.items():
        cols = reports.REPORT_COLUMNS[name]
        base = _ms(fn(f))
        assert _ms(fn(v1.view(cols))) == base, name
        assert _ms(fn(v2.view(cols))) == base, name


def test_keys_dense_unique_and_ship_offset(spark):
    _, _, _, v1, v2 = _models(spark)
    for df, key, start in [(v1.product_dim, "product_id", 1), (v1.deliver_dim, "deliver_id", 1),
                           (v1.ship_dim, "ship_id", 101), (v2.ship_dim_v2, "ship_id", 1)]:
        ids = sorted(r[0] for r in df.select(key).collect())
        assert ids == list(range(start, start + len(ids)))


def test_rebuild_is_identical(spark):
    f, p, r, v1, _ = _models(spark)
    again = StarV1(f, p, r, "Vermont")
    for name, df in v1.tables().items():
        assert _ms(df) == _ms(again.tables()[name]), name


def test_order_header_is_one_row_per_order(spark):
    f, _, _, _, v2 = _models(spark)
    h = v2.orders_v2
    assert h.count() == h.select("order_id").distinct().count() == f.select("order_id").distinct().count()


def test_identical_detail_lines_survive_as_multiset(spark):
    from .fixtures import flat, order_line
    f = flat(spark, [order_line(1, order_id="A", sales="5.00"), order_line(2, order_id="A", sales="5.00"),
                     order_line(3, order_id="B")])
    v2 = StarV2(f, people(spark), returns(spark, []), "Vermont")
    details = v2.order_details_v2.where(F.col("order_id") == "A")
    assert details.count() == 2 and details.distinct().count() == 1
    cols = [c for c in FLAT_COLUMNS if c != "row_id"]
    assert _ms(v2.flatten(), cols) == _ms(_expected_flat(f, people(spark), returns(spark, [])), cols)
