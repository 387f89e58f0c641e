import pytest

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom import catalog
from starloom.functions import half_up_div, percent_label, scaled_decimal
from starloom.operators.clean import dedup_returns, with_return_flag
from starloom.operators.keys import dense_key
from starloom.plans import star

from .conftest import SF_SMALL
from .fixtures import flat, order_line, returns


def test_half_up_div_away_from_zero_and_zero_denominator(spark):
    from decimal import Decimal as D
    rows = [(5, 2), (-5, 2), (4, 3), (-4, 3), (7, 0), (None, 3), (10 ** 30 + 5 * 10 ** 27, 10 ** 28)]
    rows = [(None if n is None else D(n), D(d)) for n, d in rows]
    df = spark.createDataFrame(rows, "n decimal(38,0), d decimal(38,0)")
    got = [r.q for r in df.select(half_up_div("n", "d").alias("q")).collect()]
    assert got == [3, -3, 1, -1, None, None, 101]
    big = spark.createDataFrame([(D(10 ** 30), D(7))], "n decimal(38,0), d decimal(38,0)")
    with pytest.raises(Exception, match="does not fit in bigint"):
        big.select(half_up_div("n", "d")).collect()


def test_scaled_decimal_and_label(spark):
    df = spark.createDataFrame([(2997,), (None,)], "u long")
    got = [(r.v, r.l) for r in df.select(scaled_decimal(F.col("u"), 3, 12).alias("v"))
           .select("v", percent_label(F.col("v"), 3).alias("l")).collect()]
    assert [str(v) if v is not None else None for v, _ in got] == ["2.997", None]
    assert [lbl for _, lbl in got] == ["2.997%", "%"]


keys = st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="aAbB", min_size=0, max_size=3)),
                          st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys)
def test_dense_keys_of_random_rows(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int")
    one = sorted(tuple(r) for r in dense_key(df, ["a", "b"], "id").collect())
    # binary string order, nulls last
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0))
    assert [r[1:] for r in one] == order
    assert sorted(r[0] for r in one) == list(range(1, len(set(rows)) + 1))


def test_hot_order_join_is_split_by_aqe(spark):
    # one order holds a third of the lines; with broadcast off the return-flag
    # join is a sort-merge join whose hot partition AQE splits (the returns
    # side is a written lookup, so both sides are plain shuffles)
    rows = [order_line(i, order_id="HOT" if i % 3 == 0 else f"O{i}") for i in range(3000)]
    lines = flat(spark, rows)
    r = dedup_returns(returns(spark, [("Yes", "HOT")] + [("Yes", f"O{i}") for i in range(1, 3000, 7)]))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = with_return_flag(lines, r, lines=True)
        assert out.where(F.col("returned") == "Yes").where(F.col("order_id") == "HOT").count() == 1000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_small_dimensions_are_broadcast(spark, monkeypatch):
    # the query returns the written fact; the joins are in the frame that is written
    frames, real = {}, star.materialize
    monkeypatch.setattr(star, "materialize", lambda df, tag, **how: (frames.update({tag: df}), real(df, tag, **how))[1])
    fact = catalog.star_v1(spark, SF_SMALL).sales_fact
    df = frames["sales_fact"]
    assert sorted(df.collect()) == sorted(fact.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3
    assert "CartesianProduct" not in plan
