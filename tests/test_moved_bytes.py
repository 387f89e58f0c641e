"""What moves between tasks, and what is written, stays as small as the job allows."""

import os
from collections import Counter
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from starloom import catalog
from starloom.operators import audit
from starloom.operators.clean import fit_violation
from starloom.operators.observed import _breach
from starloom.plans import marts, star
from starloom.session import checkpoint_dir, materialize
from starloom.sources.testdata import TestData

from .conftest import SF_SMALL
from .fixtures import people, random_orders, returns


@pytest.fixture()
def unbroadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _joins(df) -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if "Join " in line]


def _executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_fact_meets_its_products_with_ids_of_the_other_dimensions(spark, monkeypatch):
    frames, real = {}, star.materialize
    monkeypatch.setattr(star, "materialize", lambda df, tag, **how: (frames.update({tag: df}), real(df, tag, **how))[1])
    catalog.star_v1(spark, SF_SMALL).sales_fact
    outermost, *inner = _joins(frames["sales_fact"])
    assert "product_name" in outermost and not any("product_name" in line for line in inner)


def test_lines_meet_their_orders_before_they_are_shuffled_for_customers(spark, unbroadcast):
    f = random_orders(spark)
    v1 = star.StarV1(f, people(spark), returns(spark, []), "Vermont")
    for columns in (["order_date", "segment", "sales"], ["order_date", "product_name", "segment", "returned", "sales"]):
        assert "Exchange hashpartitioning(order_id" not in _executed(v1.view(columns))


def test_a_flattened_model_takes_up_the_dimensions_of_few_rows_last(spark):
    v1 = star.StarV1(random_orders(spark), people(spark), returns(spark, []), "Vermont")
    on = [next(key for key in ("ship_id", "region", "deliver_id", "product_id", "customer_id", "order_id") if f"({key}#" in line)
          for line in _joins(v1.flatten())]
    assert set(on[:3]) == {"ship_id", "region", "deliver_id"}


def test_texts_that_are_no_int_are_told_without_a_failing_cast(spark):
    texts = ["1", " 1 ", "\t-7\n", "+3", "1.0", "1-2", "", " ", "abc", "2147483647", "2147483648", "-2147483648", "0001", "1 2", "--1",
             "\x007\x7f", "7\x85", "٣", "1e3", " 7", "7\r\n", "+", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cheap = _breach(df, "type_fit:int", "t", "int", F.coalesce(fit_violation("t", "int"), F.lit(False)))
    rows = df.select("t", F.coalesce(cheap, F.lit(False)).alias("cheap"), F.coalesce(fit_violation("t", "int"), F.lit(False)).alias("cast"))
    assert all(r.cheap == r.cast for r in rows.collect()), [r for r in rows.collect() if r.cheap != r.cast]
    assert "rlike" in _executed(df.select(cheap.alias("c"))).lower()


def test_written_tables_are_compressed_well(spark):
    for layout in ({}, {"bucket_by": ["id"]}):
        table = materialize(spark.range(1000).selectExpr("CAST(id AS STRING) AS id"), "codec", **layout)
        assert all(".zstd." in f for f in table.inputFiles())


def test_children_are_counted_per_foreign_key_before_they_move(spark, unbroadcast):
    child = spark.createDataFrame([("a",)] * 50 + [("b",)] * 3 + [(None,)] * 4, "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "p string")
    got = audit.orphans({"child": child, "parent": parent}, [("child", ["k"], "parent", ["p"])])
    assert [(r.checked_rows, r.violations) for r in got.collect()] == [(53, 3)]
    assert "HashAggregate(keys=[k#" in _executed(got)
    none = audit.orphans({"child": child.where("false"), "parent": parent}, [("child", ["k"], "parent", ["p"])])
    assert [(r.checked_rows, r.violations) for r in none.collect()] == [(0, 0)]


def test_join_loss_moves_counts_of_keys_only(spark, unbroadcast):
    lines = spark.createDataFrame([("a", "x")] * 40 + [("b", "y")] * 2 + [(None, "x")], "k string, v string")
    once = spark.createDataFrame([("a",), ("c",)], "k string")
    twice = spark.createDataFrame([("x",), ("x",), (None,)], "w string")
    got = audit.join_loss(lines, {"once": (once, {"k": "k"}), "twice": (twice, {"w": "v"})})
    assert {tuple(r) for r in got.collect()} == {("once", 43, 3, 0, 40), ("twice", 43, 2, 41, 82)}
    plan = _executed(got)
    assert "HashAggregate(keys=[k#" in plan and "HashAggregate(keys=[v#" in plan
    empty = audit.join_loss(lines.where("false"), {"once": (once, {"k": "k"})})
    assert [tuple(r) for r in empty.collect()] == [("once", 0, 0, 0, 0)]


def test_managers_join_the_wide_lines_last(spark):
    wide = marts.wide_orders(random_orders(spark), people(spark), returns(spark, []))
    assert "region" in _joins(wide)[0]


def test_the_sheet_is_written_compressed(spark):
    scratch = os.path.join(urlparse(checkpoint_dir(spark)).path, "starloom")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert catalog.load_orders_csv(spark, SF_SMALL).rejects.count() > 0
    sheets = [d for d in set(os.listdir(scratch)) - before if d.endswith(".csv")]
    parts = [f for d in sheets for f in os.listdir(os.path.join(scratch, d)) if f.startswith("part-")]
    assert parts and all(f.endswith(".gz") for f in parts)


def test_orders_and_lines_are_made_of_the_extract_where_it_lies(spark, unbroadcast, monkeypatch):
    frames, real = {}, star.materialize
    monkeypatch.setattr(star, "materialize", lambda df, tag, **how: (frames.update({tag: df}), real(df, tag, **how))[1])
    v1 = catalog.star_v1(spark, SF_SMALL)
    v2 = star.StarV2.alongside(v1)
    star.build_all(v1, v2)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    extract = _executed(frames["stg_orders"].repartition(buckets, "order_id"))
    assert "REPARTITION_BY" not in extract and extract.count("lineitem.parquet") == 1
    # dimensions of few rows are broadcast; what moves are the returns only
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    for name, moved in {"sales_fact": 0, "order_details_v2": 0, "order_dim": 1, "orders_v2": 1}.items():
        assert _executed(frames[name].repartition(buckets, "order_id")).count("Exchange hashpartitioning") == moved, name
    for table in (v1.sales_fact, v2.order_details_v2, v1.order_dim, v2.orders_v2):
        files = table.inputFiles()
        assert len({f.rpartition("_")[2].partition(".")[0] for f in files}) == len(files) <= buckets
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_the_extract_hashed_by_order_has_the_same_rows(spark):
    td = TestData(spark, SF_SMALL)
    assert td.even_orders()
    hashed, plain = td.flat_orders(hashed_by_id=True), td.flat_orders()
    assert hashed.schema.simpleString() == plain.schema.simpleString()
    assert Counter(map(tuple, hashed.collect())) == Counter(map(tuple, plain.collect()))


def test_an_extract_with_a_hot_order_is_not_held_in_one_bucket(spark, tmp_path):
    for name in os.listdir(SF_SMALL):
        if name != "lineitem.parquet":
            os.symlink(os.path.join(SF_SMALL, name), tmp_path / name)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    order = spark.read.parquet(f"{SF_SMALL}/orders.parquet").agg(F.min("o_orderkey")).first()[0]
    hot = F.when(F.col("l_partkey") % 8 > 0, F.lit(order)).otherwise(F.col("l_orderkey")).cast(lines.schema["l_orderkey"].dataType)
    lines.withColumn("l_orderkey", hot).write.parquet(str(tmp_path / "lineitem.parquet"))
    td = TestData(spark, str(tmp_path))
    assert not td.even_orders()
    v1 = catalog.star_v1(spark, str(tmp_path))
    flat = Counter(map(tuple, td.flat_orders().collect()))
    assert Counter(map(tuple, v1.raw_staging.drop(star.ORDER_YEAR).collect())) == flat
    assert Counter(map(tuple, v1.staging_by_order.collect())) == Counter(map(tuple, v1.staging.collect()))
    assert v1._bucketed is None and v1.sales_fact.count() == sum(flat.values())
