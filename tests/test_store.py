"""A5 as a store of generations; snapshots follow their input files; rules counted by the writes."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from starloom import catalog
from starloom.operators import audit
from starloom.operators.observed import Watched, rule_rows
from starloom.plans import star
from starloom.plans.star import StarV1, StarV2, build_all
from starloom.plans.store import ModelStore, RefusedRefresh
from starloom.schemas import MODEL_V1, MODEL_V2, ORDER_COLUMNS
from starloom.session import materialize
from starloom.sources.listing import listing_fingerprint

from .conftest import SF_SMALL
from .fixtures import flat, order_line, people, random_orders, returns


def _counts(store):
    return {n: df.count() for n, df in store.tables().items()}


def _refresh(spark, store, n_orders, **how):
    f = random_orders(spark, n_orders=n_orders)
    return store.refresh(f, people(spark), returns(spark, []), "Vermont", **how)


def test_readers_see_the_newest_whole_generation(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    assert store.generation() is None and store.tables() == {}
    assert _refresh(spark, store, 10) == 1
    first, held = _counts(store), store.tables()["order_dim"]
    assert set(first) == {*MODEL_V1, *MODEL_V2} and first["order_dim"] == first["orders_v2"] == 10
    assert _refresh(spark, store, 25) == 2
    assert _counts(store)["order_dim"] == 25
    assert held.count() == 10, "a reader that has begun keeps its generation"
    assert store.tables(1)["order_dim"].count() == 10
    for r in store.counts().collect():
        assert r.row_count == r.written_rows


@pytest.mark.parametrize("dies_at", ["stg_orders", "order_dim", "sales_fact", "order_details_v2"])
def test_a_refresh_that_dies_between_tables_changes_nothing(spark, tmp_path, monkeypatch, dies_at):
    store = ModelStore(spark, str(tmp_path / "store"))
    _refresh(spark, store, 10)
    before, real = _counts(store), star.materialize

    def dies(df, tag, **how):
        if tag == dies_at:
            raise OSError("disk gone")
        return real(df, tag, **how)

    with monkeypatch.context() as m:
        m.setattr(star, "materialize", dies)
        with pytest.raises(OSError):
            _refresh(spark, store, 25)
    assert store.generation() == 1 and _counts(store) == before
    left = [d for d in os.listdir(tmp_path / "store" / "data") if d.startswith("00000002")]
    assert bool(left) == (dies_at != "stg_orders")
    assert _refresh(spark, store, 30) == 2, "rerunning is safe"
    assert _counts(store)["order_dim"] == 30
    assert set(store.vacuum(keep=1)) == {d for d in left} | {d for d in store_folders(store, 1)}
    assert _counts(store)["order_dim"] == 30


def store_folders(store, number):
    return {r.place.split("/")[-2] for r in store._rows(number)}


def test_unchanged_input_keeps_the_generation(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    assert _refresh(spark, store, 10, source="a") == 1
    assert _refresh(spark, store, 10, source="a") == 1
    assert _refresh(spark, store, 10, source="b") == 2


def test_broken_rules_can_refuse_a_refresh(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    bad = flat(spark, [order_line(1), order_line(2, customer_name=None, segment="S" * 12)])
    with pytest.raises(RefusedRefresh, match="customer_dim: 1 nulls, 1 misfits"):
        store.refresh(bad, people(spark), returns(spark, []), "Vermont", enforce=True)
    assert store.generation() is None
    assert store.refresh(flat(spark, [order_line(1)]), people(spark), returns(spark, []), "Vermont", enforce=True) == 1


def test_tables_have_their_declared_types(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    _refresh(spark, store, 10)
    (row,) = [r for r in store._rows(1) if r.table_name == "order_dim"]
    described = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE {store._register(row)}").collect()}
    assert described["order_id"] == ("varchar(14)", "varchar(14)") and described["order_date"] == ("date", "date")
    assert described["returned"] == ("varchar(3)", "varchar(3)")


def test_two_refreshes_at_once_publish_one(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "store"))
    _refresh(spark, store, 10)
    other = spark.read.parquet(f"{store.path}/manifest").withColumn("run", F.lit("zz")).withColumn("row_count", F.lit(7).cast("long"))
    materialize(other, "clash").coalesce(1).write.mode("append").parquet(f"{store.path}/manifest")
    assert store.manifest().count() == len(MODEL_V1) + len(MODEL_V2)
    assert {r.run for r in store.manifest().collect()} == {"zz"}


# snapshots follow their input

def test_fingerprint_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    first = listing_fingerprint(spark, [path])
    assert first == listing_fingerprint(spark, [path])
    spark.range(10).write.mode("append").parquet(path)
    second = listing_fingerprint(spark, [path])
    assert second != first
    (part, *_) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    os.utime(os.path.join(path, part), (1, 1))
    assert listing_fingerprint(spark, [path]) != second


def test_model_reports_see_a_changed_table(spark, tmp_path):
    folder = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, folder)
    os.chmod(folder, 0o755)
    q = se.queries()
    keys = ["total_sales", "total_sales_v1", "total_sales_v2", "sales_by_category_mart", "top_homes"]
    before = {k: q[k](spark, folder).collect() for k in keys}
    assert before["total_sales"] == before["total_sales_v1"] == before["total_sales_v2"]
    half = materialize(spark.read.parquet(f"{folder}/lineitem.parquet").where("l_orderkey % 2 = 0"), "half")
    os.chmod(f"{folder}/lineitem.parquet", 0o644)
    os.remove(f"{folder}/lineitem.parquet")
    half.write.parquet(f"{folder}/lineitem.parquet")
    after = {k: q[k](spark, folder).collect() for k in keys}
    assert after["total_sales"] == after["total_sales_v1"] == after["total_sales_v2"] != before["total_sales"]
    assert sorted(after["sales_by_category_mart"]) == sorted(q["sales_by_category"](spark, folder).collect())
    assert after["top_homes"] != before["top_homes"]
    assert q["audit_type_fit"](spark, folder).where("table_name = 'sales_fact'").first().checked_rows == half.count()


# rules counted by the writes

def test_observed_rules_equal_a_scan(spark):
    lines = [order_line(i, order_id=f"O{i % 7}", city="X" * (15 + i % 5), customer_name=None if i % 6 == 0 else "A",
                        sales="100000.00" if i % 4 == 0 else "1.00") for i in range(50)]
    f = flat(spark, lines)
    v1 = StarV1(f, people(spark), returns(spark, []), "Vermont")
    v2 = StarV2.alongside(v1)
    build_all(v1, v2)
    tables = {"orders": (f, ORDER_COLUMNS), **{n: ({**v1.tables(), **v2.tables()}[n], s["columns"])
                                             for n, s in {**MODEL_V1, **MODEL_V2}.items()}}
    want = {tuple(r) for r in audit.declared_tables(tables).collect()}
    got = {tuple(r) for r in rule_rows(spark, v1.watched | v2.watched, lambda rule: True).collect()}
    assert got == want and any(r[4] for r in got)


def test_an_empty_write_counts_nothing(spark):
    watched = Watched([("a", "varchar(2)", False)])
    materialize(spark.createDataFrame([], "a string"), "none", watch=watched.watch)
    assert watched.rules("t") == [("not_null", "t", "a", 0, 0), ("type_fit:varchar(2)", "t", "a", 0, 0)]


# layout

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_meet_their_orders_without_an_exchange(spark, no_broadcast):
    v1, v2 = catalog.built_models(spark, SF_SMALL)
    for df in (v1.view(["order_date", "sales"]), v2.view(["order_date", "sales"])):
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert "hashpartitioning(order_id" not in plan
    assert not re.search(r"hashpartitioning\(order_id", _plan(v2.flatten()))


def test_a_hot_order_is_split_by_the_join(spark, no_broadcast):
    f = flat(spark, [order_line(i, order_id="HOT" if i % 3 else f"O{i}") for i in range(600)])
    v1 = StarV1(f, people(spark), returns(spark, []), "Vermont")
    v2 = StarV2.alongside(v1)
    for df in (v1.view(["order_date", "sales"]), v2.view(["order_date", "sales"])):
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning(order_id") == 2, "both sides shuffled, so a hot order can be split"
        assert df.count() == 600


def test_a_year_reads_its_folder_only(spark):
    v1, _ = catalog.models(spark, SF_SMALL)
    year = v1.of_year(1996)
    assert "PartitionFilters: [isnotnull(order_year" in re.sub(r"#\d+", "", _plan(year))
    assert year.count() == v1.raw_staging.where(F.year("order_date") == 1996).count() > 0
    assert {f.split("order_year=")[1].split("/")[0] for f in v1.raw_staging.inputFiles()} >= {"1996", "1997"}
    read = {r[0] for r in year.select(F.input_file_name()).distinct().collect()}
    assert read and all("order_year=1996" in f for f in read)
