"""Driver contract, oracle agreement on the smallest scale, and plan shape."""

import decimal
import os
import re
from collections import Counter
from urllib.parse import urlparse

import duckdb
import pytest

import __spark_entry__ as se
from starloom import catalog
from starloom.plans import star
from starloom.session import checkpoint_dir, release

from .conftest import SF_SMALL

PLAN_SAMPLE = ["sales_by_region", "customer_ranking", "manager_performance", "top_homes", "top_homes_per_city",
               "best_vs_selected_city", "audit_orphans", "home_scorecard", "returns_count_by_year"]
ORACLE_SAMPLE = ["total_sales", "profit_ratio", "avg_discount", "customer_ranking", "dim_product", "fact_sales_v1",
                 "order_header_v2", "star_flatten_v2", "manager_performance", "audit_type_fit", "audit_join_loss", "audit_not_null",
                 "home_scorecard", "filter_listings", "top_homes_per_city", "best_vs_selected_home"]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month", "segment", "total_sales"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(se.oracle_sql()) <= set(se.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLAN_SAMPLE)
def test_no_cartesian_or_nested_loop(spark, key):
    plan = _plan(se.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_topk_plans(spark):
    q = se.queries()
    assert "TakeOrderedAndProject" in _plan(q["top_homes"](spark, SF_SMALL))
    q["top_homes_per_city"](spark, SF_SMALL).collect()
    plan = q["top_homes_per_city"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("key", ["wide_orders", "manager_performance", "star_flatten_v1", "star_flatten_v2"])
def test_lines_are_not_planned_to_shuffle_on_a_few_values(spark, key):
    plan = _plan(se.queries()[key](spark, SF_SMALL))
    assert "isFinalPlan=false" in plan, "the plan before anything ran"
    assert not re.search(r"hashpartitioning\((region|ship_mode|ship_id|r_name)#", plan)


def test_the_fact_is_not_planned_to_shuffle_on_a_few_values(spark, monkeypatch):
    plans = {}
    real = star.materialize

    def spy(df, tag, **how):
        plans[tag] = _plan(df)
        return real(df, tag, **how)

    monkeypatch.setattr(star, "materialize", spy)
    v1 = catalog.star_v1(spark, SF_SMALL)
    v2 = star.StarV2.alongside(v1)
    v1.tables(), v2.tables()
    for name in ["sales_fact", "orders_v2", "order_details_v2"]:
        assert "Join" in plans[name]
        assert not re.search(r"hashpartitioning\((region|ship_mode)#", plans[name]), name


def test_reports_share_one_written_model(spark):
    release(spark)
    for key in ["total_sales_v1", "sales_by_region_v2", "sales_by_category_v1", "model_redundancy", "star_v2"]:
        se.queries()[key](spark, SF_SMALL).collect()
    written = Counter(f.rpartition("-")[0] for f in os.listdir(os.path.join(urlparse(checkpoint_dir(spark)).path, "starloom")))
    for name in ["stg_orders", "keysets", "product", "deliver", "ship", "people", "sales_fact", "orders_v2"]:
        assert written[name] == 1, (name, written)
    release(spark)
    assert se.queries()["total_sales_v1"](spark, SF_SMALL).collect() == se.queries()["total_sales"](spark, SF_SMALL).collect()


def test_report_scan_is_pruned(spark):
    plan = _plan(se.queries()["sales_by_region"](spark, SF_SMALL))
    line_scan = [s for s in plan.split("\n") if "lineitem.parquet" in s]
    assert len(line_scan) == 1, "ship date join should be pruned: one lineitem scan"
    assert "l_shipdate" not in line_scan[0] and "l_discount" not in line_scan[0]


def _norm(v):
    if isinstance(v, (decimal.Decimal, int)) and not isinstance(v, bool):
        return decimal.Decimal(v).normalize()
    return v


@pytest.mark.parametrize("key", ORACLE_SAMPLE)
def test_matches_duckdb_oracle(spark, key):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    sdf = se.queries()[key](spark, SF_SMALL)
    cur = con.execute(se.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)
    s = Counter(tuple(_norm(r[c]) for c in order) for r in sdf.collect())
    d = Counter(tuple(_norm(dict(zip(dcols, r))[c]) for c in order) for r in cur.fetchall())
    assert s == d
