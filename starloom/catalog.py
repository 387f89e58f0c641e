"""Registry: query key -> callable(spark, sf_dir) -> DataFrame.

``sf_dir`` (through the analog views) so its work grows with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.clean import conform_orders, dedup_returns, repair_postal_code, with_return_flag
from .operators import audit
from .operators.observed import rule_rows
from .plans import marts, rental, reports
from .plans.cubes import SalesMarts
from .plans.rental import HomeFilter
from .plans.star import DELIVER_KEY, PRODUCT_KEY
from .schemas import MODEL_V1, MODEL_V2, ORDERS_SCHEMA
from .plans.star import StarV1, StarV2, build_all
from .plans.store import ModelStore
from .schemas import FLAT_COLUMNS
from .session import checkpoint_dir, materialize, shared
from .sources.files import Loaded, load_sheet
from .sources.testdata import RENTAL_TABLES, RETAIL_TABLES, VERMONT_ANALOG, TestData

Query = Callable[[SparkSession, str], DataFrame]


def _report(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(TestData(spark, sf_dir).flat_orders())
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def star_v1(spark: SparkSession, sf_dir: str, stage: bool = True) -> StarV1:
    """A model of its own; ``stage=False`` when a single table is derived."""
    td = TestData(spark, sf_dir)
    by_order = stage and td.even_orders()
    return StarV1(td.flat_orders(by_order), td.people(), td.returns(), VERMONT_ANALOG, stage=stage, by_order=by_order)


def models(spark: SparkSession, sf_dir: str) -> tuple[StarV1, StarV2]:
    """Both models over one extract.  Each of their tables is written when it is
    first read, and from then on every report and audit of the session reads it,
    as long as the input files are the same ones."""
    def build() -> tuple[StarV1, StarV2]:
        v1 = star_v1(spark, sf_dir)
        return v1, StarV2.alongside(v1)

    return shared(spark, ("models", sf_dir.rstrip("/"), TestData(spark, sf_dir).fingerprint(*RETAIL_TABLES)), build)


def built_models(spark: SparkSession, sf_dir: str) -> tuple[StarV1, StarV2]:
    """Both models with all their tables written."""
    v1, v2 = models(spark, sf_dir)
    build_all(v1, v2)
    return v1, v2


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    v1, v2 = built_models(spark, sf_dir)
    return {**v1.tables(), **v2.tables()}


def _model_report(which: int, fn, columns: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(models(spark, sf_dir)[which].view(columns))
    run.__name__ = fn.__name__
    return run


def _td(method: str) -> Query:
    return lambda spark, sf_dir: getattr(TestData(spark, sf_dir), method)()


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for key, fn in reports.REPORTS.items():
        q[key] = _report(fn)
        q[f"{key}_v1"] = _model_report(0, fn, reports.REPORT_COLUMNS[key])
        q[f"{key}_v2"] = _model_report(1, fn, reports.REPORT_COLUMNS[key])

    # sources and repairs
    q["src_flat_orders"] = lambda s, d: TestData(s, d).flat_orders().select(*FLAT_COLUMNS)
    q["src_people"] = _td("people")
    q["src_returns_dedup"] = lambda s, d: dedup_returns(TestData(s, d).returns())
    q["repair_postal_code"] = lambda s, d: repair_postal_code(TestData(s, d).flat_orders(), VERMONT_ANALOG)
    q["order_return_flag"] = lambda s, d: with_return_flag(
        TestData(s, d).flat_orders().select("order_id").distinct(), dedup_returns(TestData(s, d).returns()))
    q["conform_orders"] = lambda s, d: conform_orders(TestData(s, d).flat_orders())

    # the extract as a CSV sheet with damaged lines, loaded whole
    q["load_orders_csv"] = lambda s, d: load_orders_csv(s, d).rows
    q["load_orders_rejects"] = lambda s, d: load_orders_csv(s, d).rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))

    # v1 star
    q["dim_customer"] = lambda s, d: star_v1(s, d, stage=False).customer_dim
    q["dim_manager"] = lambda s, d: star_v1(s, d, stage=False).manager_dim
    q["dim_product"] = lambda s, d: star_v1(s, d, stage=False).product_dim
    q["dim_deliver"] = lambda s, d: star_v1(s, d, stage=False).deliver_dim
    q["dim_ship"] = lambda s, d: star_v1(s, d, stage=False).ship_dim
    q["dim_order_v1"] = lambda s, d: star_v1(s, d, stage=False).order_dim
    q["fact_sales_v1"] = lambda s, d: models(s, d)[0].sales_fact
    q["star_v1"] = lambda s, d: models(s, d)[0].row_counts()
    q["star_flatten_v1"] = lambda s, d: models(s, d)[0].flatten()
    # v2 header / detail
    q["dim_ship_v2"] = lambda s, d: StarV2.alongside(star_v1(s, d, stage=False)).ship_dim_v2
    q["order_header_v2"] = lambda s, d: models(s, d)[1].orders_v2
    q["order_detail_v2"] = lambda s, d: models(s, d)[1].order_details_v2
    q["star_v2"] = lambda s, d: models(s, d)[1].row_counts()
    q["star_flatten_v2"] = lambda s, d: models(s, d)[1].flatten()

    # A5: both models refreshed into a store and read back
    q["refresh_models"] = refresh_models

    # retail marts
    q["wide_orders"] = wide
    q["returns_count_by_year"] = lambda s, d: marts.returns_count_by_year(wide(s, d))
    q["pivot_sales_category_year"] = lambda s, d: marts.pivot_sales_category_year(
        TestData(s, d).flat_orders(), PIVOT_CATEGORIES)
    q["manager_performance"] = lambda s, d: marts.manager_performance(wide(s, d))
    q["sales_dashboard"] = lambda s, d: marts.sales_dashboard(TestData(s, d).flat_orders())

    # the same reports from the smallest written mart that covers them
    for key in MART_REPORTS:
        q[f"{key}_mart"] = lambda s, d, key=key: sales_marts(s, d).answer(key)
    q["sales_dashboard_mart"] = lambda s, d: sales_marts(s, d).dashboard()
    # one order year: the scan of the written extract lists that year's folder
    q["sales_dashboard_year"] = lambda s, d: marts.sales_dashboard(models(s, d)[0].of_year(YEAR))
    q["monthly_sales_by_category_year"] = lambda s, d: reports.monthly_sales_by_category(models(s, d)[0].of_year(YEAR))

    # audits
    q["audit_primary_keys"] = audit_primary_keys
    q["audit_orphans"] = audit_orphans
    q["audit_not_null"] = lambda s, d: declared_rules(s, d, lambda rule: rule == "not_null")
    q["audit_type_fit"] = lambda s, d: declared_rules(s, d, lambda rule: rule != "not_null")
    q["audit_order_dependency"] = lambda s, d: audit.functional_dependency(
        wide(s, d), "order_id", ORDER_ATTRIBUTES, "orders")
    q["audit_join_loss"] = audit_join_loss
    q["model_redundancy"] = model_redundancy

    # rental marts
    q["src_listings"] = _td("listings")
    q["src_reviews"] = _td("reviews")
    q["overall_rating"] = lambda s, d: rental.overall_rating(TestData(s, d).listings())
    q["reviews_per_listing"] = lambda s, d: rental.reviews_per_listing(TestData(s, d).reviews())
    q["listing_reviews"] = lambda s, d: rental.listing_review_table(*_lr(s, d))
    q["home_rating"] = lambda s, d: rental.home_rating(*_lr(s, d))
    q["home_latest_attributes"] = lambda s, d: rental.home_latest_attributes(*_lr(s, d))
    q["home_scorecard"] = lambda s, d: rental.home_scorecard(*_lr(s, d))
    q["city_rating"] = lambda s, d: rental.city_rating(TestData(s, d).listings())
    q["district_rating"] = lambda s, d: rental.district_rating(TestData(s, d).listings())
    q["home_reviews_by_year"] = lambda s, d: rental.home_reviews_by_year(*_lr(s, d))
    q["reviews_trend"] = lambda s, d: rental.reviews_trend(TestData(s, d).reviews())
    q["filter_listings"] = lambda s, d: rental.filter_homes(*_lr(s, d), FILTER_LISTINGS)
    q["drill_city"] = lambda s, d: rental.filter_homes(*_lr(s, d), DRILL_CITY)
    q["drill_city_all_years"] = lambda s, d: homes(s, d, DRILL_CITY_ALL_YEARS)
    q["top_homes"] = lambda s, d: rental.top_homes(homes(s, d, TOP_FILTER), TOP_N)
    q["top_homes_per_city"] = lambda s, d: rental.top_homes_per_city(homes(s, d, TOP_FILTER), TOP_PER_CITY)
    q["best_home"] = lambda s, d: rental.top_homes(homes(s, d, TOP_FILTER), 1)
    q["best_city"] = lambda s, d: rental.best_city(rental.city_rating(TestData(s, d).listings()))
    q["best_vs_selected_city"] = lambda s, d: rental.best_vs_selected_city(
        materialize(rental.city_rating(TestData(s, d).listings()), "cities"), SELECTED_CITY)
    q["best_vs_selected_home"] = best_vs_selected_home
    return q


# --- fixed values: default dashboard parameters ----------------------------------
SELECTED_CITY = "PROMO"
FILTER_LISTINGS = HomeFilter(year=1998, room_type="Private room", min_reviews=5, min_bedrooms=2, min_capacity=3)
DRILL_CITY = HomeFilter(year=1998, city=SELECTED_CITY, min_reviews=5, min_bedrooms=2, min_capacity=3)
DRILL_CITY_ALL_YEARS = HomeFilter(city=SELECTED_CITY, min_reviews=5, min_bedrooms=2, min_capacity=3)
TOP_FILTER = HomeFilter(min_reviews=20, min_bedrooms=2, min_capacity=3)
TOP_N = 10
DAMAGE_MODULUS = 97  # orders whose id has remainder 0, 1 or 2 have damaged lines in the CSV sheet
YEAR = 1996
MART_REPORTS = ["monthly_sales_by_segment", "monthly_sales_by_category", "sales_by_category", "sales_profit_by_customer",
                "sales_by_region"]
TOP_PER_CITY = 3


def _lr(spark: SparkSession, sf_dir: str):
    td = TestData(spark, sf_dir)
    return td.listings(), td.reviews()


# --- fixed values: pivot columns (the analog's product categories) -------------
PIVOT_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# order-level attributes that v2 moves to the header
ORDER_ATTRIBUTES = ["customer_id", "customer_name", "segment", "country", "state", "city", "postal_code",
                    "region", "order_date", "ship_date", "ship_mode", "manager", "returned"]


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    td = TestData(spark, sf_dir)
    return marts.wide_orders(td.flat_orders(), td.people(), td.returns())


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored scorecard, kept while its input files are the same ones."""
    return shared(spark, ("scorecard", sf_dir.rstrip("/"), TestData(spark, sf_dir).fingerprint(*RENTAL_TABLES)),
                  lambda: rental.stored_scorecard(*_lr(spark, sf_dir)))


def homes(spark: SparkSession, sf_dir: str, flt: HomeFilter) -> DataFrame:
    return rental.filter_homes(*_lr(spark, sf_dir), flt, scorecard(spark, sf_dir))


def best_vs_selected_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    # TOP_FILTER holds home-level thresholds only: both rows come from one scorecard
    card = scorecard(spark, sf_dir)
    return rental.best_vs_selected_home(rental.passing_homes(card, TOP_FILTER), card)


def sales_marts(spark: SparkSession, sf_dir: str) -> SalesMarts:
    """The written marts over the model's extract, kept while its input files are the same ones."""
    return shared(spark, ("marts", sf_dir.rstrip("/"), TestData(spark, sf_dir).fingerprint(*RETAIL_TABLES)),
                  lambda: SalesMarts(models(spark, sf_dir)[0].raw_staging))


def load_orders_csv(spark: SparkSession, sf_dir: str) -> Loaded:
    """The extract written as CSV lines, those of some orders damaged (the line
    ends after a few fields, its quantity is no number, or its id is empty), and
    loaded with the bad lines quarantined."""
    flat = TestData(spark, sf_dir).flat_orders()
    kind = F.col("order_id").cast("long") % DAMAGE_MODULUS
    broken = (flat.withColumn("kind", kind).withColumn("quantity", F.col("quantity").cast("string"))
              .withColumn("quantity", F.when(F.col("kind") == 1, F.lit("many")).otherwise(F.col("quantity")))
              .withColumn("row_id", F.when(F.col("kind") == 2, F.lit(None)).otherwise(F.col("row_id"))))
    line = F.to_csv(F.struct(*FLAT_COLUMNS), {"escape": '"'})
    lines = broken.select(F.when(F.col("kind") == 0, F.substring_index(line, ",", 5)).otherwise(line).alias("value"))
    path = f"{checkpoint_dir(spark)}/starloom/sheet-{uuid.uuid4().hex}.csv"
    lines.write.text(path, compression="gzip")  # a task reads what a task wrote
    return load_sheet(spark, path, ORDERS_SCHEMA, header=False)


def refresh_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: both models written as a new generation of a store, published, read
    back as typed tables and counted, with the declared rules that rows break."""
    td = TestData(spark, sf_dir)
    store = ModelStore(spark, f"{checkpoint_dir(spark)}/starloom/store-{uuid.uuid4().hex}")
    by_order = td.even_orders()
    store.refresh(td.flat_orders(by_order), td.people(), td.returns(), VERMONT_ANALOG, td.fingerprint(*RETAIL_TABLES),
                  by_order=by_order)
    return store.counts()


def declared_rules(spark: SparkSession, sf_dir: str, wanted: Callable[[str], bool]) -> DataFrame:
    """J3/J4 of the extract and both models, as counted when they were written."""
    v1, v2 = built_models(spark, sf_dir)
    return rule_rows(spark, v1.watched | v2.watched, wanted)


def audit_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {**model_tables(spark, sf_dir), "people": TestData(spark, sf_dir).people()}
    keys = {name: spec["pk"] for name, spec in {**MODEL_V1, **MODEL_V2}.items()}
    keys["people"] = ["person"]
    return audit.primary_keys(tables, keys)


def audit_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    fks = [(child, cols, parent, pcols)
           for child, spec in {**MODEL_V1, **MODEL_V2}.items() for cols, parent, pcols in spec["fk"]]
    return audit.orphans(model_tables(spark, sf_dir), fks)


def audit_join_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    v1 = models(spark, sf_dir)[0]
    raw = v1.raw_staging
    lines = repair_postal_code(raw.withColumn("raw_postal_code", F.col("postal_code")), VERMONT_ANALOG)
    deliver = {c: c for c in DELIVER_KEY}
    return audit.join_loss(lines, {
        "product": (v1.product_dim, {c: c for c in PRODUCT_KEY}),
        "deliver": (v1.deliver_dim, deliver),
        "ship": (v1.ship_dim, {"ship_mode": "ship_mode"}),
        "manager": (v1.people, {"region": "region"}),
        "returns_raw": (TestData(spark, sf_dir).returns(), {"order_id": "order_id"}),
        "deliver_unrepaired": (raw.select(*DELIVER_KEY).distinct(), deliver | {"postal_code": "raw_postal_code"}),
    })


def model_redundancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    v1, v2 = models(spark, sf_dir)
    return audit.model_redundancy({"v1": ("sales_fact", v1.sales_fact), "v2": ("orders_v2", v2.orders_v2)})
