"""H1 / H2: full-refresh builds of the two dimensional models.

v1 (star): customer_dim, manager_dim, deliver_dim, order_dim, product_dim,
ship_dim and sales_fact.  v2 (header/detail): ship_dim_v2, product_dim_v2,
deliver_dim_v2, customer_dim_v2, orders_v2, order_details_v2.

Plan shape:
  * the flat table is written once to the shared checkpoint folder; B1 is a
    projection over it, and every dimension and the fact read it from there
    (column pruned);
  * surrogate keys come from the dense-key operator (2.7); the natural-key
    sets of all numbered dimensions of both models are computed in one
    GROUPING SETS pass over staging and written once;
  * every table is written and read back, dimensions and people first, then the
    fact, header and details; so the size of a small side is that of its own
    files, known when the join is planned, and reports read tables;
  * the extract is written in a folder per order year; orders and lines are
    bucketed by order, so they join without an exchange (unless one order has
    more lines than a bucket should hold);
  * an extract that comes hashed by order (``by_order``) is written in the
    same buckets, so orders and lines are made of it where they lie;
  * each write counts its table's declared rules (J3, J4) on the way;
  * natural keys are resolved with plain equi joins; Spark broadcasts a
    dimension only when its file size is under the threshold, otherwise
    shuffle-joins it (skewed keys split by AQE);
  * returns are deduplicated before any join (decision 1), so no fan-out.
Tables are built on first access and once per model object, so a report that
needs only the fact and one dimension does not build the rest.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import dedup_returns, repair_postal_code, with_return_flag
from ..operators.joins import lookup_join
from ..operators.keys import dense_key, dense_keys
from ..operators.observed import Watched
from ..schemas import FLAT_COLUMNS, MODEL_V1, MODEL_V2, ORDER_COLUMNS
from ..session import checkpoint_dir, concurrently, materialize

# --- fixed values of the reference models -------------------------------------
PRODUCT_KEY = ["product_name", "category", "subcategory"]
DELIVER_KEY = ["country", "state", "city", "postal_code", "region"]
CUSTOMER_COLS = ["customer_id", "customer_name", "segment"]
SHIP_ID_OFFSET_V1 = 100          # v1 numbers ship modes from 101; v2 from 1
FACT_COLUMNS = ["row_id", "ship_id", "sales", "quantity", "discount", "profit", "order_id",
                "product_id", "customer_id", "deliver_id"]
# every numbered dimension of both models, built from one pass over staging
KEY_SPECS = {
    "product": (PRODUCT_KEY, "product_id", 0),
    "deliver": (DELIVER_KEY, "deliver_id", 0),
    "ship": (["ship_mode"], "ship_id", SHIP_ID_OFFSET_V1),
    "ship_v2": (["ship_mode"], "ship_id", 0),
}
HEADER_COLUMNS = ["order_id", "order_date", "ship_date", "manager", "returned", "ship_id",
                  "deliver_id", "customer_id"]
DETAIL_COLUMNS = ["sales", "quantity", "profit", "discount", "product_id", "order_id"]


# --- fixed values: column of the extract's order year, and what each written table is declared as
ORDER_YEAR = "order_year"
EXTRA = ["__lines"]
DECLARED = {
    "stg_orders": ("orders",), "customers": ("customer_dim", "customer_dim_v2"), "people": ("manager_dim",),
    "product": ("product_dim", "product_dim_v2"), "deliver": ("deliver_dim", "deliver_dim_v2"),
    "ship": ("ship_dim",), "ship_v2": ("ship_dim_v2",), "order_dim": ("order_dim",), "sales_fact": ("sales_fact",),
    "orders_v2": ("orders_v2",), "order_details_v2": ("order_details_v2",)}
SPECS = {"orders": ORDER_COLUMNS, **{n: s["columns"] for n, s in {**MODEL_V1, **MODEL_V2}.items()}}


class _Model:
    def __init__(self, flat: DataFrame, people: DataFrame, returns: DataFrame, repair_state: str,
                 stage: bool = True, folder: str | None = None, by_order: bool = False):
        """``stage=False`` when one table is derived: nothing is shared, so
        neither the extract nor the table is written.  ``folder``: where the
        tables are written (default: the checkpoint folder).  ``by_order``: ``flat``
        comes hashed by order_id, and no bucket of orders is far above the average."""
        self._flat = flat
        self._people = people
        self._returns = returns
        self._repair_state = repair_state
        self._stage = stage
        self._folder = folder
        self._by_order_id = by_order
        self._watched: dict[str, Watched] = {}  # declared table -> counts of its write
        self._layout: dict[str, Sequence[str]] = {}  # written table -> columns that its buckets hash

    _shared: "_Model | None" = None
    _bucketed: DataFrame | None = None

    def _table(self, name: str, df: DataFrame, extra: dict[str, Column] | None = None, **layout) -> DataFrame:
        """The table, written; its declared rules (and ``extra`` metrics over
        columns of ``df`` beyond the declared ones) are counted by the write."""
        if not self._stage:
            return df.drop(*EXTRA)
        if name not in DECLARED:
            return materialize(df, name, folder=self._folder, **layout)
        watched = Watched(SPECS[DECLARED[name][0]], extra or {}, [c for c in df.columns if c not in EXTRA])
        written = materialize(df, name, folder=self._folder, watch=watched.watch, **layout)
        self._watched.update(dict.fromkeys(DECLARED[name], watched))
        self._layout[name] = layout.get("bucket_by", ())
        return written

    @property
    def watched(self) -> dict[str, Watched]:
        """Counts of the writes so far, by declared table."""
        return (self._shared.watched if self._shared is not None else {}) | self._watched

    @cached_property
    def raw_staging(self) -> DataFrame:
        """The flat extract as loaded, written once to the shared folder, a
        subfolder per order year."""
        if self._shared is not None:
            return self._shared.raw_staging
        if not self._stage:
            return self._flat
        by_year = self._flat.withColumn(ORDER_YEAR, F.year("order_date"))
        if not self._by_order_id:
            return self._table("stg_orders", by_year, partition_by=[ORDER_YEAR])
        spark = by_year.sparkSession
        path = (os.path.join(self._folder, "stg_orders") if self._folder
                else os.path.join(checkpoint_dir(spark), "starloom", f"stg_orders-{uuid.uuid4().hex}"))
        self._bucketed = self._table("stg_orders", by_year, path=path, partition_by=[ORDER_YEAR], bucket_by=["order_id"])
        return spark.read.parquet(path)  # its size and its splits are those of the files

    @cached_property
    def staging_by_order(self) -> DataFrame:
        """``staging`` as it lies in its buckets by order, if it does."""
        if self._shared is not None:
            return self._shared.staging_by_order
        raw = self.raw_staging
        return repair_postal_code(raw if self._bucketed is None else self._bucketed.select(*raw.columns), self._repair_state)

    def of_year(self, year: int) -> DataFrame:
        """The written extract's lines of one order year: the scan lists that year's folder only."""
        return self.raw_staging.where(F.col(ORDER_YEAR) == year).select(*FLAT_COLUMNS)

    @cached_property
    def staging(self) -> DataFrame:
        """B1 applied as a projection over the written extract: the raw and the
        repaired table share one snapshot."""
        return repair_postal_code(self.raw_staging, self._repair_state)

    @cached_property
    def keyed(self) -> dict[str, DataFrame]:
        """Numbered dimensions of both models from one GROUPING SETS pass, each a
        written table."""
        numbered = dense_keys(self.staging, KEY_SPECS)
        written = concurrently([lambda n=n, df=df: self._table(n, df) for n, df in numbered.items()])
        return dict(zip(numbered, written))

    def _numbered(self, name: str) -> DataFrame:
        if self._shared is not None:
            return self._shared._numbered(name)
        return self.keyed[name] if self._stage else dense_key(self.staging, *KEY_SPECS[name])

    @cached_property
    def _managers(self) -> DataFrame:
        """Region and manager, as the people sheet has them."""
        if self._shared is not None:
            return self._shared._managers
        return self._table("people", self._people.select("region", F.col("person").alias("manager")))

    @cached_property
    def people(self) -> DataFrame:
        return self._managers.select(F.col("manager").alias("person"), "region")

    @cached_property
    def returns_dedup(self) -> DataFrame:
        return dedup_returns(self._returns)

    @cached_property
    def _customers(self) -> DataFrame:
        if self._shared is not None:
            return self._shared._customers
        return self._table("customers", self.staging.select(*CUSTOMER_COLS).distinct())

    def _by_order(self, name: str, df: DataFrame) -> DataFrame:
        """A table of one row per order, with its number of lines in ``__lines``:
        bucketed by order, the largest number of lines observed."""
        lines = F.col("__lines")
        return self._table(name, df, {"most": F.max(lines), "all": F.sum(lines)}, bucket_by=["order_id"])

    def _is_hot(self, name: str) -> bool:
        """Whether one order has more lines than an average bucket.  Lines are then
        not bucketed by order: a join can split a hot order across tasks only
        where both sides are shuffled for it.  Known from any written table of orders."""
        watched = self.watched.get("order_dim") or self.watched[name]
        return watched.metric("most") * self.buckets > watched.metric("all")

    def _lines(self, name: str, df: DataFrame, orders_name: str) -> DataFrame:
        """A table of order lines, in the buckets of its table of orders."""
        if not self._stage:
            return df
        if not {"order_dim", orders_name} & set(self.watched):
            getattr(self, orders_name)
        return self._table(name, df, bucket_by=() if self._is_hot(orders_name) else ["order_id"])

    def _with_orders(self, lines: DataFrame, name: str, orders: DataFrame) -> DataFrame:
        """Lines joined to the table of orders ``name``."""
        if not self._stage or not self._is_hot(name):
            return lines.join(orders, "order_id")
        return lookup_join(lines, orders, ["order_id"], "inner", name)

    def build(self, phases: int | None = None) -> "_Model":
        """Write all tables (of the first phases), independent ones at the same time."""
        plan = self.BESIDE_V1 if "order_dim" in self.watched else self.PHASES
        for phase in plan[:phases]:
            concurrently([lambda n=n: getattr(self, n) for n in phase])
        return self

    def layout(self, written: str) -> Sequence[str]:
        """The columns whose hash buckets a written table."""
        shared = self._shared.layout(written) if self._shared is not None else ()
        return self._layout.get(written, shared)

    @property
    def buckets(self) -> int:
        return int(self._flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    PHASES: Sequence[Sequence[str]] = ()

    @property
    def BESIDE_V1(self) -> Sequence[Sequence[str]]:
        return self.PHASES

    def tables(self) -> dict[str, DataFrame]:
        raise NotImplementedError

    def row_counts(self) -> DataFrame:
        """One row per table: table_name, row_count."""
        parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
                 for name, df in self.build().tables().items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def write(self, path: str) -> None:
        """One Parquet directory per table, overwritten in place; for a refresh
        that readers see whole or not at all use ``plans.store.ModelStore``."""
        for name, df in self.tables().items():
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


class StarV1(_Model):
    PHASES = (("raw_staging",), ("keyed", "_customers", "_managers", "order_dim"), ("sales_fact",))

    @cached_property
    def customer_dim(self) -> DataFrame:
        return self._customers

    @cached_property
    def manager_dim(self) -> DataFrame:
        return self._managers

    @cached_property
    def deliver_dim(self) -> DataFrame:
        return self._numbered("deliver")

    @cached_property
    def ship_dim(self) -> DataFrame:
        return self._numbered("ship")

    @cached_property
    def product_dim(self) -> DataFrame:
        return self._numbered("product")

    @cached_property
    def order_dim(self) -> DataFrame:
        orders = self.staging_by_order.groupBy("order_id", "order_date", "ship_date").agg(F.count(F.lit(1)).alias("__lines"))
        flagged = with_return_flag(orders, self.returns_dedup)
        return self._by_order("order_dim", flagged.select("order_id", "order_date", "ship_date", "returned", "__lines"))

    @cached_property
    def sales_fact(self) -> DataFrame:
        # the dimensions of few rows first: their ids replace the texts before the lines are shuffled on the product
        fact = (self.staging_by_order
                .join(self.deliver_dim, DELIVER_KEY)
                .join(self.ship_dim, ["ship_mode"])
                .join(self.product_dim, PRODUCT_KEY))
        return self._lines("sales_fact", fact.select(*FACT_COLUMNS), "order_dim")

    def tables(self) -> dict[str, DataFrame]:
        return {"customer_dim": self.customer_dim, "manager_dim": self.manager_dim,
                "deliver_dim": self.deliver_dim, "order_dim": self.order_dim,
                "product_dim": self.product_dim, "ship_dim": self.ship_dim,
                "sales_fact": self.sales_fact}

    def view(self, columns: list[str]) -> DataFrame:
        """The fact joined to just the dimensions that carry ``columns``
        (flat column names plus manager / returned)."""
        df = self.sales_fact
        need = set(columns)
        # orders while the lines are still in their buckets, the dimensions of few rows
        # last: no text of theirs is moved when the lines are shuffled for the others
        if need & {"order_date", "ship_date", "returned"}:
            df = self._with_orders(df, "order_dim", self.order_dim)
        if need & {"customer_name", "segment"}:
            df = df.join(self.customer_dim, "customer_id")
        if need & set(PRODUCT_KEY):
            df = df.join(self.product_dim, "product_id")
        if need & {"country", "state", "city", "postal_code", "region", "manager"}:
            df = df.join(self.deliver_dim, "deliver_id")
        if "manager" in need:
            df = df.join(self.manager_dim, "region")
        if "ship_mode" in need:
            df = df.join(self.ship_dim, "ship_id")
        return df.select(*columns)

    def flatten(self) -> DataFrame:
        """The whole model joined back: flat columns + manager + returned."""
        return self.view(FLAT_COLUMNS + ["manager", "returned"])


class StarV2(_Model):
    PHASES = (("raw_staging",), ("_tables_of_keys", "_customers", "_managers"), ("orders_v2",), ("order_details_v2",))
    # with the first model's orders known, headers and details are written at the same time
    BESIDE_V1 = (*PHASES[:2], ("orders_v2", "order_details_v2"))

    @property
    def _tables_of_keys(self) -> DataFrame:
        return self.ship_dim_v2

    @classmethod
    def alongside(cls, v1: StarV1) -> "StarV2":
        """v2 over v1's staging table, reusing the dimensions both models
        define identically (product, deliver, customer): one build, two models."""
        v2 = cls(v1._flat, v1._people, v1._returns, v1._repair_state, stage=v1._stage, folder=v1._folder, by_order=v1._by_order_id)
        v2._shared = v1
        return v2

    @cached_property
    def ship_dim_v2(self) -> DataFrame:
        return self._numbered("ship_v2")

    @cached_property
    def product_dim_v2(self) -> DataFrame:
        return self._numbered("product")

    @cached_property
    def deliver_dim_v2(self) -> DataFrame:
        return self._numbered("deliver")

    @cached_property
    def customer_dim_v2(self) -> DataFrame:
        return self._customers

    @cached_property
    def orders_v2(self) -> DataFrame:
        """Order headers.  Order-level attributes are made distinct
        first, so the joins run on headers rather than lines; people is
        deduplicated so identical lookup rows cannot fan out.  Keys of the
        joined dimensions are unique by construction, hence the output is
        already distinct."""
        header = self.staging_by_order.select("order_id", "order_date", "ship_date", "customer_id", "ship_mode",
                                              *DELIVER_KEY).groupBy("order_id", "order_date", "ship_date", "customer_id", "ship_mode",
                                                                    *DELIVER_KEY).agg(F.count(F.lit(1)).alias("__lines"))
        people = self._table("managers", self._managers.distinct())
        header = (with_return_flag(header, self.returns_dedup)
                  .join(people, "region")
                  .join(self.ship_dim_v2, ["ship_mode"])
                  .join(self.deliver_dim_v2, DELIVER_KEY))
        return self._by_order("orders_v2", header.select(*HEADER_COLUMNS, "__lines"))

    @cached_property
    def order_details_v2(self) -> DataFrame:
        """Lines with measures and the product key."""
        details = self.staging_by_order.join(self.product_dim_v2, PRODUCT_KEY).select(*DETAIL_COLUMNS)
        return self._lines("order_details_v2", details, "orders_v2")

    def tables(self) -> dict[str, DataFrame]:
        return {"ship_dim_v2": self.ship_dim_v2, "product_dim_v2": self.product_dim_v2,
                "deliver_dim_v2": self.deliver_dim_v2, "customer_dim_v2": self.customer_dim_v2,
                "orders_v2": self.orders_v2, "order_details_v2": self.order_details_v2}

    def view(self, columns: list[str]) -> DataFrame:
        df = self.order_details_v2
        need = set(columns)
        if need & set(HEADER_COLUMNS + ["customer_name", "segment", "ship_mode",
                                        "country", "state", "city", "postal_code", "region"]) - {"order_id"}:
            df = self._with_orders(df, "orders_v2", self.orders_v2)
        if need & {"customer_name", "segment"}:
            df = df.join(self.customer_dim_v2, "customer_id")
        if need & {"country", "state", "city", "postal_code", "region"}:
            df = df.join(self.deliver_dim_v2, "deliver_id")
        if need & set(PRODUCT_KEY):
            df = df.join(self.product_dim_v2, "product_id")
        if "ship_mode" in need:
            df = df.join(self.ship_dim_v2, "ship_id")
        return df.select(*columns)

    def flatten(self) -> DataFrame:
        """Details + header + dimensions; v2 has no row_id."""
        return self.view([c for c in FLAT_COLUMNS if c != "row_id"] + ["manager", "returned"])


def build_all(v1: StarV1, v2: StarV2) -> None:
    """Write all tables of two models over one extract: the extract, then what
    both need, then lines and headers of both at the same time."""
    v1.build(2)
    concurrently([v1.build, v2.build])
