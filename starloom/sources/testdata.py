"""Analog inputs derived from the TPC-H style test tables.

The reference's own extracts are not available, so the flat orders, people,
returns, listings and reviews are derived from ``/root/testdata/sf*/``.  The
mappings are fixed (FIXTURES.md section 2) and mirrored by the DuckDB oracle.

Join plan of ``flat_orders`` (chosen for scale):
  * nation x region is tiny; customer gets its geography by a broadcastable
    join that Spark sizes from file statistics (no forced hint);
  * lineitem x part, then the order's ship date as a grouped max (partial
    aggregation before the shuffle, so a hot order is combined map-side),
  * orders + ship date + customer geography (all one row per order),
  * one join of the line side to the order side on the order key.  With AQE
    skew handling a hot order or hot part is split across tasks.
Where no order is hot (``even_orders``), the extract can come hashed by its order
id: the ship date is then a window over the lines that this join sorts anyway, and
lineitem is read and shuffled for its parts once instead of twice.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import shared
from .listing import listing_fingerprint

# --- fixed values of the analog mapping -----------------------------------------
VERMONT_ANALOG = "NATION_7"          # plays the state whose postal code is NULL
RETURN_FLAG_VALUE = "R"              # lineitem flag that marks a returned line
NO_ACCURACY_MODULUS = 97             # accuracy score NULL when partkey % 97 == 0
HEAVY_BUCKET = 5                     # times the average bucket of orders: Spark's skewedPartitionFactor
# tables behind the two analogs
RETAIL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
RENTAL_TABLES = ("part", "orders", "lineitem")


class TestData:
    """Lazy access to the test tables of one scale factor and their analogs."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The files that the folder holds now.  Only a table's schema is kept
        between queries (it saves the job that reads a footer), until ``release``."""
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            schema = shared(self.spark, ("schema", path), lambda: self.spark.read.parquet(path).schema)
            self._tables[name] = self.spark.read.schema(schema).parquet(path)
        return self._tables[name]

    def fingerprint(self, *names: str) -> str:
        """Stands for the present files of these tables."""
        return listing_fingerprint(self.spark, [f"{self.sf_dir}/{n}.parquet" for n in names])

    # -- retail analog ---------------------------------------------------------
    def flat_orders(self, hashed_by_id: bool = False) -> DataFrame:
        """The extract.  ``hashed_by_id``: its rows come hashed by order_id, a hot
        order in one task (see ``even_orders``)."""
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
        cust = (self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
                .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))

        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", F.col("l_shipdate").cast("date").alias("l_shipdate"))
        part = self.table("part").select("p_partkey", "p_name", "p_type", "p_brand")
        lp = lines.join(part, lines.l_partkey == part.p_partkey)

        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        if hashed_by_id:
            # the id as text is what the rows are hashed on, for the window and the join alike
            lp = (lp.withColumn("l_orderkey", F.col("l_orderkey").cast("string"))
                  .withColumn("ship_date", F.max("l_shipdate").over(Window.partitionBy("l_orderkey"))))
            orders = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
        else:
            ship = (lp.groupBy(F.col("l_orderkey").alias("s_orderkey"))
                    .agg(F.max("l_shipdate").alias("ship_date")))
            # left join: an order without surviving lines yields no flat row anyway,
            # and a left join to a key-unique aggregate is dropped by the optimizer
            # when ship_date is not read (no second lineitem scan for most reports)
            orders = orders.join(ship, F.col("o_orderkey") == F.col("s_orderkey"), "left")
        orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))

        j = lp.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        # one SQL projection: the same expressions as Column code, built with a
        # single call instead of hundreds of driver round trips
        sales = "CAST(l_extendedprice AS DECIMAL(11,2))"
        discount = "CAST(l_discount AS DECIMAL(4,2))"
        return j.selectExpr(
            "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
            f"CAST(l_suppkey AS STRING), CAST({sales} AS STRING)) AS row_id",
            "CAST(l_orderkey AS STRING) AS order_id",
            "CAST(o_orderdate AS DATE) AS order_date",
            "ship_date",
            "o_orderpriority AS ship_mode",
            "CAST(c_custkey AS STRING) AS customer_id",
            "c_name AS customer_name",
            "c_mktsegment AS segment",
            "n_name AS country",
            "n_name AS state",
            "concat_ws('-', n_name, CAST(c_custkey % 7 AS STRING)) AS city",
            f"CASE WHEN n_name = '{VERMONT_ANALOG}' THEN CAST(NULL AS INT) "
            "ELSE CAST(10000 + n_nationkey * 10 + c_custkey % 7 AS INT) END AS postal_code",
            "r_name AS region",
            "p_name AS product_name",
            "p_type AS category",
            "p_brand AS subcategory",
            f"{sales} AS sales",
            "CAST(l_quantity AS INT) AS quantity",
            f"{discount} AS discount",
            f"CAST({sales} * (CAST(0.08 AS DECIMAL(4,2)) - {discount}) AS DECIMAL(21,4)) AS profit",
        )

    def even_orders(self) -> bool:
        """Whether no bucket of orders has far more lines than the average one.
        Counted per bucket in one pass over a key of lineitem; nothing is shuffled
        but the counts."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        bucket = F.pmod(F.hash(F.col("l_orderkey").cast("string")), F.lit(buckets))
        most, lines = (self.table("lineitem").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
                       .agg(F.max("n"), F.sum("n")).first())
        return most is not None and most * buckets <= HEAVY_BUCKET * lines

    def people(self) -> DataFrame:
        supplier = self.table("supplier").select("s_name", "s_nationkey")
        nation = self.table("nation").select("n_nationkey", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        return (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                .groupBy(F.col("r_name").alias("region"))
                .agg(F.min("s_name").alias("person"))
                .select("person", "region"))

    def returns(self) -> DataFrame:
        return (self.table("lineitem").where(F.col("l_returnflag") == RETURN_FLAG_VALUE)
                .select(F.lit("Yes").alias("returned"), F.col("l_orderkey").cast("string").alias("order_id")))

    # -- rental analog -------------------------------------------------------
    def listings(self) -> DataFrame:
        def score(k: int) -> str:
            return f"CAST(5 + (p_partkey + {k} * p_size) % 6 AS DECIMAL(4,1))"

        first, *rest = schemas.SCORE_COLUMNS
        return self.table("part").selectExpr(
            "p_partkey AS listing_id", "p_name AS name", "p_type AS city", "p_brand AS neighbourhood",
            "CASE WHEN p_size % 3 = 0 THEN 'Entire place' WHEN p_size % 3 = 1 THEN 'Private room' "
            "ELSE 'Shared room' END AS room_type",
            "CAST(1 + p_partkey % 5 AS INT) AS bedrooms",
            "CAST(1 + p_partkey % 8 AS INT) AS accommodates",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
            "CAST(60 + (p_partkey * 7) % 41 AS DECIMAL(5,1)) AS review_scores_rating",
            f"CASE WHEN p_partkey % {NO_ACCURACY_MODULUS} = 0 THEN CAST(NULL AS DECIMAL(4,1)) "
            f"ELSE {score(1)} END AS {first}",
            *[f"{score(k)} AS {name}" for k, name in enumerate(rest, start=2)],
        )

    def reviews(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.col("l_partkey").alias("listing_id"),
                        F.col("l_shipdate").cast("date").alias("review_date"),
                        F.col("o_custkey").alias("reviewer_id")))
