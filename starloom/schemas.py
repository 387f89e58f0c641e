"""Schemas: the declared model (what the source database enforced) and the
engine types used for storage.

Declared widths are fixed values of the source model and must stay as they
are for the audits to report the same violations.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: declared column types of the flat order-line extract -------
# (name, declared type, nullable); varchar(n) is checked by length, numeric(p,s)
# by precision, as the source database did on insert.
ORDER_COLUMNS = [
    ("row_id", "int", False),
    ("order_id", "varchar(14)", False),
    ("order_date", "date", False),
    ("ship_date", "date", False),
    ("ship_mode", "varchar(14)", False),
    ("customer_id", "varchar(10)", False),
    ("customer_name", "varchar(22)", False),
    ("segment", "varchar(11)", False),
    ("country", "varchar(13)", False),
    ("state", "varchar(20)", False),
    ("city", "varchar(17)", False),
    ("postal_code", "int", True),
    ("region", "varchar(7)", False),
    ("product_name", "varchar(127)", False),
    ("category", "varchar(15)", False),
    ("subcategory", "varchar(11)", False),
    ("sales", "numeric(9,4)", False),
    ("quantity", "int", False),
    ("discount", "numeric(4,2)", False),
    ("profit", "numeric(21,16)", False),
]

# --- fixed values: the two target models ---------------------------------------
# table -> columns (name, declared type, nullable), primary key, foreign keys
MODEL_V1 = {
    "customer_dim": {
        "columns": [("customer_id", "varchar(10)", False), ("customer_name", "varchar(22)", False),
                    ("segment", "varchar(11)", False)],
        "pk": ["customer_id"], "fk": []},
    "manager_dim": {
        "columns": [("region", "varchar(7)", False), ("manager", "varchar(17)", False)],
        "pk": ["region"], "fk": []},
    "deliver_dim": {
        "columns": [("deliver_id", "int", False), ("country", "varchar(13)", False),
                    ("state", "varchar(20)", False), ("city", "varchar(17)", False),
                    ("postal_code", "int", True), ("region", "varchar(7)", False)],
        "pk": ["deliver_id"], "fk": [(["region"], "manager_dim", ["region"])]},
    "order_dim": {
        "columns": [("order_id", "varchar(14)", False), ("order_date", "date", False),
                    ("ship_date", "date", False), ("returned", "varchar(3)", False)],
        "pk": ["order_id"], "fk": []},
    "product_dim": {
        "columns": [("product_id", "int", False), ("product_name", "varchar(127)", False),
                    ("category", "varchar(15)", False), ("subcategory", "varchar(11)", False)],
        "pk": ["product_id"], "fk": []},
    "ship_dim": {
        "columns": [("ship_id", "int", False), ("ship_mode", "varchar(14)", False)],
        "pk": ["ship_id"], "fk": []},
    "sales_fact": {
        "columns": [("row_id", "int", False), ("ship_id", "int", False), ("sales", "numeric(9,4)", False),
                    ("quantity", "int", False), ("discount", "numeric(4,2)", False),
                    ("profit", "numeric(21,16)", False), ("order_id", "varchar(14)", False),
                    ("product_id", "int", False), ("customer_id", "varchar(10)", False),
                    ("deliver_id", "int", False)],
        "pk": ["row_id"],
        "fk": [(["product_id"], "product_dim", ["product_id"]),
               (["deliver_id"], "deliver_dim", ["deliver_id"]),
               (["ship_id"], "ship_dim", ["ship_id"]),
               (["order_id"], "order_dim", ["order_id"]),
               (["customer_id"], "customer_dim", ["customer_id"])]},
}

MODEL_V2 = {
    "ship_dim_v2": {
        "columns": [("ship_id", "int", False), ("ship_mode", "varchar(14)", False)],
        "pk": ["ship_id"], "fk": []},
    "product_dim_v2": {
        "columns": [("product_id", "int", False), ("product_name", "varchar(127)", False),
                    ("category", "varchar(15)", False), ("subcategory", "varchar(11)", False)],
        "pk": ["product_id"], "fk": []},
    "deliver_dim_v2": {
        "columns": [("deliver_id", "int", False), ("country", "varchar(13)", False),
                    ("state", "varchar(20)", False), ("city", "varchar(17)", False),
                    ("postal_code", "int", True), ("region", "varchar(7)", False)],
        "pk": ["deliver_id"], "fk": []},
    "customer_dim_v2": {
        "columns": [("customer_id", "varchar(10)", False), ("customer_name", "varchar(22)", False),
                    ("segment", "varchar(11)", False)],
        "pk": ["customer_id"], "fk": []},
    "orders_v2": {
        "columns": [("order_id", "varchar(14)", False), ("order_date", "date", False),
                    ("ship_date", "date", False), ("manager", "varchar(17)", False),
                    ("returned", "varchar(3)", False), ("ship_id", "int", False),
                    ("deliver_id", "int", False), ("customer_id", "varchar(10)", False)],
        "pk": ["order_id"],
        "fk": [(["ship_id"], "ship_dim_v2", ["ship_id"]),
               (["deliver_id"], "deliver_dim_v2", ["deliver_id"]),
               (["customer_id"], "customer_dim_v2", ["customer_id"])]},
    "order_details_v2": {
        "columns": [("sales", "numeric(9,4)", False), ("quantity", "int", False),
                    ("profit", "numeric(21,16)", False), ("discount", "numeric(4,2)", False),
                    ("product_id", "int", False), ("order_id", "varchar(14)", False)],
        "pk": [],
        "fk": [(["product_id"], "product_dim_v2", ["product_id"]),
               (["order_id"], "orders_v2", ["order_id"])]},
}

# --- engine storage types -------------------------------------------------------
# Strings are unbounded (widths are audited, not enforced); money is kept wide
# enough for the data (prices exceed numeric(9,4)); keys are bigint.
ORDERS_SCHEMA = T.StructType([
    T.StructField("row_id", T.StringType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("order_date", T.DateType(), True),
    T.StructField("ship_date", T.DateType(), True),
    T.StructField("ship_mode", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("postal_code", T.IntegerType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("subcategory", T.StringType(), True),
    T.StructField("sales", T.DecimalType(15, 4), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("discount", T.DecimalType(4, 2), True),
    T.StructField("profit", T.DecimalType(32, 16), True),
])

PEOPLE_SCHEMA = T.StructType([
    T.StructField("person", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
])

RETURNS_SCHEMA = T.StructType([
    T.StructField("returned", T.StringType(), True),
    T.StructField("order_id", T.StringType(), True),
])

SCORE_COLUMNS = ["review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
                 "review_scores_communication", "review_scores_location", "review_scores_value"]

LISTINGS_SCHEMA = T.StructType(
    [T.StructField("listing_id", T.LongType(), False),
     T.StructField("name", T.StringType(), True),
     T.StructField("city", T.StringType(), True),
     T.StructField("neighbourhood", T.StringType(), True),
     T.StructField("room_type", T.StringType(), True),
     T.StructField("bedrooms", T.IntegerType(), True),
     T.StructField("accommodates", T.IntegerType(), True),
     T.StructField("price", T.DecimalType(10, 2), True),
     T.StructField("review_scores_rating", T.DecimalType(7, 4), True)]
    + [T.StructField(c, T.DecimalType(6, 4), True) for c in SCORE_COLUMNS])

REVIEWS_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType(), False),
    T.StructField("review_date", T.DateType(), True),
    T.StructField("reviewer_id", T.LongType(), True),
])

FLAT_COLUMNS = [f.name for f in ORDERS_SCHEMA.fields]
