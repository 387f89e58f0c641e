from pyspark.sql import functions as F

from pyspark.sql import Window

from starloom.operators.keys import dense_key, row_number_global


def row_number_single(df, order, out_col):
    """Reference form: one window over all rows."""
    return df.withColumn(out_col, F.row_number().over(Window.orderBy(*order)).cast("long"))


def _pairs(df, key, out):
    return sorted((r[key], r[out]) for r in df.select(key, out).collect())


def test_global_and_single_forms_agree(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).distinct()
    g = row_number_global(df, ["k"], "rn", num_partitions=6)
    s = row_number_single(df, ["k"], "rn")
    assert _pairs(g, "k", "rn") == _pairs(s, "k", "rn")
    ids = sorted(r.rn for r in g.collect())
    assert ids == list(range(1, df.count() + 1))


def test_dense_key_order_nulls_last_and_offset(spark):
    df = spark.createDataFrame([("a",), ("B",), (None,), ("a",), ("b",), (None,)], "name string")
    keys = dense_key(df, ["name"], "id", offset=100)
    got = sorted((r.id, r.name) for r in keys.collect())
    # binary string order: upper case before lower case; NULL last
    assert got == [(101, "B"), (102, "a"), (103, "b"), (104, None)]


def test_descending_order_with_tie_break(spark):
    df = spark.createDataFrame([("c1", 5), ("c2", 9), ("c3", 5), ("c4", 1)], "c string, v int")
    out = row_number_global(df, [F.col("v").desc(), F.col("c").asc()], "rank")
    assert [r.c for r in out.orderBy("rank").collect()] == ["c2", "c1", "c3", "c4"]


def test_global_plan_has_no_single_partition_data_exchange(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    plan = row_number_global(df, ["k"], "rn", num_partitions=4)._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the window over one row per partition,
    # which sits under the broadcast of the offsets
    assert "Exchange SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_dense_keys_one_pass_equals_separate_keys(spark):
    from starloom.operators.keys import dense_keys
    df = spark.createDataFrame(
        [("a", "x", 1), ("b", "x", None), ("a", "y", 2), (None, "y", 2), ("b", "x", None)],
        "p string, q string, r int")
    specs = {"pq": (["p", "q"], "id_pq", 0), "r": (["r"], "id_r", 100), "r0": (["r"], "id_r0", 0),
             "q": (["q"], "id_q", 0)}
    got = dense_keys(df, specs)
    for name, (keys, out, off) in specs.items():
        want = dense_key(df, keys, out, off)
        assert sorted(tuple(r) for r in got[name].collect()) == sorted(tuple(r) for r in want.collect()), name
