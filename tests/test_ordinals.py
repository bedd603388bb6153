"""The bucketed rank / key helpers against Spark's plain window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators.ordinals import global_rank, surrogate_keys


def test_global_rank_matches_plain_rank(spark):
    rnd = random.Random(7)
    rows = [(i, None if i % 97 == 0 else rnd.choice([0, 1, 5, 5, 10, 250, rnd.randint(0, 10_000)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v long").withColumn("v", F.col("v").cast("decimal(20,2)"))
    for desc in (True, False):
        order = F.col("v").desc() if desc else F.col("v").asc()
        want = dict(df.select("id", F.rank().over(Window.orderBy(order)).alias("r")).collect())
        got = dict(global_rank(df, "v", "r", descending=desc, buckets=8).select("id", "r").collect())
        assert got == want


def test_global_rank_single_hot_value(spark):
    df = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(900)], "id int, v long")
    want = dict(df.select("id", F.rank().over(Window.orderBy(F.col("v").desc())).alias("r")).collect())
    got = dict(global_rank(df, "v", "r", buckets=16).select("id", "r").collect())
    assert got == want


def test_surrogate_keys_dense_unique_and_offset(spark):
    df = spark.createDataFrame([(f"id{i}",) for i in range(1234)], "k string")
    out = surrogate_keys(df, ["k"], "key", start=100, buckets=7)
    keys = sorted(r.key for r in out.collect())
    assert keys == list(range(101, 1335))
    again = dict(surrogate_keys(df, ["k"], "key", start=100, buckets=7).collect())
    assert again == dict(out.collect())


def test_keys_within_a_column_leave_rows_gathered_by_it(spark):
    from emporia.operators.ordinals import surrogate_keys

    df = spark.range(6000).selectExpr("cast(id as string) k", "cast(id % 6 as int) y")
    got = surrogate_keys(df.repartition(7), ["k"], "sk", start=10, within=("y",))
    keys = {r.k: r.sk for r in got.collect()}
    assert sorted(keys.values()) == list(range(11, 6011))
    assert keys == {r.k: r.sk for r in surrogate_keys(df.repartition(3), ["k"], "sk", start=10, within=("y",)).collect()}
    from pyspark.sql import functions as F

    pieces = got.select("y", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(pieces) <= 6 + len({r.p for r in pieces})


def test_stored_rows_are_numbered_without_a_shuffle_of_them(spark, tmp_path):
    from emporia.operators.gold import with_fact_keys
    import datetime as dt

    spark.range(6000).selectExpr("cast(id as string) order_id", "cast(id % 6 as int) order_year").repartition(5).write.parquet(str(tmp_path / "t"))
    got = with_fact_keys(spark.read.parquet(str(tmp_path / "t")), "sk", 10, dt.datetime(2024, 1, 1))
    keys = {r.order_id: r.sk for r in got.collect()}
    assert sorted(keys.values()) == list(range(11, 6011))
    assert keys == {r.order_id: r.sk for r in got.repartition(3).collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "row_number" not in plan
    empty = spark.read.parquet(str(tmp_path / "t")).where("order_year > 9")
    assert with_fact_keys(empty, "sk", 0, dt.datetime(2024, 1, 1)).count() == 0
