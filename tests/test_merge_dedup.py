"""Dedup tie-break, MERGE semantics and type-1 dimension change detection."""

import datetime as dt

from emporia.operators.gold import CUSTOMER_COMPARE, CUSTOMER_UPDATES, DIM_CUSTOMER_COLUMNS, build_dim, merge_dim
from emporia.operators.merge import ACTION, insert_all, merge
from emporia.operators.silver import clean_customers

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
BRONZE = ("customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
          "customer_state string, ingestion_timestamp timestamp_ntz, source_system string")


def test_later_ingestion_wins_and_ties_are_deterministic(spark):
    rows = [("1", "u", "100", "a", "sp", T1, "s"), ("1 ", "u", "200", "b", "sp", T2, "s"),
            ("2", "u", "300", "z", "rj", T1, "s"), ("2", "u", "300", "c", "rj", T1, "s")]
    out = {r.customer_id: r for r in clean_customers(spark.createDataFrame(rows, BRONZE)).collect()}
    assert out["1"].customer_zip_code_prefix == 200 and out["1"].customer_city == "B"
    # equal timestamps: smallest raw text first
    assert out["2"].customer_city == "C"


def test_merge_update_insert_keep_and_null_overwrite(spark):
    schema = "k string, a string, b string"
    target = insert_all(spark.createDataFrame([("1", "x", "f"), ("2", "y", "g")], schema), ["k", "a", "b"], T1)
    target = target.drop(ACTION)
    changes = spark.createDataFrame([("1", None, "new"), ("3", "z", "h")], schema)
    out = {r.k: r for r in merge(target, changes, ["k"], ["k", "a", "b"], ["a"], T2).collect()}
    assert out["1"].a is None and out["1"].b == "f"          # update to NULL overwrites; b is frozen
    assert out["1"][ACTION] == "update" and out["1"].updated_at == T2 and out["1"].created_at == T1
    assert out["2"][ACTION] == "keep" and out["2"].updated_at is None
    assert out["3"][ACTION] == "insert" and out["3"].created_at == T2


def test_merge_is_idempotent(spark):
    schema = "k string, a string"
    t = insert_all(spark.createDataFrame([("1", "x")], schema), ["k", "a"], T1).drop(ACTION)
    c = spark.createDataFrame([("1", "y"), ("2", "z")], schema)
    once = merge(t, c, ["k"], ["k", "a"], ["a"], T2).drop(ACTION)
    twice = merge(once, c, ["k"], ["k", "a"], ["a"], T2).drop(ACTION)
    # Business columns are stable; a re-merge re-stamps updated_at, as MERGE does.
    assert sorted(map(tuple, once.select("k", "a", "created_at").collect())) == sorted(
        map(tuple, twice.select("k", "a", "created_at").collect()))


def test_dim_updates_only_on_real_change(spark):
    schema = ("customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
              "customer_state string")
    s1 = spark.createDataFrame([("1", "u1", None, "Rio", "RJ"), ("2", "u2", 5, "Sp", "SP")], schema)
    dim = build_dim(s1, DIM_CUSTOMER_COLUMNS, "customer_id", "customer_key", T1).drop(ACTION)
    # zip NULL vs 0 compare equal (ISNULL form); unique id is never updated
    s2 = spark.createDataFrame([("1", "other", 0, "Rio", "RJ"), ("2", "u2", 5, "Santos", "SP"),
                                ("3", "u3", 7, "Bh", "MG")], schema)
    out = {r.customer_id: r for r in merge_dim(dim, s2, DIM_CUSTOMER_COLUMNS, "customer_id", "customer_key",
                                               CUSTOMER_UPDATES, CUSTOMER_COMPARE, T2, 2).collect()}
    assert out["1"][ACTION] == "keep" and out["1"].updated_at is None and out["1"].customer_unique_id == "u1"
    assert out["2"][ACTION] == "update" and out["2"].customer_city == "Santos"
    assert out["3"][ACTION] == "insert" and out["3"].customer_key == 3
    assert sorted(r.customer_key for r in out.values()) == [1, 2, 3]


def test_merge_into_a_larger_target(spark):
    from pyspark.sql import functions as F

    schema = "k string, a string, b string"
    target = insert_all(spark.createDataFrame([(str(i), f"a{i}", f"b{i}") for i in range(50)] + [(None, "n", "n")],
                                              schema), ["k", "a", "b"], T1).drop(ACTION)
    changes = spark.createDataFrame([("3", None, "x"), ("7", "a7", "y"), ("77", "z", "z"), (None, "q", "q")], schema)
    cond = F.col("t.a").isNull() | F.col("c.a").isNull() | (F.col("t.a") != F.col("c.a"))
    got = merge(target, changes, ["k"], ["k", "a", "b"], ["a"], T2, matched_condition=cond).collect()
    want = {(str(i), f"a{i}", f"b{i}", "keep") for i in range(50) if i != 3}
    want |= {("3", None, "b3", "update"), ("77", "z", "z", "insert"), (None, "q", "q", "insert"), (None, "n", "n", "keep")}
    assert len(got) == len(want) and {(r.k, r.a, r.b, r[ACTION]) for r in got} == want


def test_dimension_merge_plans_one_full_outer_join(spark):
    schema = "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string"
    dim = build_dim(spark.createDataFrame([("1", "u", 1, "a", "b")], schema), DIM_CUSTOMER_COLUMNS, "customer_id",
                    "customer_key", T1).drop(ACTION)
    out = merge_dim(dim, spark.createDataFrame([("2", "u", 1, "a", "b"), ("3", "u", 1, "a", "b")], schema),
                    DIM_CUSTOMER_COLUMNS, "customer_id", "customer_key", CUSTOMER_UPDATES, CUSTOMER_COMPARE, T2, 1)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("FullOuter") == 1
    assert sorted(r.customer_key for r in out.collect()) == [1, 2, 3]


def test_calendar_takes_any_year(spark):
    import datetime as dt

    import pytest

    from emporia.operators.gold import dim_date

    assert dim_date(spark, dt.date(1, 1, 1), dt.date(9999, 12, 31)).count() == 3652059
    with pytest.raises(ValueError):
        dim_date(spark, dt.date(2020, 1, 2), dt.date(2020, 1, 1))
