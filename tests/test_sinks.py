"""Sinks of the store: bounded files, idempotent batches, touched buckets only, and the persisted key index."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from emporia.operators import key_index as K
from emporia.operators.key_index import KeyIndex
from emporia.operators.merge import ACTION, insert_all, merge
from emporia.plans.pipeline import append_new
from emporia.sources.store import BATCH, BUCKET, GEN, TableStore, bucket_of, stamp
from emporia.streaming.ingest import stream_feed_to_bronze

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
CUSTOMER = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"


def customers(spark, ids):
    return spark.createDataFrame([(i, "u", "1", "c", "s") for i in ids], CUSTOMER)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "wh"))


def keyed(spark, rows, buckets=16):
    return spark.createDataFrame(rows, "id string, v long").withColumn(BUCKET, bucket_of("id", buckets))


def test_merge_leaves_untouched_buckets_alone(spark, store):
    rows = [(str(i), i) for i in range(400)]
    store.write_buckets("silver", "t", store.gathered(keyed(spark, rows), [BUCKET]), stamp(T1), new_version=True)
    before = store.files("silver", "t")
    target = insert_all(spark.createDataFrame(rows, "id string, v long"), ["id", "v"], T1).drop(ACTION)
    changes = spark.createDataFrame([("7", -7), ("new", 1)], "id string, v long")
    touched = sorted(r[0] for r in changes.select(bucket_of("id", 16)).distinct().collect())
    out = merge(target.where(bucket_of("id", 16).isin(touched)), changes, ["id"], ["id", "v"], ["v"], T2).select("id", "v")
    store.write_buckets("silver", "t", out.withColumn(BUCKET, bucket_of("id", 16)), stamp(T2))
    added = store.files("silver", "t") - before
    assert before <= store.files("silver", "t")
    assert {int(f.split("/")[0].split("=")[1]) for f in added} == set(touched) and len(touched) <= 2
    got = {r.id: r.v for r in store.read("silver", "t").collect()}
    assert got == {**dict(rows), "7": -7, "new": 1}
    # A reader of what changed since the first batch lists and reads the new files only.
    changed = store.read("silver", "t").where(F.col(GEN) > stamp(T1))
    assert len(changed.inputFiles()) >= 1 and "PartitionFilters" in changed._jdf.queryExecution().toString()
    assert {r.id for r in changed.collect()} >= {"7", "new"} and changed.count() < 120
    store.drop_old_versions("silver", "t", keep=1)
    assert {r.id: r.v for r in store.read("silver", "t").collect()} == got
    assert all(f"{GEN}={stamp(T2)}" in f for f in store.files("silver", "t") if int(f.split("/")[0].split("=")[1]) in touched)


def test_an_unpublished_generation_is_not_read(spark, store):
    store.write_buckets("silver", "t", keyed(spark, [("a", 1)]), stamp(T1), new_version=True)
    path = store.current_dir("silver", "t")
    keyed(spark, [("a", 2)]).withColumn(GEN, F.lit(stamp(T2))).write.mode("append").partitionBy(BUCKET, GEN).parquet(path)  # broke off
    assert [r.v for r in store.read("silver", "t").collect()] == [1]
    store.write_buckets("silver", "t", keyed(spark, [("a", 3)]), stamp(T2))  # the same batch again
    assert [r.v for r in store.read("silver", "t").collect()] == [3]


def test_two_writers_take_different_versions(spark, store):
    assert store._claim_version("a", "t") == 1 and store._claim_version("a", "t") == 2
    df = spark.createDataFrame([(1,)], "x int")
    assert store.write_version("a", "t", df) == 3 and store.read("a", "t").count() == 1


def test_empty_tables_keep_their_schema(spark, store):
    df = spark.createDataFrame([], "x int, y string")
    store.write_version("a", "p", df, ["y"])
    store.truncate("a", "q", df)
    assert store.read("a", "p").count() == 0 and store.read("a", "p").columns == ["x", "y"]
    assert store.read("a", "q").dtypes == [("x", "int"), ("y", "string")]


def test_partitioned_write_makes_few_files(spark, store):
    df = spark.range(4000).repartition(16).select((F.col("id") % 5).cast("int").alias("year"), "id")
    store.write_version("a", "raw", df, ["year"])
    store.write_version("a", "gathered", store.gathered(df, ["year"]), ["year"])
    assert len(store.files("a", "raw")) == 80 and len(store.files("a", "gathered")) <= 10


def test_replayed_batch_stands_once(spark, store):
    ids = ["1", "2", None, None]
    append_new(store, customers(spark, ["0"]), "customers", T1, "incremental")
    for _ in range(2):
        assert append_new(store, customers(spark, ids), "customers", T2, "incremental") == 4
    rows = [r.customer_id for r in store.read("bronze", "customers").collect()]
    assert sorted(rows, key=str) == sorted(["0", *ids], key=str)
    # Another batch sends the rows without key again, as the reference does, and no known key.
    assert append_new(store, customers(spark, ids), "customers", T3, "incremental") == 2


def test_streamed_batch_run_twice_adds_nothing(spark, store, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                                           "1,u,1,c,s\n,u,1,c,s\n")
    for checkpoint in ("c1", "c2"):  # a new checkpoint: Spark starts again at batch 0, as after a lost commit
        stream_feed_to_bronze(spark, str(tmp_path / "in"), "customers", store, str(tmp_path / checkpoint)).awaitTermination()
        assert store.read("bronze", "customers").count() == 2
    assert len(store.batches("bronze", "customers")) == 1


@pytest.mark.parametrize("positions", [32_768, 64])
def test_key_index_is_exact_with_false_positives(spark, store, monkeypatch, positions):
    """With 64 positions in use nearly every new key hits a set bit; the answer stays exact."""
    if positions == 64:
        monkeypatch.setattr(KeyIndex, "_place", lambda self, df, slots: df.withColumn("_slot", F.lit(1).cast("long")).withColumn(
            "_bit", F.pmod(F.xxhash64(*self._ks), F.lit(64))))
    known = [str(i) for i in range(300)]
    append_new(store, customers(spark, [k + "  " for k in known]), "customers", T1, "incremental")
    source = customers(spark, [str(i) for i in range(250, 700)] + [" 5", "250 ", None])
    index = KeyIndex(store, "customers", ("customer_id",))
    if positions == 64:
        assert index.screened(source).where("maybe").count() > 400
    else:
        assert index.screened(source).where("maybe").count() < 200
    want = sorted([str(i) for i in range(300, 700)] + [" 5", None], key=str)
    assert sorted([r.customer_id for r in index.new_rows(source).collect()], key=str) == want


def test_history_is_read_for_positives_only(spark, store):
    append_new(store, customers(spark, [f"k{i}" for i in range(2000)]), "customers", T1, "incremental")
    index = KeyIndex(store, "customers", ("customer_id",))
    fresh = [f"n{i}" for i in range(200)]
    src = customers(spark, fresh)
    maybe = {r.customer_id for r in index.screened(src).where("maybe").collect()}
    none = index.new_rows(customers(spark, [f for f in fresh if f not in maybe]))
    assert "customers_keys" not in "".join(none.inputFiles())  # nothing to compare: the index is not read at all
    one = index.new_rows(customers(spark, [f for f in fresh if f not in maybe] + ["k5"]))
    bucket = customers(spark, ["k5"]).select(bucket_of("customer_id", index.buckets)).first()[0]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*key_bucket#\d+ = {bucket}\)", plan)
    assert one.count() == len(fresh) - len(maybe) and "bronze/customers/" not in "".join(one.inputFiles())


def test_filter_grows_with_the_keys(spark, store, monkeypatch):
    monkeypatch.setattr(K, "POSITIONS", 32_768)
    append_new(store, customers(spark, ["a"]), "customers", T1, "incremental")
    index = KeyIndex(store, "customers", ("customer_id",))
    assert index._size() == (1, 1)
    append_new(store, customers(spark, [f"b{i}" for i in range(5000)]), "customers", T2, "incremental")
    slots, n = index._size()
    assert n == 5001 and slots * K.POSITIONS >= 8 * n and slots > 1
    assert append_new(store, customers(spark, ["a", "b17", "c"]), "customers", T3, "incremental") == 1


def test_lost_index_batch_is_caught_up(spark, store):
    append_new(store, customers(spark, ["a"]), "customers", T1, "incremental")
    append_new(store, customers(spark, ["b"]), "customers", T2, "incremental")
    KeyIndex(store, "customers", ("customer_id",)).forget(stamp(T2))  # as if the load had broken off before indexing
    assert append_new(store, customers(spark, ["a", "b", "c"]), "customers", T3, "incremental") == 1
    assert store.read("bronze", "customers").where(F.col(BATCH) == stamp(T3)).count() == 1


def test_screening_moves_no_source_row(spark, store):
    append_new(store, customers(spark, [f"k{i}" for i in range(2000)]), "customers", T1, "incremental")
    plan = KeyIndex(store, "customers", ("customer_id",)).screened(customers(spark, ["k1", "n1"]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(_slot" not in plan


def test_filter_has_a_largest_size_and_stays_exact(spark, store, monkeypatch):
    monkeypatch.setattr(K, "MAX_SLOTS", 1, raising=False)
    ids = [f"a{i}" for i in range(9000)]
    append_new(store, customers(spark, ids), "customers", T1, "incremental")
    assert KeyIndex(store, "customers", ("customer_id",))._size() == (1, 9000)
    assert append_new(store, customers(spark, ids + [f"b{i}" for i in range(700)]), "customers", T2, "incremental") == 700


def test_first_load_writes_where_it_reads(spark, store):
    """A batch is one partition: gathering its rows by it would shuffle the whole load."""
    append_new(store, customers(spark, [str(i) for i in range(90)]).repartition(3, "customer_id"), "customers", T1, "snapshot")
    assert len(store.files("bronze", "customers")) == 3
    assert all(f.endswith(".zstd.parquet") for f in store.files("bronze", "customers"))


def test_superseded_generations_leave_with_their_version(spark, store):
    for ts, v in ((T1, 1), (T2, 2)):
        store.write_buckets("silver", "t", keyed(spark, [("a", v)]), stamp(ts), new_version=ts == T1)
    old = store.current_dir("silver", "t")
    store.write_buckets("silver", "t", keyed(spark, [("a", 3)]), stamp(T3), new_version=True)
    store.drop_old_versions("silver", "t", keep=2)
    # Two states stay: the new version, and the version before it as it last was.
    gens = {p.getPath().getName() for p in store._fs.globStatus(store._Path(f"{old}/{BUCKET}=*/{GEN}=*"))}
    assert gens == {f"{GEN}={stamp(T2)}"} and [r.v for r in store.read("silver", "t").collect()] == [3]


def test_a_restarted_index_leaves_no_old_files(spark, store):
    for ts in (T1, T2):
        append_new(store, customers(spark, ["a", "b"]), "customers", ts, "snapshot")
    assert len(store.versions(K.LAYER, "customers_keys")) == 1
    assert append_new(store, customers(spark, ["b", "c"]), "customers", T3, "incremental") == 1
