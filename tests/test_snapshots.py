"""Bucketed versions and change feeds: a load rewrites what it changes, and version n plus its feed is version n + 1."""

import os
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from marketlake.operators.dedup import collapse_dealt, latest_dealt, latest_per_key
from marketlake.operators.keys import assign_sk
from marketlake.operators.upsert import apply_changes, change_feed, images, scd1_upsert
from marketlake.plans import etl
from marketlake.plans.etl import Warehouse, collapse_items, first_dimension, load_dimension, payment_rows, warehouse
from marketlake.session import LONGEST_COMPILED, release, scratch_path
from marketlake.sources.snapshots import _changes, _meet, create, open_version
from marketlake.sources.staging import packed
from tests.conftest import SF_SMALL

POLICY, COMPARE = {"a": "coalesce", "b": "overwrite"}, ["a", "b", "row_source_file"]
SCHEMA = "k string, a int, b int, first_seen_at int, last_seen_at int, row_source_file string, staging_id string"


def table(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("a"), F.lit(1).alias("b"), F.lit(1).alias("first_seen_at"),
                                 F.lit(1).alias("last_seen_at"), F.lit("f1").alias("row_source_file"), F.lit("s1").alias("staging_id"))


def written(snapshot):
    path = f"{snapshot.root}/data/version={snapshot.version}"
    return {int(d.split("=")[1]) for d in os.listdir(path) if d.startswith("bucket=")} if os.path.exists(path) else set()


def same(x, y):
    return sorted(map(tuple, x.collect()), key=repr) == sorted(map(tuple, y.collect()), key=repr)


def test_a_load_of_one_bucket_in_a_hundred_writes_one_bucket(spark):
    first = create(table(spark, 4000), scratch_path(spark, "snap"), ["k"], buckets=100)
    assert written(first) == set(first.held) == set(range(100))
    one = first.rows([17])
    assert 0 < one.count() < 100 and one.select(first.bucket()).distinct().collect()[0][0] == 17
    load = one.withColumns({"b": F.lit(2), "row_source_file": F.lit("f2"), "last_seen_at": F.lit(5)})
    load = load.unionByName(first.rows([3]))  # rows that change nothing
    second = first.upsert(load, POLICY, COMPARE)
    assert written(second) == {17} and second.held[17] == 2 and second.held[3] == 1
    assert same(second.rows(), scd1_upsert(first.rows(), load, ["k"], POLICY, COMPARE))
    kinds = {r["kind"]: r["count"] for r in second.feed().groupBy("kind").count().collect()}
    assert kinds == {"update": one.count(), "unchanged": first.rows([3]).count()}
    assert same(first.rows(), table(spark, 4000))  # the version before is as it was


def test_feed_brings_one_version_to_the_next(spark):
    first = create(table(spark, 50), scratch_path(spark, "snap"), ["k"])
    load = spark.createDataFrame([("k1", None, None, 0, 9, "f2", "s2"), ("k2", 2, 1, 3, 9, "f1", "s2"), ("new", 7, 7, 2, 2, "f2", "s2"), (None, 1, 1, 2, 2, "f2", "s2")], SCHEMA)
    second = first.upsert(load, POLICY, COMPARE)
    third = second.upsert(load, POLICY, COMPARE)
    assert written(third) == set()  # a load that comes again changes nothing but compares everything
    rows = {r["after"]["k"]: r for r in second.feed().collect()}
    assert {k: r["kind"] for k, r in rows.items()} == {"k1": "update", "k2": "unchanged", "new": "insert", None: "insert"}
    assert rows["new"]["before"] is None and rows["k1"]["before"]["b"] == 1 and rows["k1"]["after"]["a"] == 1 and rows["k1"]["after"]["b"] is None
    assert same(apply_changes(first.rows(), second.feed(), ["k"]), second.rows())
    assert same(second.rows(), scd1_upsert(first.rows(), load, ["k"], POLICY, COMPARE)) and same(second.rows(), third.rows())
    again = open_version(spark, first.root, 2)
    assert again.held == second.held and same(again.rows(), second.rows()) and again.keys == ("k",)


def test_empty_table_and_empty_load(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    first = create(nothing, scratch_path(spark, "snap"), ["k"])
    assert first.rows().count() == 0 and first.held == {}
    assert first.upsert(nothing, POLICY, COMPARE).rows().count() == 0
    assert same(first.upsert(table(spark, 3), POLICY, COMPARE).rows(), table(spark, 3))
    assert change_feed(nothing, table(spark, 3), ["k"], POLICY, COMPARE).filter("kind = 'insert'").count() == 3


@pytest.mark.parametrize("name", Warehouse.TABLES)
def test_stored_tables_are_their_feeds(spark, name):
    wh = warehouse(spark, SF_SMALL)
    assert warehouse(spark, SF_SMALL) is wh  # kept while the data files are the same
    before = wh.versions(name, 1)[-1]
    for made in wh.versions(name, 2):
        assert same(apply_changes(before.rows(), made.feed(), before.keys), made.rows())
        before = made


def test_stored_and_incoming_rows_meet_in_one_shuffle(spark):
    first = create(table(spark, 60), scratch_path(spark, "snap"), ["k"], buckets=4)
    assert not os.path.exists(f"{first.root}/feed/version=1")  # the first feed is the rows
    assert same(first.feed().filter("kind = 'insert' AND before IS NULL").select("after.*"), table(spark, 60))
    load = spark.createDataFrame([("k1", None, 2, 0, 9, "f2", "s2"), ("k1", 5, 2, 0, 9, "f2", "s3"), (None, 1, 1, 2, 2, "f2", "s2"), (None, 2, 1, 2, 2, "f2", "s2")], SCHEMA)
    met = _meet(first.rows(), load, first.keys, first.bucket())
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    second = first.upsert(load, POLICY, COMPARE)
    third = second.upsert(load, POLICY, COMPARE)  # keys that repeat on both sides, null keys too
    for before, after in ((first, second), (second, third)):
        assert same(after.rows(), scd1_upsert(before.rows(), load, ["k"], POLICY, COMPARE))
        assert same(after.feed(), change_feed(before.rows(), load, ["k"], POLICY, COMPARE))


def test_staging_ids_are_stored_as_bytes_and_read_as_text(spark):
    wh = warehouse(spark, SF_SMALL)
    assert dict(wh.versions("items", 2)[-1].rows().dtypes)["staging_id"] == "binary"
    staged = wh.staged("items", 1).unionByName(wh.staged("items", 2)).select("staging_id")
    feed = wh.feed("items", 2)
    for ids in (wh.items.select("staging_id"), feed.select("after.staging_id"), feed.filter("before IS NOT NULL").select("before.staging_id")):
        assert ids.count() > 0 and ids.join(staged, "staging_id", "left_anti").count() == 0
    assert feed.filter("kind = 'insert' AND before IS NOT NULL").count() == 0


def test_rows_and_feed_of_a_load_are_stored_once(spark):
    first = create(table(spark, 4000), scratch_path(spark, "snap"), ["k"], buckets=20)
    one = first.rows([7])
    load = one.withColumns({"b": F.lit(2), "row_source_file": F.lit("f2")}).unionByName(first.rows([3]))
    second = first.upsert(load, POLICY, COMPARE)
    assert not os.path.exists(f"{first.root}/feed/version=2") and written(second) == {7} and second.same == (3,)
    assert same(second.feed(), change_feed(first.rows(), load, ["k"], POLICY, COMPARE))
    again = open_version(spark, first.root, 2)
    assert again.same == (3,) and same(again.feed(), second.feed()) and same(again.rows(), second.rows())
    third = second.upsert(load, POLICY, COMPARE)
    assert written(third) == set() and set(third.same) == {3, 7} and {r["kind"] for r in third.feed().collect()} == {"unchanged"}
    fourth = third.upsert(load.limit(0), POLICY, COMPARE)
    assert fourth.same == () and fourth.feed().count() == 0 and same(fourth.rows(), second.rows())
    done = _changes(_meet(first.rows(), load, first.keys, first.bucket(), 8).select("bucket", *images(first.schema.names, load.columns, first.keys, POLICY, COMPARE)))
    assert done._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_facts_move_once_to_their_buckets(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), (F.col("id") % 500).cast("string"))).alias("k"),
                                    (F.col("id") % 2).alias("line"), F.col("id").alias("v"), (-F.col("id")).alias("first"))
    got = collapse_dealt(rows, ["k", "line"], ["k"], 5, ["first"])
    assert same(got, rows.groupBy("k", "line").agg(F.max("v").alias("v"), F.min("first").alias("first")))
    plain = collapse_dealt(rows.filter("k <> 'hot'").dropDuplicates(["k", "line"]), ["k", "line"], ["k"], 5, ["first"])
    made = create(plain, scratch_path(spark, "snap"), ["k", "line"], 5, ["k"], dealt=True)
    assert same(made.rows(), plain) and same(open_version(spark, made.root, 1).rows([2]), plain.filter(made.bucket() == 2))
    assert all(len([f for f in os.listdir(f"{made.root}/data/version=1/bucket={b}") if f.startswith("part-")]) == 1 for b in made.held)
    assert open_version(spark, made.root, 1).by == ("k",)


def test_stored_items_are_linked_without_another_shuffle_of_items(spark):
    wh = warehouse(spark, SF_SMALL)
    no_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = payment_rows(packed(wh.staged("payments", 1)), wh.table("orders", 1), 8).rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", no_broadcast)
    assert plan.count("Exchange hashpartitioning") == 2  # payments and orders, each once
    items = collapse_items(packed(wh.staged("items", 1))).select("order_id", "order_item_id", "product_id", "seller_id", "price", "staging_id")
    assert same(wh.versions("items", 1)[-1].rows().select(*items.columns), items)


def test_first_load_of_a_numbered_table_moves_its_rows_once(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
                                    (F.col("id") % 7).alias("loaded_at"), F.when(F.col("id") % 11 != 0, F.col("id")).alias("staging_id"), (F.col("id") % 5).alias("v"))
    for given in (rows, rows.filter("k <> 'hot'"), rows.limit(0)):
        numbers = assign_sk(given.select("k").distinct(), ["k"], "sk")
        got = latest_dealt(given, ["k"], numbers, "sk", 5)
        assert same(got, latest_per_key(given, ["k"]).join(numbers, "k"))
        made = create(got, scratch_path(spark, "snap"), ["k"], 5, dealt=True)
        assert same(made.rows(), got) and all(made.rows([b]).filter(made.bucket() != b).isEmpty() for b in made.held)
    wh = warehouse(spark, SF_SMALL)
    for name in ("products", "orders"):
        stg = packed(wh.staged(name, 1))
        assert same(wh.versions(name, 1)[0].rows(), load_dimension(name, stg))
    plan = first_dimension("orders", packed(wh.staged("orders", 1)), 7).rows._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    rows_dealt = [line for line in dealt if "hashpartitioning(_bucket" not in line]  # the others number the keys
    assert len(rows_dealt) == 1 and "REPARTITION_BY_NUM" in rows_dealt[0]


def test_arrived_keys_stand_for_the_incoming_rows(spark):
    first = create(table(spark, 400), scratch_path(spark, "snap"), ["k"], buckets=9)
    load = first.rows([2]).withColumns({"b": F.lit(2), "row_source_file": F.lit("f2")}).unionByName(first.rows([5]))
    keys = load.select("k").unionByName(load.select("k"))
    second = first.upsert(load, POLICY, COMPARE, arrived=keys)
    assert written(second) == {2} and second.same == (5,)
    assert same(second.feed(), change_feed(first.rows(), load, ["k"], POLICY, COMPARE))
    wh = warehouse(spark, SF_SMALL)
    wh.versions("payments", 2)
    assert not [f for f in os.listdir(os.path.dirname(wh.root) + "/warehouse") if f.startswith(("items-rows", "payments-rows", "orders-rows"))]


def test_loads_have_no_code_too_long_to_be_compiled(spark, monkeypatch):
    limit, seen, write = "spark.sql.codegen.hugeMethodLimit", [], DataFrameWriter.parquet
    before = spark.conf.get(limit)

    def parquet(self, path, *args, **kwargs):
        if "manifest" not in path:
            seen.append(int(spark.conf.get(limit)))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    first = create(table(spark, 400), scratch_path(spark, "snap"), ["k"])
    second = first.upsert(table(spark, 600).withColumn("b", F.lit(2)), POLICY, COMPARE)
    second.apply(second.feed().limit(0))
    assert len(seen) >= 4 and set(seen) == {LONGEST_COMPILED} and spark.conf.get(limit) == before


def test_unique_keys_meet_without_lists(spark):
    first = create(table(spark, 400), scratch_path(spark, "snap"), ["k"], buckets=9)
    load = table(spark, 600).filter("a % 3 = 0").withColumns({"b": F.lit(2), "row_source_file": F.lit("f2")})
    met = _meet(first.rows(), load, first.keys, first.bucket(), 4, once=True)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1
    lists = _meet(first.rows(), load, first.keys, first.bucket(), 4)
    assert same(met, lists) and met.filter("_repeats").isEmpty()
    twice = load.unionByName(load.filter("a < 30"))
    assert _meet(first.rows(), twice, first.keys, first.bucket(), 4, once=True).filter("_repeats").count() == 10
    second = first.upsert(twice, POLICY, COMPARE)
    assert same(second.rows(), scd1_upsert(first.rows(), twice, ["k"], POLICY, COMPARE))
    assert same(second.feed(), change_feed(first.rows(), twice, ["k"], POLICY, COMPARE))


def test_shuffle_files_go_when_nothing_refers_to_them(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x.rsplit("/", 1)[-1].split("_")[1] for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    before = shuffles()
    moved = spark.range(1000).repartition(7, "id")
    assert len(moved.collect()) == 1000
    made = shuffles() - before
    assert made
    release(spark)
    time.sleep(1)
    assert made <= shuffles()  # still referred to
    del moved
    end = time.time() + 30
    while shuffles() & made and time.time() < end:
        release(spark)  # what Spark's listeners still hold goes with a later call, as with the warehouse's next table
        time.sleep(0.5)
    assert not shuffles() & made


def test_the_warehouse_lets_go_after_each_table(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(etl, "release", calls.append)
    wh = Warehouse(spark, SF_SMALL, runs=2)
    wh.versions("category", 2)
    assert calls == [spark, spark] and wh.versions("category", 2) and len(calls) == 2  # both runs, once
