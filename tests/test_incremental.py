"""Maintained sums follow change feeds: equal to a recomputation, without another scan of the table."""

import random

from pyspark.sql import functions as F

from marketlake.operators.incremental import delta, signed_rows
from marketlake.plans.etl import warehouse
from marketlake.session import scratch_path
from marketlake.sources.snapshots import create
from marketlake.sources.views import GroupedView
from tests.conftest import SF_SMALL

SCHEMA = "k long, g string, v long, first_seen_at int, last_seen_at int, row_source_file string, staging_id string"
POLICY, COMPARE = {"g": "overwrite", "v": "overwrite"}, ["g", "v"]


def table(spark, rows, run):
    return spark.createDataFrame([(k, g, v, run, run, f"f{run}", f"s{run}") for k, g, v in rows], SCHEMA)


def same(view, snapshot):
    got = sorted(map(tuple, view.rows().select("g", "n", "v").collect()), key=repr)
    want = snapshot.rows().groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"))
    return got == sorted(map(tuple, want.collect()), key=repr)


def test_view_follows_random_loads_with_null_groups_and_values(spark):
    rng = random.Random(3)
    pick = lambda: (rng.choice(["a", "b", "c", None, f"x{rng.randrange(9)}"]), rng.choice([None, 0, 5, -7]))
    snap = create(table(spark, [(k, *pick()) for k in range(60)], 1), scratch_path(spark, "t"), ["k"])
    view = GroupedView.start(snap.feed(), scratch_path(spark, "v"), ("g",), {"v": "v"})
    assert same(view, snap)
    for run in (2, 3):
        snap = snap.upsert(table(spark, [(k, *pick()) for k in rng.sample(range(90), 40)], run), POLICY, COMPARE)
        view = view.follow(snap.feed())
        assert same(view, snap)


def test_group_that_empties_is_hidden_and_returns(spark):
    snap = create(table(spark, [(1, "a", 1), (2, "b", 2)], 1), scratch_path(spark, "t"), ["k"])
    view = GroupedView.start(snap.feed(), scratch_path(spark, "v"), ("g",), {"v": "v"})
    for run, group, want in [(2, "b", [("b", 2, 9)]), (3, "a", [("a", 1, 7), ("b", 1, 2)]), (4, "a", [("a", 1, 7), ("b", 1, 2)])]:
        snap = snap.upsert(table(spark, [(1, group, 7)], run), POLICY, COMPARE)
        before = view.state.held
        view = view.follow(snap.feed())
        assert sorted(map(tuple, view.rows().select("g", "n", "v").collect())) == want
    assert view.state.held == before  # a load that changes nothing rewrites no bucket


def test_warehouse_views_equal_a_recomputation_and_scan_no_items(spark):
    wh = warehouse(spark, SF_SMALL, runs=2)
    for name, (table_name, groups, _) in wh.VIEWS.items():
        rows = wh.view(name, 2).rows()
        want = wh.table(table_name, 2).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
        assert sorted(map(tuple, rows.select(*groups, "n").collect()), key=repr) == sorted(map(tuple, want.select(*groups, "n").collect()), key=repr)
        assert not any(f"{wh.root}/{table_name}/" in f for f in rows.inputFiles())


def test_missing_values_are_counted_as_staging_is_written(spark):
    wh = warehouse(spark, SF_SMALL, runs=2)
    for name in ("orders", "items"):
        seen, stored = wh.missing(name, 1), wh.staged(name, 1)
        blank = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c)) == "")).alias(c) for c, kind in stored.dtypes if kind == "string"]
        assert seen == stored.agg(F.count(F.lit(1)).alias(""), *blank).first().asDict()


def test_a_view_reads_the_columns_that_it_needs(spark):
    snap = create(table(spark, [(1, "a", 1), (2, "b", 2)], 1), scratch_path(spark, "t"), ["k"])
    following = snap.upsert(table(spark, [(1, "b", 7), (2, "b", 2), (3, None, 4)], 2), POLICY, COMPARE)
    assert sorted((r["sign"], r["k"], r["g"], r["v"]) for r in signed_rows(following.feed()).collect()) == [(-1, 1, "a", 1), (1, 1, "b", 7), (1, 3, None, 4)]
    for made in (snap, following):
        plan = delta(made.feed(), ("g",), {"v": "v"})._jdf.queryExecution().executedPlan().toString()
        read = "".join(line.split("ReadSchema:")[1] for line in plan.splitlines() if "ReadSchema:" in line)
        assert "g:string" in read and "staging_id" not in read and "row_source_file" not in read
