"""Joins on heavy keys: equal results, and no task far above the others."""

import statistics

import pytest
from pyspark.sql import functions as F

from marketlake.operators.skew import counted_semi_join, heavy_keys, salted_join


def facts(spark, n=60_000):
    """A third of the rows on key 1, a tenth on null, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 10 != 1, F.col("id") % 5000)
    return spark.range(n).select("id", key.cast("long").alias("k"), F.lit(2).alias("g"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_heavy_keys_are_found_with_their_part(spark):
    got = {r["hot"]: r["part"] for r in heavy_keys(facts(spark), ["k"], 100).collect()}
    one = spark.range(1).select(F.xxhash64(F.lit(1).cast("long"))).first()[0]
    assert len(got) <= 100 and abs(got[one] - 1 / 3) < 0.01


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    f = facts(spark, 3000).unionByName(facts(spark, 30))
    other = spark.range(0, 4000, 2).select(F.col("id").alias("k"), F.lit(2).alias("g"), F.col("id").alias("x"))
    other = other.unionByName(spark.createDataFrame([(1, 2, 7), (1, 2, 8), (1, 3, 9), (None, 2, 9)], "k long, g int, x long"))
    assert rows(salted_join(f, other, ["k", "g"], how, share=50)) == rows(f.join(other, ["k", "g"], how).select(*salted_join(f, other, ["k", "g"], how).columns))
    assert salted_join(f.limit(0), other, ["k", "g"], how).count() == 0
    with pytest.raises(ValueError):
        salted_join(f, other, ["k"], "full_outer")


def test_no_task_reads_over_twice_the_median(spark):
    other = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("x"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def per_task(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain, salted = per_task(facts(spark).join(other, "k", "left")), per_task(salted_join(facts(spark), other, ["k"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was[0])
        spark.conf.set("spark.sql.adaptive.enabled", was[1])
    assert sum(plain) == sum(salted) == 60_000
    assert max(plain) > 3 * statistics.median(plain) and max(salted) < 2 * statistics.median(salted)


def test_counted_semi_join(spark):
    f = facts(spark, 2000).filter("k IS NOT NULL")
    counts = f.groupBy("k").count().filter("count > 1")
    assert rows(counted_semi_join(f, counts, ["k"], "count", share=20)) == rows(f.join(counts, "k", "left_semi"))
    assert counted_semi_join(f, counts.limit(0), ["k"], "count").count() == 0


def test_even_pieces_follow_the_rows(spark):
    """A piece holds no more rows as a table grows; v12 joins and counts its orders in such pieces."""
    from marketlake.operators.skew import even_pieces

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert even_pieces(spark.range(10), per=100) == least
    assert even_pieces(spark.range(100_001), per=1000) == 101


def test_v12_joins_in_even_pieces(spark, monkeypatch):
    from marketlake.plans import reports
    from marketlake.plans.model import StarModel

    items = spark.createDataFrame([(1, 1, "2.50"), (1, 2, "1.00"), (2, 1, "4.00"), (3, 1, "9.00"), (None, 1, "7.00")], "order_sk long, seller_sk long, price string")
    orders = spark.sql("""SELECT * FROM VALUES (1L, '2024-01-01', '2024-01-03', '2024-01-05'), (1L, '2024-01-01', '2024-01-03', '2024-01-05'),
        (2L, '2024-01-01', '2024-01-05', '2024-01-09'), (3L, NULL, '2024-01-05', '2024-01-09') AS t(order_sk, a, d, e)""").select(
        "order_sk", *[F.col(c).cast("timestamp_ntz").alias(f"order_{n}_t") for c, n in (("a", "approved"), ("d", "delivered_customer"), ("e", "estimated_delivery"))])
    sellers = spark.createDataFrame([(1, "X")], "seller_sk long, seller_state string")
    m = StarModel(items.withColumn("price", F.col("price").cast("decimal(12,2)")), orders, sellers, None, None, None)
    seen, counted = [], reports.quantiles_from_counts
    monkeypatch.setattr(reports, "even_pieces", lambda rows: 13)
    monkeypatch.setattr(reports, "quantiles_from_counts", lambda counts, *a, **k: seen.append(counts) or counted(counts, *a, **k))
    out = [tuple(r) for r in reports.v12_state_reliability(m).collect()]
    # order 1 comes twice: its items count twice, the order once; order 3 was never approved
    assert [(r[0], r[1], r[2], r[3], float(r[5])) for r in out] == [("X", "1 - early", 9.0, 2, 2.0), ("unknown", "1 - early", 2.0, 1, 2.0)]
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("13), REPARTITION_BY_NUM") >= 2
