"""Micro-fixtures: one row per quirk (FIXTURES.md section 5)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake.functions import parse as P
from marketlake.functions.exact import round_ratio
from marketlake.functions.text import transliterate
from marketlake.operators import quality as Q
from marketlake.operators.dedup import collapse, latest_per_key
from marketlake.operators.keys import assign_sk
from marketlake.operators.segments import tier_by_thresholds
from marketlake.operators.stats import above_see
from marketlake.operators.upsert import scd1_upsert

TS = dt.datetime


def col(spark, values, name="x", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def values(df, c):
    return [r[c] for r in df.collect()]


def test_p2_blank_to_null(spark):
    df = col(spark, ["  ", " a ", None])
    assert values(df.select(P.blank_to_null("x").alias("y")), "y") == [None, "a", None]


def test_p3_guarded_number(spark):
    df = col(spark, ["12", "12.5", "12.", " 12 ", "-3", "n/a", "12\n"])
    got = values(df.select(P.guarded_number("x").alias("y")), "y")
    assert got == [Decimal("12.0000"), Decimal("12.5000"), None, None, None, None, None]


def test_p4_money(spark):
    df = col(spark, ["12.", "12.345", ".5"])
    assert values(df.select(P.guarded_money("x").alias("y")), "y") == [Decimal("12.00"), Decimal("12.35"), None]


def test_p6_score_range(spark):
    df = col(spark, ["0", "1", "5", "6", "x"])
    assert values(df.select(P.guarded_int("x", 1, 5).alias("y")), "y") == [None, 1, 5, None, None]


def test_p7_strict_and_p8_guarded(spark):
    df = col(spark, ["", "2017-10-02 10:56:33"])
    assert values(df.select(P.strict_ts("x").alias("y")), "y") == [None, TS(2017, 10, 2, 10, 56, 33)]
    bad = col(spark, ["soon"])
    with pytest.raises(PySparkException):
        bad.select(P.strict_ts("x")).collect()
    assert values(bad.select(P.guarded_ts("x").alias("y")), "y") == [None]
    impossible = col(spark, ["2017-13-45 00:00:00"])
    with pytest.raises(PySparkException):
        impossible.select(P.guarded_ts("x")).collect()
    assert values(impossible.select(P.guarded_ts("x", lenient=True).alias("y")), "y") == [None]


def test_p1_transliterate(spark):
    df = col(spark, ["São Paulo", None, "Straße Ærø"])
    assert values(transliterate(df), "x") == ["Sao Paulo", None, "Strasse AEro"]


def test_p1_punctuation_ordinals_and_combining_marks(spark):
    df = transliterate(col(spark, ["1º – “São” e\u0301 5€…", "ª’«»\u00a0x", None]))
    assert values(df, "x") == ['1o - "Sao" e 5EUR...', "a'<<>> x", None]


def test_k2_violation_rows(spark):
    df = spark.createDataFrame([("1", "x", "7"), ("2", "4", None), ("3", "y", "z")], "staging_id string, a string, b string")
    got = Q.violation_rows(df, {"a": Q.NUMBER_PATTERN, "b": Q.NUMBER_PATTERN}).collect()
    assert sorted(map(tuple, got)) == [("1", "a"), ("3", "a"), ("3", "b")]


def test_k4_missing_pct(spark):
    df = col(spark, ["a", " ", None])
    assert values(Q.missing_pct(df, ["x"]), "pct_missing_x") == [66.667]


def test_k5_near_duplicates(spark):
    df = col(spark, ["Sao Paulo", "sao paulo ", "rio"], "city")
    r = Q.near_duplicates(df, "city").collect()
    assert len(r) == 1 and r[0]["total_rows"] == 2 and r[0]["distinct_variants"] == 2
    assert r[0]["variants"] == "Sao Paulo|sao paulo "


def test_k2_zip_rule_never_fires(spark):
    df = col(spark, ["abc", "123"], "zip")
    assert Q.format_violations(df, {"zip": Q.ZIP_PATTERN}).count() == 0
    assert Q.format_violations(df, {"zip": Q.ZIP_PATTERN_STRICT}).count() == 1


def test_l1_latest_per_key(spark):
    df = spark.createDataFrame(
        [("k", "old", TS(2024, 1, 1), "a"), ("k", "new", TS(2024, 1, 2), "a"),
         ("j", "x", TS(2024, 1, 1), "a"), ("j", "y", TS(2024, 1, 1), "b")],
        "key string, v string, loaded_at timestamp_ntz, staging_id string")
    got = {r["key"]: r["v"] for r in latest_per_key(df, ["key"]).collect()}
    assert got == {"k": "new", "j": "y"}  # equal load time -> higher staging_id


def test_l2_collapse_mixes_rows(spark):
    df = spark.createDataFrame([("i", 10, "b"), ("i", 20, "a")], "k string, price int, product string")
    r = collapse(df, ["k"], max_cols=["price", "product"]).collect()[0]
    assert (r["price"], r["product"]) == (20, "b")


def _dim(spark, rows):
    return spark.createDataFrame(rows, "seller_id string, seller_city string, first_seen_at timestamp_ntz, "
                                       "last_seen_at timestamp_ntz, row_source_file string, staging_id string")


def test_l4_policies(spark):
    t1, t2 = TS(2024, 1, 1), TS(2024, 1, 2)
    existing = _dim(spark, [("a", "x", t1, t1, "f1", "s1"), ("b", "y", t1, t1, "f1", "s1"),
                            ("c", "z", t1, t1, "f1", "s1")])
    incoming = _dim(spark, [("a", None, t2, t2, "f1", "s2"),   # coalesce keeps x, audit updated
                            ("b", "y", t2, t2, "f1", "s2"),    # unchanged: untouched
                            ("d", "w", t2, t2, "f2", "s2")])   # insert
    out = {r["seller_id"]: r for r in scd1_upsert(existing, incoming, ["seller_id"], {"seller_city": "coalesce"},
                                                   ["seller_city", "row_source_file"]).collect()}
    assert out["a"]["seller_city"] == "x" and out["a"]["last_seen_at"] == t2 and out["a"]["staging_id"] == "s2"
    assert out["b"]["last_seen_at"] == t1 and out["b"]["staging_id"] == "s1"
    assert out["c"]["seller_city"] == "z" and out["d"]["seller_city"] == "w"
    # overwrite policy takes NULL; geo-style guard on the file only leaves the row untouched
    ow = scd1_upsert(existing, incoming, ["seller_id"], {"seller_city": "overwrite"}, ["seller_city"])
    assert {r["seller_id"]: r["seller_city"] for r in ow.collect()}["a"] is None
    geo = scd1_upsert(existing, incoming.withColumn("seller_city", F.lit("new")), ["seller_id"],
                      {"seller_city": "coalesce"}, ["row_source_file"])
    assert {r["seller_id"]: r["seller_city"] for r in geo.collect()}["b"] == "y"


def test_l4_idempotent(spark):
    t1, t2 = TS(2024, 1, 1), TS(2024, 1, 2)
    existing = _dim(spark, [("a", "x", t1, t1, "f1", "s1")])
    incoming = _dim(spark, [("a", None, t2, t2, "f2", "s2"), ("b", "q", t2, t2, "f2", "s2")])
    args = (["seller_id"], {"seller_city": "coalesce"}, ["seller_city", "row_source_file"])
    once = scd1_upsert(existing, incoming, *args)
    twice = scd1_upsert(once, incoming, *args)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_l7_surrogate_keys_stable(spark):
    df = spark.createDataFrame([(k,) for k in "abcdefgh"], "k string")
    first = {r["k"]: r["sk"] for r in assign_sk(df, ["k"], "sk").collect()}
    assert sorted(first.values()) == list(range(1, 9))
    more = assign_sk(df.union(spark.createDataFrame([("z",)], "k string")).join(
        spark.createDataFrame(list(first.items()), "k string, sk long"), "k", "left"), ["k"], "sk")
    again = {r["k"]: r["sk"] for r in more.collect()}
    assert all(again[k] == v for k, v in first.items()) and again["z"] == 9


def test_tiers_strict_vs_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5]], "v int")
    t = df.select("v", tier_by_thresholds(F.col("v"), F.lit(2.0), F.lit(4.0), ("low", "mid", "high"), False).alias("t"))
    assert {r["v"]: r["t"] for r in t.collect()} == {1: "low", 2: "mid", 3: "mid", 4: "mid", 5: "high"}
    r = spark.createDataFrame([(v,) for v in [0.0, 0.0, 0.0, 10.0]], "v double")
    t = r.select(tier_by_thresholds(F.col("v"), F.lit(0.0), F.lit(2.5), ("low", "mid", "high"), True).alias("t"))
    assert sorted(values(t, "t")) == ["high", "low", "low", "low"]


def test_exact_rounding_half_up(spark):
    df = spark.createDataFrame([(1, 16), (1, 2002), (1, 8)], "n long, d long")
    got = values(df.select(round_ratio(F.col("n"), F.col("d"), 3, times=100).alias("r")), "r")
    assert got == [6.3, 0.0, 12.5]


def test_a11_above_see(spark):
    pts = [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (5, 9.0)]
    df = spark.createDataFrame(pts, "x int, y double")
    assert [(r["x"], r["y"]) for r in above_see(df, "y", "x").collect()] == [(5, 9.0)]


def test_exact_quantiles_match_builtin(spark):
    import random
    from marketlake.operators.quantiles import exact_quantiles
    rnd = random.Random(7)
    probs = [0.0, 0.1, 0.33, 0.5, 0.66, 0.9, 1.0]
    for n, distinct in ((1, 1), (2, 2), (50, 5), (400, 1000)):
        rows = [(float(rnd.randrange(distinct)) / 4 if rnd.random() > 0.05 else None,) for _ in range(n)]
        rows[0] = (1.0,)
        df = spark.createDataFrame(rows, "v double")
        got = list(exact_quantiles(df, "v", probs, ranges=8).first())
        want = df.agg(F.percentile("v", probs)).first()[0]
        assert got == want, (n, got, want)


def test_quantile_ranges_stay_even_with_an_outlier_and_a_large_group(spark):
    from marketlake.operators.quantiles import grouped_quantiles, ranged
    df = spark.range(20_000).selectExpr("IF(id % 50 = 0, 'b', 'a') AS g", "id / 7.0D AS v").union(spark.sql("SELECT 'a', 1e12D"))
    sizes = [r["count"] for r in ranged(df, ["g"], "v", 16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_001 / 16
    got = {r["g"]: r["q0"] for r in grouped_quantiles(df, "v", ["g"], [0.5]).collect()}
    assert got == {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("p")).collect()}


def test_grouped_quantiles_match_builtin(spark):
    import random
    from marketlake.operators.quantiles import grouped_quantiles
    rnd = random.Random(11)
    rows = [(rnd.choice("abc") if rnd.random() > 0.1 else None,
             float(rnd.randrange(50)) if rnd.random() > 0.1 else None) for _ in range(600)]
    rows += [("only_nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9]
    got = {r["g"]: [r[f"q{i}"] for i in range(4)] for r in grouped_quantiles(df, "v", ["g"], probs).collect()}
    want = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", probs).alias("p")).collect()}
    assert {k: v for k, v in want.items() if v is not None} == {k: v for k, v in got.items() if v[0] is not None}


def test_offsets_in_time_text_are_taken_to_utc(spark):
    texts = {"2024-01-01 12:00:00": "2024-01-01 12:00:00", "2024-01-01 12:00:00+02": "2024-01-01 10:00:00", "2024-01-01 01:00:00 +0530": "2023-12-31 19:30:00",
             "2024-01-01 23:59:59.5-03:30": "2024-01-02 03:29:59.500000", "2024-01-01 12:00Z": "2024-01-01 12:00:00", "2024-02-29": "2024-02-29 00:00:00", None: None, " ": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = {r["t"]: r["s"] and str(r["s"]) for r in df.select("t", P.strict_ts("t").alias("s")).collect()}
            assert got == texts
            assert {r["t"]: r["s"] and str(r["s"]) for r in df.select("t", P.guarded_ts("t").alias("s")).collect()} == texts
        odd = spark.createDataFrame([("2024-13-01 10:00:00+02",), ("2024-01-01 10:00+2x",)], "t string")
        assert [r["s"] for r in odd.select(P.guarded_ts("t", lenient=True).alias("s")).collect()] == [None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
