"""Report views V1-V13 over the star model.

Each view is a pure function ``StarModel -> DataFrame`` (lazy). Shared
shapes:

* money is summed as exact decimals and returned as double;
* count and money ratios are rounded with exact integer arithmetic
  (``functions.exact``) so the last digit never depends on binary floats;
* per-quarter thresholds are aggregated and joined back (one row per
  quarter, broadcast); the global per-seller thresholds of V4 are a
  one-row aggregate cross-joined by broadcast; thresholds over the few
  segment rows of V5 and all rankings / shares over categories are
  windows over those aggregated frames;
* windows only run over aggregated frames (segments x months,
  states x tiers, categories, top-5 + other), never over raw rows, and
  each view scans the stored item fact once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.exact import cents, ratio, round_ratio
from marketlake.operators.quantiles import quantiles_from_counts, ranged, total_quantiles
from marketlake.operators.segments import (category_name, market_leaders, segment_by_leader,
                                           tier_by_thresholds, top_n_flag)
from marketlake.operators.skew import even_pieces
from marketlake.plans.model import StarModel

VOLUME_TIERS = ("1 - low", "2 - mid", "3 - high")
RISK_TIERS = ("1 - low risk", "2 - medium risk", "3 - high risk")
PRICE_TIERS = ("1 - low", "2 - medium", "3 - high")
RELIABILITY = ("1 - early", "2 - timely", "3 - late")


def quarter_label(ts) -> F.Column:
    return F.concat(F.year(ts).cast("string"), F.lit(".Q"), F.quarter(ts).cast("string"))


def _is_late_by_day(est="order_estimated_delivery_t", dlv="order_delivered_customer_t"):
    return F.when(F.to_date(est) < F.to_date(dlv), 1).otherwise(0)


def _delivered_with_estimate(m: StarModel) -> DataFrame:
    return m.dim_orders.filter(F.col("order_estimated_delivery_t").isNotNull()
                               & F.col("order_delivered_customer_t").isNotNull())


def seller_periodic_volume(m: StarModel) -> DataFrame:
    """Distinct known orders per (seller, purchase quarter); items without an order row count none."""
    known = m.dim_orders.select(F.col("order_sk").alias("known_order"), "order_purchase_t")
    items = m.fact_items.select("seller_sk", "order_sk")
    base = items.join(known, items["order_sk"] == known["known_order"], "left")
    return (base.groupBy("seller_sk", quarter_label(F.col("order_purchase_t")).alias("quarterly"))
            .agg(F.count_distinct("known_order").alias("order_volume")))


def v1_seller_quarterly(m: StarModel) -> DataFrame:
    return volume_tiers(seller_periodic_volume(m))


def volume_tiers(spv: DataFrame) -> DataFrame:
    """V1 from (seller_sk, quarterly, order_volume)."""
    # One row per quarter: bounded by the calendar span, broadcast.
    thr = spv.groupBy(F.col("quarterly").alias("_q")).agg(
        F.percentile("order_volume", 0.25).alias("vol_p25"),
        F.percentile("order_volume", 0.75).alias("vol_p75"))
    # Null-safe join keeps both branches' plans identical (no inferred IS NOT NULL filter),
    # so AQE reuses the spv shuffle; a NULL quarter still gets no thresholds (SQL '=' semantics).
    j = spv.join(F.broadcast(thr), F.col("quarterly").eqNullSafe(F.col("_q")), "left")
    known = F.col("quarterly").isNotNull()
    j = j.select("seller_sk", "order_volume", "quarterly",
                 F.when(known, F.col("vol_p25")).alias("vol_p25"), F.when(known, F.col("vol_p75")).alias("vol_p75"))
    return (j.select(
        F.col("seller_sk").alias("seller_id"), "order_volume", "quarterly",
        "vol_p25", "vol_p75",
        tier_by_thresholds(F.col("order_volume"), F.col("vol_p25"), F.col("vol_p75"),
                           VOLUME_TIERS, low_inclusive=False).alias("performance_tier"))
        .orderBy(F.asc_nulls_last("quarterly"), F.asc_nulls_last("seller_id")))


def v2_market_leaders(m: StarModel, n: int = 3) -> DataFrame:
    return market_leaders(m.fact_items, n=n)


def _leaders(m: StarModel, leaders: DataFrame | None) -> DataFrame:
    """Explicit leaders, else the stored leaders view, else computed from the fact."""
    if leaders is not None:
        return leaders
    return m.leaders if m.leaders is not None else v2_market_leaders(m)


def v3_segment_median(m: StarModel, leaders: DataFrame | None = None) -> DataFrame:
    leaders = _leaders(m, leaders)
    seg = segment_by_leader(seller_periodic_volume(m), leaders)
    out = seg.groupBy("quarterly", "market_segment").agg(
        F.percentile("order_volume", 0.5).alias("median_segment_volume"))
    return out.orderBy(F.asc_nulls_last("quarterly"),
                       F.when(F.col("market_segment") == "residual", 1).otherwise(0),
                       "market_segment")


def v4_seller_delay_tier(m: StarModel) -> DataFrame:
    idl = _delivered_with_estimate(m).select("order_sk", _is_late_by_day().alias("is_late"))
    pairs = (idl.join(m.fact_items.select("order_sk", "seller_sk"), "order_sk", "left")
             .select("seller_sk", "order_sk", "is_late").distinct())
    sv = pairs.groupBy("seller_sk").agg(F.count("order_sk").alias("order_volume"),
                                        F.sum("is_late").alias("late"))
    rates = sv.select("seller_sk",
                      round_ratio(F.col("late"), F.col("order_volume"), 3, times=100)
                      .alias("late_delivery_rate"))
    thr = rates.agg(F.percentile("late_delivery_rate", [0.25, 0.75]).alias("q"))
    thr = thr.select(F.col("q")[0].alias("vol_p25"), F.col("q")[1].alias("vol_p75"))
    j = rates.crossJoin(F.broadcast(thr))  # one row
    return (j.select(
        F.col("seller_sk").alias("seller_id"), "late_delivery_rate", "vol_p25", "vol_p75",
        tier_by_thresholds(F.col("late_delivery_rate"), F.col("vol_p25"), F.col("vol_p75"),
                           RISK_TIERS, low_inclusive=True).alias("reliability_tier"))
        .orderBy(F.asc_nulls_last("seller_id")))


def v5_segment_delay_risk(m: StarModel, leaders: DataFrame | None = None) -> DataFrame:
    leaders = _leaders(m, leaders)
    idl = (_delivered_with_estimate(m).select("order_sk", _is_late_by_day().alias("is_late"))
           .join(m.fact_items.select("order_sk", "seller_sk"), "order_sk", "inner"))
    seg = segment_by_leader(idl, leaders)
    s = seg.groupBy("market_segment").agg(F.count_distinct("order_sk").alias("order_volume"),
                                          F.sum("is_late").alias("late"))
    rates = s.select("market_segment",
                     round_ratio(F.col("late"), F.col("order_volume"), 3, times=100).alias("ldr"))
    # one row per segment (leaders + residual): thresholds as a window over those rows
    q = F.percentile("ldr", [0.25, 0.75]).over(Window.partitionBy())
    j = rates.select("*", q.alias("q")).select("market_segment", "ldr", F.col("q")[0].alias("q1st"),
                                               F.col("q")[1].alias("q3rd"))
    return (j.select("market_segment", "ldr", "q1st", "q3rd",
                     tier_by_thresholds(F.col("ldr"), F.col("q1st"), F.col("q3rd"), RISK_TIERS,
                                        low_inclusive=True).alias("delivery_delay_risk"))
            .orderBy("market_segment"))


def v6_late_counts(m: StarModel, leaders: DataFrame | None = None) -> DataFrame:
    leaders = _leaders(m, leaders)
    ovs = (segment_by_leader(m.fact_items.select("order_sk", "seller_sk"), leaders)
           .select("order_sk", "market_segment").distinct())
    o = _delivered_with_estimate(m).join(ovs, "order_sk", "inner")
    late = F.when(F.col("order_delivered_customer_t") > F.col("order_estimated_delivery_t"), 1).otherwise(0)
    month = F.to_date(F.date_trunc("month", F.col("order_estimated_delivery_t")))
    return o.groupBy("market_segment", month.alias("monthly")).agg(
        F.count_distinct("order_sk").alias("order_volume"),
        F.sum(late).cast("long").alias("late_deliv_count"))


def _month_index(c):
    return F.year(c) * 12 + F.month(c)


def v7_l6m_late_rate(m: StarModel, late_counts: DataFrame | None = None,
                     months_back: int = 5) -> DataFrame:
    v6 = late_counts if late_counts is not None else v6_late_counts(m)
    # Calendar-aware frame: RANGE over a month index == INTERVAL 'n' MONTH on a month start.
    w = (Window.partitionBy("market_segment").orderBy(_month_index(F.col("monthly")))
         .rangeBetween(-months_back, 0))
    return v6.select(
        "market_segment", "monthly", "order_volume", "late_deliv_count",
        round_ratio(F.col("late_deliv_count"), F.col("order_volume"), 3).alias("monthly_late_rate"),
        round_ratio(F.sum("late_deliv_count").over(w), F.sum("order_volume").over(w), 3)
        .alias("l6m_late_rate"))


def v8_delay_rank(m: StarModel, late_counts: DataFrame | None = None) -> DataFrame:
    v6 = late_counts if late_counts is not None else v6_late_counts(m)
    v6 = v6.filter(F.col("order_volume") > 0)
    w = Window.partitionBy("monthly").orderBy(
        F.desc_nulls_first(ratio(F.col("late_deliv_count"), F.col("order_volume"))))
    return v6.select(
        "market_segment", "monthly",
        round_ratio(F.col("late_deliv_count"), F.col("order_volume"), 3).alias("monthly_late_rate"),
        F.rank().over(w).cast("long").alias("delay_risk_rank"))


def _sold(m: StarModel) -> DataFrame:
    """(product_sk, price, units, revenue): the maintained sums, or a row per item."""
    if m.sold is not None:
        return m.sold
    return m.fact_items.select("product_sk", "price", F.lit(1).cast("long").alias("units"), F.col("price").alias("revenue"))


def v9_category_performance(m: StarModel) -> DataFrame:
    items = _sold(m).filter(F.col("price") > 0).select("product_sk", "price", "units")
    cat = category_name(items, m.dim_products, m.lookup_prod_cat)
    # One pass over the fact: value counts per (category, price) carry the revenue,
    # the units and the exact median (running count over the category's distinct prices).
    vc = cat.groupBy(F.col("category").alias("product_category"), "price").agg(F.sum("units").alias("_c"))
    g = quantiles_from_counts(vc, "price", "_c", ["product_category"], [0.5], ["median_price"],
                              carry={"_rev": F.col("price") * F.col("_c"), "total_units": F.col("_c")})
    # one row per category: the share-of-total window runs over the aggregated frame
    total = F.sum("_rev").over(Window.partitionBy())
    return g.select("product_category", F.col("_rev").cast("double").alias("total_revenue"),
                    "median_price", "total_units",
                    round_ratio(cents(F.col("_rev")), cents(total), 4).alias("perc_in_revenue"))


def _category_metrics(m: StarModel) -> DataFrame:
    cat = category_name(_sold(m).select("product_sk", "units", "revenue"), m.dim_products, m.lookup_prod_cat)
    return cat.groupBy("category").agg(F.sum("revenue").alias("cat_revenue"),
                                       F.sum("units").alias("units_sold"))


def v10_top_categories(m: StarModel, top_n: int = 5) -> DataFrame:
    cm = _category_metrics(m)
    # one row per category from here on: ranking and share windows run on this frame
    seg = cm.select(
        F.when(top_n_flag("category", "cat_revenue", top_n), F.col("category"))
        .otherwise(F.lit("other")).alias("market_segment"), "cat_revenue", "units_sold")
    g = seg.groupBy("market_segment").agg(F.sum("units_sold").alias("total_units"),
                                          F.sum("cat_revenue").alias("_rev"))
    w = Window.partitionBy()  # at most top_n + 1 rows
    return (g.select("market_segment", "total_units", F.col("_rev").cast("double").alias("total_revenue"),
                     ratio(cents(F.col("_rev")), cents(F.sum("_rev").over(w))).alias("perc_in_revenue"))
            .orderBy(F.desc_nulls_first("total_revenue")))


def v11_price_tiers(m: StarModel, top_n: int = 5, price_q=(0.33, 0.66)) -> DataFrame:
    # one scan of the fact: stored value counts per (category, price) give the global
    # thresholds, the tiers and the revenue
    cat = category_name(_sold(m), m.dim_products, m.lookup_prod_cat)
    vc = cat.groupBy("category", "price").agg(F.sum("units").alias("_c"), F.sum("revenue").alias("_rev"))
    vc = ranged(vc, [], "price")
    thr = total_quantiles(vc, "price", "_c", list(price_q), ["price_p33", "price_p66"])
    tier = (F.when(F.col("price") <= F.col("price_p33"), PRICE_TIERS[0])
            .when(F.col("price") <= F.col("price_p66"), PRICE_TIERS[1]).otherwise(PRICE_TIERS[2]))
    # ranking, segments and shares are derived from this categories x 3 frame
    ct = (vc.crossJoin(F.broadcast(thr)).select("category", tier.alias("price_tier"), "_rev")  # one row
          .groupBy("category", "price_tier").agg(F.sum("_rev").alias("_rev")))
    ct = ct.select("*", F.sum("_rev").over(Window.partitionBy("category")).alias("cat_revenue"))
    seg = ct.select(
        F.when(top_n_flag("category", "cat_revenue", top_n), F.col("category"))
        .otherwise(F.lit("other")).alias("market_segment"), "price_tier", "_rev")
    g = seg.groupBy("market_segment", "price_tier").agg(F.sum("_rev").alias("_rev"))
    # (top_n + 1) x 3 rows: the share windows are bounded
    rev = cents(F.col("_rev"))
    return (g.select("market_segment", "price_tier", F.col("_rev").cast("double").alias("total_revenue"),
                     round_ratio(rev, F.sum(rev).over(Window.partitionBy()), 4).alias("global_revenue_share"),
                     round_ratio(rev, F.sum(rev).over(Window.partitionBy("market_segment")), 4)
                     .alias("category_revenue_share"))
            .orderBy("market_segment", "price_tier"))


def v12_state_reliability(m: StarModel) -> DataFrame:
    o = m.dim_orders.filter(F.col("order_delivered_customer_t").isNotNull()
                            & F.col("order_approved_t").isNotNull())
    items = (m.fact_items.select("order_sk", "seller_sk", "price")
             .join(m.dim_sellers.select("seller_sk", "seller_state"), "seller_sk", "left"))
    o = o.select("order_sk", "order_approved_t", "order_delivered_customer_t", "order_estimated_delivery_t")
    # the distinct orders are counted where the join deals them: pieces by the number of items, so that no task's share grows
    pieces = even_pieces(m.fact_items)
    base = items.repartition(pieces, "order_sk").join(o.repartition(pieces, "order_sk"), "order_sk", "inner")
    est = F.to_date("order_estimated_delivery_t")
    dlv = F.to_date("order_delivered_customer_t")
    rel = F.when(est > dlv, RELIABILITY[0]).when(est < dlv, RELIABILITY[2]).otherwise(RELIABILITY[1])
    secs = F.timestamp_diff("SECOND", F.col("order_approved_t"), F.col("order_delivered_customer_t"))
    b = base.select(F.coalesce("seller_state", F.lit("unknown")).alias("seller_state"),
                    "order_sk", "price", rel.alias("reliability"), secs.alias("secs"))
    # One pass: per (state, reliability, seconds) item counts, revenue and distinct orders.
    # Seconds are a function of the order, so distinct orders add up across seconds values;
    # the exact median comes from the item counts (in ranges: one state may hold most deliveries).
    vc = b.groupBy("seller_state", "reliability", "secs").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("price").alias("_rev"), F.count_distinct("order_sk").alias("_o"))
    g = quantiles_from_counts(vc, "secs", "_c", ["seller_state", "reliability"], [0.5], ["_med"],
                              carry={"_rev": F.col("_rev"), "deliveries_count": F.col("_o")})
    w = Window.partitionBy("seller_state")  # states x 3 rows
    twice_median = F.round(F.col("_med") * 2).cast("long")
    return (g.select(
        "seller_state", "reliability", F.col("_rev").cast("double").alias("total_revenue"),
        "deliveries_count",
        round_ratio(F.col("deliveries_count"), F.sum("deliveries_count").over(w), 4).alias("perc_of_deliveries"),
        round_ratio(twice_median, F.lit(2 * 86400), 2).alias("median_delivery_days"))
        .orderBy("seller_state", "reliability"))


def v13_mom_growth(m: StarModel, leaders: DataFrame | None = None) -> DataFrame:
    leaders = _leaders(m, leaders)
    items = m.fact_items.select("order_sk", "seller_sk", "price").join(
        m.dim_orders.select("order_sk", "order_purchase_t"), "order_sk", "left")
    return month_growth(items.select("seller_sk", "price", F.date_format("order_purchase_t", "yyyy-MM").alias("monthly")), leaders)


def month_growth(items: DataFrame, leaders: DataFrame) -> DataFrame:
    """V13 from (seller_sk, price, monthly) per item."""
    seg = segment_by_leader(items, leaders)
    g = seg.groupBy("market_segment", "monthly").agg(F.sum("price").alias("_rev"),
                                                     F.count_distinct("seller_sk").alias("_sellers"))
    this = F.when(F.col("market_segment") == "residual",
                  ratio(F.col("_rev"), F.col("_sellers"))).otherwise(F.col("_rev").cast("double"))
    w = Window.partitionBy("market_segment").orderBy(F.asc_nulls_last("monthly"))
    r = g.select("market_segment", "monthly", this.alias("this_month_revenue"))
    r = r.select("*", F.lag("this_month_revenue", 1).over(w).alias("prior_month_revenue"),
                 F.lag("this_month_revenue", 2).over(w).alias("_prior2"))
    terms = [F.col("_prior2"), F.col("prior_month_revenue"), F.col("this_month_revenue")]
    n = sum(t.isNotNull().cast("int") for t in terms)
    # AVG over ROWS 2 PRECEDING: mean of the non-null values among the three
    total = F.coalesce(terms[0], F.lit(0.0)) + F.coalesce(terms[1], F.lit(0.0)) + F.coalesce(terms[2], F.lit(0.0))
    t3m = F.when(n > 0, total / n)
    growth = F.round((F.col("this_month_revenue") - F.col("prior_month_revenue"))
                     / F.nullif(F.col("prior_month_revenue"), F.lit(0.0)) * 100, 2)
    return (r.select("market_segment", "monthly", "this_month_revenue", "prior_month_revenue",
                     t3m.alias("t3m_revenue"), growth.alias("mom_growth_pct"))
            .filter(F.col("prior_month_revenue").isNotNull())
            .orderBy("market_segment", "monthly"))
