"""Analyses done after the report views (A1-A21), as Spark jobs over the views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.text import percent_text
from marketlake.operators import stats
from marketlake.plans import reports as R
from marketlake.plans.model import build_model, month_label, stored_items_by_month, stored_leaders

# Parameters with values inside the test tables' date range (1995-01 .. 2001-08).
BOX_QUARTER = "1998.Q2"
BURN_IN_AFTER = "1995-03"
PIVOT_START, PIVOT_END = "1995-04", "2001-07"


def _m(spark, sf_dir):
    return build_model(spark, sf_dir)


def _growth_of_months(spark, sf_dir, *ranges: tuple) -> DataFrame:
    """V13 from the items of some months only, right for the last months of each range.

    A range is (first, last, rows): labels, ``last`` may be None (open). Growth
    and T3M look at the rows before of the same segment, which need not be of
    adjacent months, so each range begins at the month of the ``rows``-th row up to ``first`` of
    the segment where that lies furthest back.
    """
    items, months = stored_items_by_month(spark, sf_dir)
    back = F.row_number().over(Window.partitionBy("market_segment").orderBy(F.desc("purchase_month")))  # a row per segment and month
    wanted = F.lit(False)
    for first, last, rows in ranges:
        known = months.filter(F.col("purchase_month") <= _index(first)).withColumn("back", back).filter(F.col("back") <= rows)
        begin = known.agg(F.min("purchase_month")).first()[0]
        month = F.col("purchase_month")
        wanted = wanted | ((month >= (_index(first) if begin is None else begin)) & (F.lit(True) if last is None else month <= _index(last)))
    items = items.filter(wanted).select("seller_sk", "price", month_label(F.col("purchase_month")).alias("monthly"))
    return R.month_growth(items, stored_leaders(spark, sf_dir))


def _index(month: str) -> int:
    year, number = month.split("-")
    return int(year) * 12 + int(number) - 1


def a1_box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: order volume box statistics by quarter x performance tier."""
    return stats.box_stats(R.v1_seller_quarterly(_m(spark, sf_dir)), "order_volume",
                           ["quarterly", "performance_tier"])


def a2_box_one_quarter(spark, sf_dir, quarter: str = BOX_QUARTER):
    """A2 + A3: box statistics of one quarter by tier, quarter split into year and number."""
    year, number = quarter.split(".Q")
    first = int(year) * 12 + 3 * (int(number) - 1)
    items = stored_items_by_month(spark, sf_dir)[0].filter(F.col("purchase_month").between(first, first + 2))
    volume = items.groupBy("seller_sk", F.lit(quarter).alias("quarterly")).agg(F.count_distinct("order_sk").alias("order_volume"))
    v1 = R.volume_tiers(volume)
    parts = F.split(F.col("quarterly"), r"\.")
    v1 = v1.select(parts[0].cast("int").alias("year"), parts[1].alias("quarter"), "performance_tier",
                   "order_volume")
    return stats.box_stats(v1, "order_volume", ["year", "quarter", "performance_tier"])


def a5_tier_counts(spark, sf_dir):
    """A5: sellers per delivery-reliability tier in tier order."""
    return stats.tier_counts(R.v4_seller_delay_tier(_m(spark, sf_dir)), "reliability_tier", R.RISK_TIERS)


def a6_percent_table(spark, sf_dir):
    """Segment delay table with renamed columns and percent strings."""
    v5 = R.v5_segment_delay_risk(_m(spark, sf_dir))
    return v5.select(F.col("market_segment").alias("Market Segment"),
                     percent_text(F.col("ldr")).alias("Late Delivery Rate"),
                     F.col("q1st").alias("Q1"), F.col("q3rd").alias("Q3"),
                     F.col("delivery_delay_risk").alias("Delay Risk"))


def a8_drop_first_month(spark, sf_dir):
    """A7 + A8: L6M rates with 'YYYY-MM' months, first month dropped, sorted."""
    v7 = R.v7_l6m_late_rate(_m(spark, sf_dir))
    v7 = v7.select("market_segment", F.date_format("monthly", "yyyy-MM").alias("month"),
                   "monthly_late_rate", "l6m_late_rate")
    return stats.drop_first(v7, "month").orderBy("market_segment", "month")


def a9_top_categories(spark, sf_dir):
    """Top 5 by revenue, top 3 by median price, top 5 by units (category tie-break)."""
    v9 = R.v9_category_performance(_m(spark, sf_dir))
    out = None
    for ranking, col, n in (("revenue", "total_revenue", 5), ("median_price", "median_price", 3),
                            ("units", "total_units", 5)):
        t = stats.top_n(v9, col, n, "product_category").select(
            F.lit(ranking).alias("ranking"), "product_category", F.col(col).cast("double").alias("value"))
        out = t if out is None else out.unionByName(t)
    return out


def a10_regression(spark, sf_dir):
    """A10: OLS of category revenue on units."""
    return stats.ols_fit(R.v9_category_performance(_m(spark, sf_dir)), "total_revenue", "total_units",
                         y_scale=100)


def a11_high_yield(spark, sf_dir):
    """Categories above the regression line by more than one SEE."""
    v9 = R.v9_category_performance(_m(spark, sf_dir)).select("product_category", "total_units", "total_revenue")
    return stats.above_see(v9, "total_revenue", "total_units").select("product_category", "total_units",
                                                                       "total_revenue")


def a12_shares(spark, sf_dir):
    """Revenue and unit shares (percent) of the top-5 segments and other."""
    v10 = stats.share_over(R.v10_top_categories(_m(spark, sf_dir)), "total_units")  # top_n + 1 rows
    return v10.select("market_segment", (F.col("perc_in_revenue") * 100).alias("revenue_pct"),
                      F.col("total_units_pct").alias("units_pct"))


def a13_tier_shares(spark, sf_dir):
    """V11 shares with the segment order taken from V10 (revenue rank, other last)."""
    m = _m(spark, sf_dir)
    v10 = R.v10_top_categories(m).select(
        "market_segment",
        F.when(F.col("market_segment") == "other", F.lit(None))
        .otherwise(F.col("total_revenue")).alias("_rev"))
    order = v10.select("market_segment", F.row_number().over(
        Window.orderBy(
            F.desc_nulls_last("_rev"), "market_segment")).alias("segment_order"))
    v11 = R.v11_price_tiers(m)
    # at most top_n + 1 segments: bounded broadcast
    return (v11.join(F.broadcast(order), "market_segment", "left")
            .select("segment_order", "market_segment", "price_tier", "global_revenue_share",
                    "category_revenue_share").orderBy("segment_order", "price_tier"))


def a14_a15_state_median(spark, sf_dir):
    """A14 + A15: median delivery days per state, and the national median of those."""
    v12 = R.v12_state_reliability(_m(spark, sf_dir))
    per_state = stats.grouped_median(v12, "median_delivery_days", ["seller_state"])
    # state medians have at most 3 decimals (x.xx5): exact in units of 1/200
    national = stats.grouped_median(per_state.withColumn("_all", F.lit(1)), "median_median_delivery_days",
                                    ["_all"], scale=200).select(F.col("median_median_median_delivery_days")
                                                                .alias("national_median_days"))
    return (per_state.withColumnRenamed("median_median_delivery_days", "state_median_days")
            .crossJoin(F.broadcast(national)).orderBy("state_median_days", "seller_state"))


def a16_reliability_mix(spark, sf_dir):
    """Share of deliveries per reliability class within each state."""
    return R.v12_state_reliability(_m(spark, sf_dir)).select("seller_state", "reliability", "perc_of_deliveries")


def a17_revenue_at_risk(spark, sf_dir):
    """Late-delivery revenue per state, largest first."""
    v12 = R.v12_state_reliability(_m(spark, sf_dir))
    return (v12.filter(F.col("reliability") == R.RELIABILITY[2])
            .select("seller_state", "total_revenue", "deliveries_count")
            .orderBy(F.desc_nulls_last("total_revenue"), "seller_state"))


def a19_burn_in(spark, sf_dir, after: str = BURN_IN_AFTER):
    """A18 + A19: monthly revenue and T3M per segment after the burn-in month."""
    v13 = _growth_of_months(spark, sf_dir, (after, None, 2))
    return stats.after(v13, "monthly", after).select("market_segment", "monthly", "this_month_revenue",
                                                     "t3m_revenue")


def a20_pivot_start_end(spark, sf_dir, start: str = PIVOT_START, end: str = PIVOT_END):
    """T3M revenue at the start and end month per segment and its change."""
    v13 = _growth_of_months(spark, sf_dir, (start, start, 3), (end, end, 3))
    return stats.pivot_start_end(v13, "market_segment", "monthly", "t3m_revenue", start, end)


def a21_axis_labels(spark, sf_dir):
    """The distinct month labels of the late-rate series, in order."""
    v7 = R.v7_l6m_late_rate(_m(spark, sf_dir))
    return (v7.select(F.date_format("monthly", "yyyy-MM").alias("month")).distinct()
            .orderBy(F.asc_nulls_last("month")))


QUERIES = {
    "a1_box_stats": a1_box_stats,
    "a2_box_one_quarter": a2_box_one_quarter,
    "a5_tier_counts": a5_tier_counts,
    "a6_percent_table": a6_percent_table,
    "a8_drop_first_month": a8_drop_first_month,
    "a9_top_categories": a9_top_categories,
    "a10_regression": a10_regression,
    "a11_high_yield": a11_high_yield,
    "a12_shares": a12_shares,
    "a13_tier_shares": a13_tier_shares,
    "a14_a15_state_median": a14_a15_state_median,
    "a16_reliability_mix": a16_reliability_mix,
    "a17_revenue_at_risk": a17_revenue_at_risk,
    "a19_burn_in": a19_burn_in,
    "a20_pivot_start_end": a20_pivot_start_end,
    "a21_axis_labels": a21_axis_labels,
}
