"""DuckDB SQL for the analyses (A-ids), over the report views as CTEs."""

from __future__ import annotations

from marketlake.plans.oracle_sql import with_views

# Stated here too: a parameter that is wrong in the queries must not pass.
BOX_QUARTER = "1998.Q2"
BURN_IN_AFTER = "1995-03"
PIVOT_START, PIVOT_END = "1995-04", "2001-07"


def _box(src: str, by: list[str]) -> str:
    keys = ", ".join(by)
    on = " AND ".join(f"s.{b} IS NOT DISTINCT FROM q.{b}" for b in by)
    inside = "(s.order_volume >= q.q1 - 1.5 * (q.q3 - q.q1) AND s.order_volume <= q.q3 + 1.5 * (q.q3 - q.q1))"
    return f"""
, src AS ({src})
, q AS (
    SELECT {keys}, COUNT(order_volume) AS n, quantile_cont(order_volume, 0.25) AS q1,
           quantile_cont(order_volume, 0.5) AS median, quantile_cont(order_volume, 0.75) AS q3
    FROM src GROUP BY {keys}
)
SELECT {', '.join('s.' + b for b in by)}, q.n, q.q1, q.median, q.q3,
       MIN(CASE WHEN {inside} THEN s.order_volume END) AS whisker_low,
       MAX(CASE WHEN {inside} THEN s.order_volume END) AS whisker_high,
       CAST(SUM(CASE WHEN {inside} THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM src s JOIN q ON {on}
GROUP BY {', '.join('s.' + b for b in by)}, q.n, q.q1, q.median, q.q3"""


def _top(ranking: str, col: str, n: int) -> str:
    return (f"(SELECT '{ranking}' AS ranking, product_category, CAST({col} AS DOUBLE) AS value FROM v9 "
            f"ORDER BY {col} DESC NULLS LAST, product_category LIMIT {n})")


QUERIES = {
    "a1_box_stats": with_views(["v1"], _box("SELECT quarterly, performance_tier, order_volume FROM v1",
                                            ["quarterly", "performance_tier"])),
    "a2_box_one_quarter": with_views(["v1"], _box(
        "SELECT CAST(split_part(quarterly, '.', 1) AS INTEGER) AS year, split_part(quarterly, '.', 2) AS quarter, "
        f"performance_tier, order_volume FROM v1 WHERE quarterly = '{BOX_QUARTER}'",
        ["year", "quarter", "performance_tier"])),
    "a5_tier_counts": with_views(["v4"], """
SELECT t.reliability_tier, CAST(t.tier_order AS BIGINT) AS tier_order, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('1 - low risk', 1), ('2 - medium risk', 2), ('3 - high risk', 3)) t(reliability_tier, tier_order)
LEFT JOIN (SELECT reliability_tier, COUNT(*) AS n FROM v4 GROUP BY 1) c ON c.reliability_tier = t.reliability_tier
ORDER BY t.tier_order"""),
    "a6_percent_table": with_views(["v5"], """
SELECT market_segment AS "Market Segment", printf('%.1f%%', ldr) AS "Late Delivery Rate",
       q1st AS "Q1", q3rd AS "Q3", delivery_delay_risk AS "Delay Risk"
FROM v5"""),
    "a8_drop_first_month": with_views(["v7"], """
, m AS (SELECT market_segment, strftime(monthly, '%Y-%m') AS month, monthly_late_rate, l6m_late_rate FROM v7)
SELECT * FROM m WHERE month <> (SELECT MIN(month) FROM m) ORDER BY market_segment, month"""),
    "a9_top_categories": with_views(["v9"], "\nSELECT * FROM " + _top("revenue", "total_revenue", 5)
                                    + " a UNION ALL SELECT * FROM " + _top("median_price", "median_price", 3)
                                    + " b UNION ALL SELECT * FROM " + _top("units", "total_units", 5) + " c"),
    "a10_regression": with_views(["v9"], """
, i AS (
    SELECT CAST(round(total_revenue * 100) AS HUGEINT) AS y, CAST(total_units AS HUGEINT) AS x
    FROM v9 WHERE total_revenue IS NOT NULL AND total_units IS NOT NULL
), m AS (
    SELECT COUNT(y) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * x) AS sxx, SUM(y * y) AS syy, SUM(x * y) AS sxy FROM i
), d AS (
    SELECT n, sx, sy,
           CAST(n * sxx - sx * sx AS DOUBLE) AS dxx, CAST(n * syy - sy * sy AS DOUBLE) AS dyy,
           CAST(n * sxy - sx * sy AS DOUBLE) AS dxy
    FROM m
)
SELECT CASE WHEN n > 1 AND dxx > 0 THEN dxy / dxx / 100.0 * 1.0 END AS slope,
       CASE WHEN n > 1 AND dxx > 0 THEN (CAST(sy AS DOUBLE) - dxy / dxx * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) / 100.0 END
           AS intercept,
       CASE WHEN n > 1 AND dxx > 0 AND dyy > 0 THEN dxy / sqrt(dxx * dyy) END AS r,
       CASE WHEN n > 1 AND dxx > 0 AND dyy > 0 THEN (dxy / sqrt(dxx * dyy)) * (dxy / sqrt(dxx * dyy)) END AS r2,
       CAST(n AS BIGINT) AS n,
       CASE WHEN n > 2 AND dxx > 0 THEN sqrt(greatest(dyy - dxy / dxx * dxy, 0.0) / CAST(n - 2 AS DOUBLE) / dxx)
                                        / 100.0 * 1.0 END AS slope_stderr
FROM d"""),
    "a11_high_yield": with_views(["v9"], """
, f AS (
    SELECT regr_slope(CAST(total_revenue AS DOUBLE), CAST(total_units AS DOUBLE)) AS b,
           regr_intercept(CAST(total_revenue AS DOUBLE), CAST(total_units AS DOUBLE)) AS a,
           regr_count(CAST(total_revenue AS DOUBLE), CAST(total_units AS DOUBLE)) AS n
    FROM v9
), p AS (
    SELECT v9.product_category, v9.total_units, v9.total_revenue,
           f.a + f.b * CAST(v9.total_units AS DOUBLE) AS pred, f.n
    FROM v9 CROSS JOIN f
), s AS (
    SELECT sqrt(SUM((total_revenue - pred) * (total_revenue - pred)) / (MAX(n) - 2)) AS see FROM p
)
SELECT product_category, total_units, total_revenue
FROM p CROSS JOIN s WHERE n > 2 AND total_revenue > pred + see"""),
    "a12_shares": with_views(["v10"], """
SELECT market_segment, perc_in_revenue * 100 AS revenue_pct,
       CAST(total_units AS DOUBLE) / CAST(SUM(total_units) OVER () AS DOUBLE) * 100 AS units_pct
FROM v10"""),
    "a13_tier_shares": with_views(["v10", "v11"], """
, o AS (
    SELECT market_segment,
           ROW_NUMBER() OVER (ORDER BY CASE WHEN market_segment = 'other' THEN NULL ELSE total_revenue END
                              DESC NULLS LAST, market_segment) AS segment_order
    FROM v10
)
SELECT CAST(o.segment_order AS INTEGER) AS segment_order, v11.market_segment, v11.price_tier,
       v11.global_revenue_share, v11.category_revenue_share
FROM v11 LEFT JOIN o ON v11.market_segment = o.market_segment"""),
    "a14_a15_state_median": with_views(["v12"], """
, st AS (
    SELECT seller_state,
           CAST(round(quantile_cont(CAST(round(median_delivery_days * 100) AS BIGINT), 0.5) * 2) AS BIGINT) / 200.0
               AS state_median_days
    FROM v12 GROUP BY seller_state
), nat AS (
    SELECT CAST(round(quantile_cont(CAST(round(state_median_days * 200) AS BIGINT), 0.5) * 2) AS BIGINT) / 400.0
               AS national_median_days
    FROM st
)
SELECT seller_state, state_median_days, national_median_days FROM st CROSS JOIN nat"""),
    "a16_reliability_mix": with_views(["v12"], "SELECT seller_state, reliability, perc_of_deliveries FROM v12"),
    "a17_revenue_at_risk": with_views(["v12"], """
SELECT seller_state, total_revenue, deliveries_count FROM v12 WHERE reliability = '3 - late'
ORDER BY total_revenue DESC NULLS LAST, seller_state"""),
    "a19_burn_in": with_views(["v13"], f"""
SELECT market_segment, monthly, this_month_revenue, t3m_revenue FROM v13 WHERE monthly > '{BURN_IN_AFTER}'"""),
    "a20_pivot_start_end": with_views(["v13"], f"""
SELECT market_segment,
       MAX(CASE WHEN monthly = '{PIVOT_START}' THEN t3m_revenue END) AS start_value,
       MAX(CASE WHEN monthly = '{PIVOT_END}' THEN t3m_revenue END) AS end_value,
       MAX(CASE WHEN monthly = '{PIVOT_END}' THEN t3m_revenue END)
         - MAX(CASE WHEN monthly = '{PIVOT_START}' THEN t3m_revenue END) AS net_change
FROM v13 WHERE monthly IN ('{PIVOT_START}', '{PIVOT_END}') GROUP BY market_segment"""),
    "a21_axis_labels": with_views(["v7"], """
SELECT DISTINCT strftime(monthly, '%Y-%m') AS month FROM v7 ORDER BY month NULLS LAST"""),
}
