"""Statistics over report frames (A-operators).

Grouped statistics are two-pass aggregates: per-group thresholds first
(a small frame, one row per group) joined back to the rows, then a second
aggregate. Nothing collects a group into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def box_stats(df: DataFrame, value: str, by: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """A1: Q1 / median / Q3, whiskers (extreme values inside Q1 - w*IQR .. Q3 + w*IQR)
    and the number of outliers per group."""
    q = df.groupBy(*by).agg(F.percentile(value, [0.25, 0.5, 0.75]).alias("_q"), F.count(value).alias("n"))
    q = q.select(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)], "n",
                 F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    # one row per group, as many as the caller's groups: AQE decides on a broadcast; NULL groups match too
    cond = None
    for i, b in enumerate(by):
        c = F.col(b).eqNullSafe(F.col(f"_g{i}"))
        cond = c if cond is None else cond & c
    j = df.select(*by, value).join(q, cond, "inner")
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - whisker * iqr, F.col("q3") + whisker * iqr
    v = F.col(value)
    inside = (v >= lo) & (v <= hi)
    return j.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("outliers"))


def tier_counts(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """A5: rows per tier in a fixed tier order, zero for empty tiers."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    tiers = counts.sparkSession.createDataFrame([(t, i + 1) for i, t in enumerate(order)], [col, "tier_order"])
    return (F.broadcast(tiers).join(counts, col, "left")
            .select(col, "tier_order", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
            .orderBy("tier_order"))


def drop_first(df: DataFrame, col: str) -> DataFrame:
    """Drop the rows of the global minimum of ``col`` (one-row broadcast)."""
    first = df.agg(F.min(col).alias("_first"))
    return df.crossJoin(F.broadcast(first)).filter(F.col(col) != F.col("_first")).drop("_first")


def top_n(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    """The n largest rows by ``col`` (``tie`` breaks ties), as a TakeOrderedAndProject."""
    return df.orderBy(F.desc_nulls_last(col), F.asc_nulls_last(tie)).limit(n)


def ols_fit(df: DataFrame, y: str, x: str, y_scale: int | None = None, x_scale: int = 1) -> DataFrame:
    """A10: least squares ``y ~ x``: slope, intercept, r, r2, n, slope std error.

    With ``y_scale`` (e.g. 100 for money) both variables are turned into
    integers (``round(v * scale)``) and the centred moments are computed
    exactly in decimal(38,0) (``n*sum(xy) - sum(x)*sum(y)`` etc.): no
    cancellation, and the few double operations after them give the same
    bits on any engine. Without it, Spark's ``regr_*`` aggregates are used.
    """
    if y_scale is None:
        yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
        fit = df.agg(
            F.regr_slope(yy, xx).alias("slope"), F.regr_intercept(yy, xx).alias("intercept"),
            F.corr(yy, xx).alias("r"), F.regr_r2(yy, xx).alias("r2"), F.regr_count(yy, xx).alias("n"),
            F.regr_sxx(yy, xx).alias("_sxx"), F.regr_syy(yy, xx).alias("_syy"), F.regr_sxy(yy, xx).alias("_sxy"))
        rss = F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx")
        se = F.when(F.col("n") > 2, F.sqrt(F.greatest(rss, F.lit(0.0)) / (F.col("n") - 2) / F.col("_sxx")))
        return fit.select("slope", "intercept", "r", "r2", "n", se.alias("slope_stderr"))
    dec = "decimal(38,0)"
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    yi = F.when(both, F.round(F.col(y).cast("double") * y_scale).cast(dec))
    xi = F.when(both, F.round(F.col(x).cast("double") * x_scale).cast(dec))
    m = df.agg(F.count(yi).cast("long").alias("n"), F.sum(xi).alias("sx"), F.sum(yi).alias("sy"),
               F.sum(xi * xi).alias("sxx"), F.sum(yi * yi).alias("syy"), F.sum(xi * yi).alias("sxy"))
    n = F.col("n").cast(dec)
    dxx = (n * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")  # n^2 * var(x), exact
    dyy = (n * F.col("syy") - F.col("sy") * F.col("sy")).cast("double")
    dxy = (n * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double")
    slope_i = dxy / dxx
    slope = slope_i / F.lit(float(y_scale)) * F.lit(float(x_scale))
    intercept = (F.col("sy").cast("double") - slope_i * F.col("sx").cast("double")) / F.col("n").cast("double") \
        / F.lit(float(y_scale))
    r = dxy / F.sqrt(dxx * dyy)
    se = F.sqrt(F.greatest(dyy - slope_i * dxy, F.lit(0.0)) / (F.col("n") - 2).cast("double") / dxx) \
        / F.lit(float(y_scale)) * F.lit(float(x_scale))
    ok = (F.col("n") > 1) & (dxx > 0)
    return m.select(F.when(ok, slope).alias("slope"), F.when(ok, intercept).alias("intercept"),
                    F.when(ok & (dyy > 0), r).alias("r"), F.when(ok & (dyy > 0), r * r).alias("r2"), "n",
                    F.when(ok & (F.col("n") > 2), se).alias("slope_stderr"))


def above_see(df: DataFrame, y: str, x: str) -> DataFrame:
    """Rows with ``y > y_hat + SEE`` where ``SEE = sqrt(sum(resid^2) / (n - 2))``.

    The one-row fit is broadcast; residuals are summed in a second pass
    (the closed form ``syy - sxy^2 / sxx`` cancels badly). n <= 2 gives no rows.
    """
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    fit = df.agg(F.regr_slope(yy, xx).alias("_b"), F.regr_intercept(yy, xx).alias("_a"),
                 F.regr_count(yy, xx).alias("_n"))
    j = df.crossJoin(F.broadcast(fit))
    pred = F.col("_a") + F.col("_b") * xx
    see = j.agg(F.sqrt(F.sum((yy - pred) * (yy - pred)) / (F.max("_n") - 2)).alias("_see"))
    out = j.crossJoin(F.broadcast(see)).filter((F.col("_n") > 2) & (yy > pred + F.col("_see")))
    return out.select(*df.columns, pred.alias("predicted"), F.col("_see").alias("see"))


def share_over(df: DataFrame, col: str, by: Sequence[str] = (), percent: bool = True) -> DataFrame:
    """``col`` as a share of its total (within ``by`` groups), as a double.

    A window over the frame: meant for aggregated frames (segments, tiers).
    """
    w = Window.partitionBy(*by)
    share = F.col(col).cast("double") / F.sum(col).over(w).cast("double")
    return df.withColumn(f"{col}_pct" if percent else f"{col}_share", share * 100 if percent else share)


def after(df: DataFrame, col: str, start: str) -> DataFrame:
    """Rows whose ``col`` sorts after ``start`` (burn-in cut, string compare)."""
    return df.filter(F.col(col) > F.lit(start))


def grouped_median(df: DataFrame, col: str, by: Sequence[str], scale: int = 100) -> DataFrame:
    """Exact median per group of a value with ``log10(scale)`` decimals.

    The median is taken over integer units (value * scale) so it is exact;
    the middle of two values is returned as ``(a + b) / 2``.
    """
    units = F.round(F.col(col) * scale).cast("long")
    g = df.groupBy(*by).agg(F.percentile(units, 0.5).alias("_m"))
    return g.select(*by, (F.round(F.col("_m") * 2).cast("long") / F.lit(2.0 * scale)).alias(f"median_{col}"))


def pivot_start_end(df: DataFrame, key: str, month: str, value: str, start: str, end: str) -> DataFrame:
    """Value at ``start`` and ``end`` per key side by side, plus the change."""
    p = (df.filter(F.col(month).isin(start, end)).groupBy(key).pivot(month, [start, end])
         .agg(F.max(value)))
    return p.select(key, F.col(f"`{start}`").alias("start_value"), F.col(f"`{end}`").alias("end_value"),
                    (F.col(f"`{end}`") - F.col(f"`{start}`")).alias("net_change"))
