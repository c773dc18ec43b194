"""Segmentation helpers shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def market_leaders(items: DataFrame, n: int = 3, seller: str = "seller_sk",
                   order: str = "order_sk") -> DataFrame:
    """V2: top ``n`` sellers by distinct orders, labelled ``leader_01`` ...

    The per-seller count is a distributed two-level aggregate; the top-n is a
    ``TakeOrderedAndProject`` (each partition keeps n rows), so no raw rows
    meet in one task. The label window then runs over n rows only.
    Ties on the count are broken by the seller key (the reference leaves
    them arbitrary).
    """
    counts = items.groupBy(seller).agg(F.count_distinct(order).alias("_orders"))
    ordering = [F.desc("_orders"), F.asc_nulls_last(seller)]
    top = counts.orderBy(*ordering).limit(n)
    label = F.concat(F.lit("leader_0"), F.row_number().over(Window.orderBy(*ordering)).cast("string"))
    return top.select(seller, label.alias("leader_label"))


def segment_by_leader(df: DataFrame, leaders: DataFrame, seller: str = "seller_sk") -> DataFrame:
    """``COALESCE(leader_label, 'residual') AS market_segment``.

    ``leaders`` has at most n (=3) rows, so broadcasting it is bounded.
    """
    seg = F.coalesce(F.col("leader_label"), F.lit("residual")).alias("market_segment")
    joined = df.join(F.broadcast(leaders), seller, "left")
    return joined.select(*[F.col(c) for c in df.columns], seg)


def category_name(items: DataFrame, products: DataFrame, lookup: DataFrame,
                  out: str = "category") -> DataFrame:
    """``COALESCE(prod_cat_eng, product_category, 'unknown')`` per item.

    Products are resolved to their category first (product x lookup), then
    joined to the items; both joins are left joins so items never drop.
    The lookup is as small as the category list; AQE broadcasts it after
    measuring it at runtime.
    """
    prod = (products.select("product_sk", "product_category")
            .join(lookup, F.col("product_category") == F.col("prod_cat"), "left")
            .select("product_sk", F.coalesce("prod_cat_eng", "product_category").alias("_cat")))
    joined = items.join(prod, "product_sk", "left")
    return joined.select(*[F.col(c) for c in items.columns],
                         F.coalesce(F.col("_cat"), F.lit("unknown")).alias(out))


def tier_by_thresholds(value: Column, lo: Column, hi: Column, labels: Sequence[str],
                       low_inclusive: bool) -> Column:
    """Three-way CASE: ``> hi`` -> labels[2], ``< lo`` (or ``<=``) -> labels[0], else labels[1].

    NULL comparisons fall through to the middle label, as in SQL CASE.
    """
    low = value <= lo if low_inclusive else value < lo
    return F.when(value > hi, labels[2]).when(low, labels[0]).otherwise(labels[1])


def top_n_flag(key: str, value: str, n: int) -> Column:
    """True for rows of the ``n`` best keys by ``value`` DESC (NULLS FIRST), key as tie-break.

    A window over the whole frame: use it only on aggregated frames bounded
    by the number of keys (categories), never on raw rows. Several rows of
    one key share its rank, so the frame may hold (key, sub-group) rows.
    """
    w = Window.orderBy(F.desc_nulls_first(value), F.asc_nulls_last(key))
    return F.dense_rank().over(w) <= n
