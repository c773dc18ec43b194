"""Registered ETL, cleaning and quality queries (P, K, L ids).

Every query reads the staged text derived from the test tables (or the
warehouse replayed from it), so its work grows with the tables. Decimal
columns are returned as double at this boundary (values are exact
decimals with at most 18 digits, so the double is the correctly rounded
value on any engine).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.exact import round_ratio
from marketlake.functions.parse import guarded_ts
from marketlake.functions.text import transliterate
from marketlake.operators import quality as Q
from marketlake.operators.keys import resolve_fk
from marketlake.operators.segments import market_leaders
from marketlake.plans import etl, reports
from marketlake.plans.model import build_model
from marketlake.plans.staging import staging
from marketlake.sources.tables import load


def as_output(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _stg(spark, sf_dir, table):
    return staging(spark, sf_dir, table)


# ---------------------------------------------------------------- P

def p1_transliterate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return transliterate(docs, ["text"])


def p2_p11_clean_products(spark, sf_dir):
    return as_output(etl.clean_products(_stg(spark, sf_dir, "products")))


def p3_p10_guarded_casts(spark, sf_dir):
    return as_output(etl.parse_geo(_stg(spark, sf_dir, "geolocation")))


def p7_orders_times(spark, sf_dir):
    return etl.clean_orders(_stg(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- K

K1_TABLES = ("products", "sellers", "orders", "geolocation", "order_items", "order_payments", "order_reviews")


def k1_rows_loaded(spark, sf_dir):
    out = None
    for t in K1_TABLES:
        r = Q.rows_loaded(_stg(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "loaded_file", "rows_loaded")
        out = r if out is None else out.unionByName(r)
    return out


PRODUCT_RULES = {"product_id": Q.ID_PATTERN, **{c: Q.NUMBER_PATTERN for c in etl.PRODUCT_MEASURES}}
ITEM_RULES = {"order_id": Q.ID_PATTERN, "order_item_id": Q.COUNT_PATTERN, "product_id": Q.ID_PATTERN,
              "seller_id": Q.ID_PATTERN, "shipping_limit_date": Q.DATETIME_PATTERN,
              "price": Q.NUMBER_PATTERN, "freight_value": Q.NUMBER_PATTERN}
PAYMENT_RULES = {"order_id": Q.ID_PATTERN, "payment_sequential": Q.COUNT_PATTERN,
                 "payment_type": Q.PAYMENT_TYPE_PATTERN, "payment_installments": Q.COUNT_PATTERN,
                 "payment_value": Q.NUMBER_PATTERN}
REVIEW_RULES = {"review_id": Q.ID_PATTERN, "order_id": Q.ID_PATTERN, "review_score": Q.COUNT_PATTERN,
                "review_creation_date": Q.DATETIME_PATTERN, "review_answer_timestamp": Q.DATETIME_PATTERN}


SELLER_RULES = {"seller_zip_code_prefix": Q.ZIP_PATTERN}
ORDER_RULES = {"order_id": Q.ID_PATTERN, "customer_id": Q.ID_PATTERN,
               **{c: Q.DATETIME_PATTERN for c in etl.ORDER_TIMES}}
GEO_RULES = {"geolocation_zip_code_prefix": Q.ZIP_PATTERN, "geolocation_lat": Q.FLOAT_PATTERN,
             "geolocation_lng": Q.FLOAT_PATTERN}
RULES = {"products": PRODUCT_RULES, "sellers": SELLER_RULES, "orders": ORDER_RULES, "geolocation": GEO_RULES,
         "order_items": ITEM_RULES, "order_payments": PAYMENT_RULES, "order_reviews": REVIEW_RULES}
STAGING_KEYS = {"products": ["product_id"], "sellers": ["seller_id"], "orders": ["order_id"],
                "order_items": ["order_id", "order_item_id"], "order_payments": ["order_id", "payment_sequential"],
                "order_reviews": ["review_id", "order_id"]}
PROFILED = {
    "products": ["product_id", "product_category_name", *etl.PRODUCT_MEASURES],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "orders": ["order_id", "customer_id", "order_status", *etl.ORDER_TIMES],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "order_items": list(ITEM_RULES), "order_payments": list(PAYMENT_RULES), "order_reviews": list(REVIEW_RULES)}


def _per_table(tables, check):
    """``check(name)`` of every table, unioned, with the table's name in front."""
    return reduce(DataFrame.unionByName, [check(t).select(F.lit(t).alias("table_name"), "*") for t in tables])


def k2_violation_rows(spark, sf_dir):
    return _per_table(RULES, lambda t: Q.violation_rows(_stg(spark, sf_dir, t), RULES[t]))


def k3_duplicate_keys_all(spark, sf_dir):
    def check(t):
        keys = STAGING_KEYS[t]
        text = F.concat_ws("|", *[F.coalesce(F.col(k), F.lit("NULL")) for k in keys])
        return Q.duplicate_keys(_stg(spark, sf_dir, t), keys).select(text.alias("key"), "duplicate_count")
    return _per_table(STAGING_KEYS, check)


def k4_missing_by_column(spark, sf_dir):
    return _per_table(PROFILED, lambda t: Q.missing_pct(_stg(spark, sf_dir, t), PROFILED[t], long=True))


def k4_observed_at_load(spark, sf_dir):
    """K4 of both loads from what was counted while staging was written."""
    wh = etl.warehouse(spark, sf_dir, runs=2)
    seen = [(t, c, sum(wh.missing(t, n)[c] for n in (1, 2)), sum(wh.missing(t, n)[""] for n in (1, 2))) for t, cols in PROFILED.items() for c in cols]
    counts = spark.createDataFrame(seen, "table_name string, column_name string, missing long, total long")
    return counts.select("table_name", "column_name", round_ratio(F.col("missing") * 100, F.col("total"), 3).alias("pct_missing"))


def k6_shipping_range(spark, sf_dir):
    return Q.guarded_range(_stg(spark, sf_dir, "order_items"), ["shipping_limit_date"], guarded_ts)


def k2_format_violations(spark, sf_dir):
    return Q.format_violations(_stg(spark, sf_dir, "products"), PRODUCT_RULES,
                               show=["product_id", *etl.PRODUCT_MEASURES, "staging_id"])


def k2_violation_counts(spark, sf_dir):
    return _per_table(RULES, lambda t: Q.violation_counts(_stg(spark, sf_dir, t), RULES[t]))


def k3_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_stg(spark, sf_dir, "order_items"), ["order_id", "order_item_id"])


def k4_missing_pct(spark, sf_dir):
    cols = ["product_id", "product_category_name", *etl.PRODUCT_MEASURES]
    return Q.missing_pct(_stg(spark, sf_dir, "products"), cols)


def k5_city_variants(spark, sf_dir):
    return Q.near_duplicates(_stg(spark, sf_dir, "sellers"), "seller_city")


def k6_date_range(spark, sf_dir):
    return Q.guarded_range(_stg(spark, sf_dir, "orders"), list(etl.ORDER_TIMES), guarded_ts)


def k7_geo_bounds(spark, sf_dir):
    return Q.coordinate_bounds(_stg(spark, sf_dir, "geolocation"), "geolocation_lat", "geolocation_lng")


def k8_unmatched_sellers(spark, sf_dir):
    s = etl.warehouse(spark, sf_dir, runs=2).sellers
    return Q.unmatched(s, "geo_sk", ["seller_sk", "seller_id", "seller_zip"], ["seller_zip", "seller_sk"])


def k9_unmatched_zips(spark, sf_dir):
    return Q.unmatched_values(etl.warehouse(spark, sf_dir, runs=2).sellers, "geo_sk", "seller_zip")


def k10_key_checks(spark, sf_dir):
    p = _stg(spark, sf_dir, "products").select(F.nullif(F.trim("product_id"), F.lit("")).alias("product_id"))
    i = _stg(spark, sf_dir, "order_items")
    return Q.key_violations(p, ["product_id"], "staging_products").unionByName(
        Q.key_violations(i, ["order_id", "order_item_id"], "staging_order_items"))


def k11_orphans(spark, sf_dir):
    wh = etl.warehouse(spark, sf_dir, runs=2)
    rels = [(wh.items, "product_id", wh.products, "product_id", "items.product_id -> products"),
            (wh.items, "seller_id", wh.sellers, "seller_id", "items.seller_id -> sellers"),
            (wh.items, "order_id", wh.orders, "order_id", "items.order_id -> orders"),
            (wh.payments, "order_id", wh.orders, "order_id", "payments.order_id -> orders"),
            (wh.reviews, "order_id", wh.orders, "order_id", "reviews.order_id -> orders")]
    out = None
    for child, fk, parent, pk, name in rels:
        o = Q.orphans(child, fk, parent, pk, name)
        out = o if out is None else out.unionByName(o)
    return out


#: Natural and surrogate keys of the warehouse tables, and the links between them.
WAREHOUSE_KEYS = [
    ("products", ["product_id"]), ("products", ["product_sk"]), ("sellers", ["seller_id"]), ("sellers", ["seller_sk"]),
    ("orders", ["order_id"]), ("orders", ["order_sk"]), ("category", ["prod_cat"]),
    ("geolocation", ["geo_zip", "geo_lat_round", "geo_lng_round"]), ("geolocation", ["geo_sk"]),
    ("items", ["order_id", "order_item_id"]), ("payments", ["order_id", "payment_sequential"]),
    ("reviews", ["order_id", "review_id"]), ("reviews", ["review_sk"])]
WAREHOUSE_LINKS = [
    ("items", "order_sk", "orders"), ("items", "product_sk", "products"), ("items", "seller_sk", "sellers"),
    ("payments", "order_sk", "orders"), ("reviews", "order_sk", "orders"), ("sellers", "geo_sk", "geolocation")]


def k10_warehouse_keys(spark, sf_dir):
    wh = etl.warehouse(spark, sf_dir, runs=2)
    return reduce(DataFrame.unionByName, [
        Q.key_violations(getattr(wh, t), keys, f"{t}({', '.join(keys)})") for t, keys in WAREHOUSE_KEYS])


def k11_link_orphans(spark, sf_dir):
    wh = etl.warehouse(spark, sf_dir, runs=2)
    return reduce(DataFrame.unionByName, [
        Q.orphans(getattr(wh, c), sk, getattr(wh, p), sk, f"{c}.{sk} -> {p}") for c, sk, p in WAREHOUSE_LINKS])


# ---------------------------------------------------------------- L

def l1_latest(spark, sf_dir):
    return as_output(etl.latest_products(_stg(spark, sf_dir, "products")))


def l2_collapse_items(spark, sf_dir):
    return as_output(etl.collapse_items(_stg(spark, sf_dir, "order_items")))


def l2_collapse_payments(spark, sf_dir):
    return as_output(etl.collapse_payments(_stg(spark, sf_dir, "order_payments")))


def l2_collapse_geo(spark, sf_dir):
    return as_output(etl.collapse_geo(_stg(spark, sf_dir, "geolocation")))


def p12_payment_rejects(spark, sf_dir):
    return etl.payment_rejects(_stg(spark, sf_dir, "order_payments")).select("order_id", "payment_sequential", "loaded_file", "staging_id")


def l3_review_dedup(spark, sf_dir):
    return etl.dedup_reviews(_stg(spark, sf_dir, "order_reviews"))


def _wh_table(name, runs=2):
    def run(spark, sf_dir):
        return as_output(getattr(etl.warehouse(spark, sf_dir, runs=runs), name))
    run.__name__ = f"l4_upsert_{name}"
    return run


def l5_change_feed_orders(spark, sf_dir):
    """What the second load did to each order it brought, with status and last sight before and after."""
    feed = etl.warehouse(spark, sf_dir, runs=2).feed("orders", 2)
    return feed.select("after.order_sk", "after.order_id", "kind", F.col("before.order_status").alias("status_before"), F.col("after.order_status").alias("status_after"),
                       F.col("before.last_seen_at").alias("seen_before"), F.col("after.last_seen_at").alias("seen_after"))


def l5_change_feed_items(spark, sf_dir):
    """The same for items, with the prices."""
    feed = etl.warehouse(spark, sf_dir, runs=2).feed("items", 2)
    return feed.select("after.order_id", "after.order_item_id", "kind", F.col("before.price").cast("double").alias("price_before"), F.col("after.price").cast("double").alias("price_after"))


def l5_change_counts(spark, sf_dir):
    """Inserted, updated and unchanged rows of the second load per table."""
    wh = etl.warehouse(spark, sf_dir, runs=2)
    return _per_table(etl.Warehouse.TABLES, lambda t: wh.feed(t, 2).groupBy("kind").agg(F.count(F.lit(1)).alias("rows")))


def l7_surrogate_keys(spark, sf_dir):
    return etl.warehouse(spark, sf_dir, runs=2).products.select("product_sk", "product_id")


def l8_fact_fk(spark, sf_dir):
    return etl.warehouse(spark, sf_dir, runs=2).items.select(
        "order_id", "order_item_id", "order_sk", "product_sk", "seller_sk")


def l8_skewed_fk(spark, sf_dir):
    """L8 where one seller holds a third of the items (and some items have none): sold units and revenue per state."""
    m = build_model(spark, sf_dir)
    seller = F.when(F.col("order_sk") % 3 == 0, F.lit(1)).when(F.col("order_sk") % 7 != 0, F.col("seller_sk"))
    items = m.fact_items.select("order_sk", "order_item_id", "price", seller.alias("seller_key"))
    linked = resolve_fk(items, {"seller_state": (m.dim_sellers, "seller_key", "seller_sk", "seller_state")}, spread=True)
    return as_output(linked.groupBy("seller_state").agg(F.count(F.lit(1)).alias("units"), F.count("seller_key").alias("linked"), F.sum("price").alias("revenue")))


def _maintained(report):
    """A report on the warehouse after two loads, from sums that followed the second load's feed."""
    def run(spark, sf_dir):
        return report(etl.warehouse(spark, sf_dir, runs=2).model(2))
    run.__name__ = f"{report.__name__}_maintained"
    return run


def v2_maintained(spark, sf_dir):
    """V2 on the warehouse after two loads, from the maintained orders of each seller."""
    return market_leaders(etl.warehouse(spark, sf_dir, runs=2).view("seller_orders", 2).rows())


def l10_geo_link(spark, sf_dir):
    return etl.warehouse(spark, sf_dir, runs=2).sellers.select("seller_sk", "seller_id", "seller_zip", "geo_sk")


QUERIES = {
    "l5_change_feed_orders": l5_change_feed_orders,
    "l5_change_feed_items": l5_change_feed_items,
    "l5_change_counts": l5_change_counts,
    "p1_transliterate": p1_transliterate,
    "p2_p11_clean_products": p2_p11_clean_products,
    "p3_p10_guarded_casts": p3_p10_guarded_casts,
    "p7_orders_times": p7_orders_times,
    "k1_rows_loaded": k1_rows_loaded,
    "k2_format_violations": k2_format_violations,
    "k2_violation_counts": k2_violation_counts,
    "k3_duplicate_keys": k3_duplicate_keys,
    "k4_missing_pct": k4_missing_pct,
    "k5_city_variants": k5_city_variants,
    "k6_date_range": k6_date_range,
    "k7_geo_bounds": k7_geo_bounds,
    "k8_unmatched_sellers": k8_unmatched_sellers,
    "k9_unmatched_zips": k9_unmatched_zips,
    "k10_key_checks": k10_key_checks,
    "k11_orphans": k11_orphans,
    "k2_violation_rows": k2_violation_rows,
    "k3_duplicate_keys_all": k3_duplicate_keys_all,
    "k4_missing_by_column": k4_missing_by_column,
    "k6_shipping_range": k6_shipping_range,
    "k10_warehouse_keys": k10_warehouse_keys,
    "k11_link_orphans": k11_link_orphans,
    "l1_latest": l1_latest,
    "l2_collapse_items": l2_collapse_items,
    "l2_collapse_payments": l2_collapse_payments,
    "l2_collapse_geo": l2_collapse_geo,
    "l3_review_dedup": l3_review_dedup,
    "p12_payment_rejects": p12_payment_rejects,
    **{f"l4_upsert_{t}": _wh_table(t) for t in
       ("products", "sellers", "orders", "category", "geolocation", "items", "payments", "reviews")},
    "l7_surrogate_keys": l7_surrogate_keys,
    "l8_fact_fk": l8_fact_fk,
    "l8_skewed_fk": l8_skewed_fk,
    "k4_observed_at_load": k4_observed_at_load,
    "v2_maintained": v2_maintained,
    "v9_maintained": _maintained(reports.v9_category_performance),
    "v10_maintained": _maintained(reports.v10_top_categories),
    "v11_maintained": _maintained(reports.v11_price_tiers),
    "l10_geo_link": l10_geo_link,
}
