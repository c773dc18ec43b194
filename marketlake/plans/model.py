"""The star model (3 dims, 2 lookups, item fact) derived from the test tables.

The driver's tables are TPC-H shaped; the reports need a marketplace model.
The mapping below is deterministic (no randomness, only arithmetic on the
natural keys) so the SQL oracle can rebuild it row for row:

* ``fact_order_items`` is the grain collapse (L2) of ``lineitem`` on
  (l_orderkey, l_linenumber), which has duplicate keys.
* ``dim_orders`` derives approval / delivery / estimate times from the key.
* ``dim_sellers`` is ``supplier`` with its nation as state.
* ``dim_products`` / ``lookup_prod_cat`` come from ``part`` brands.

Everything is lazy; ``StarModel`` just names the DataFrames so reports can
pick the columns they need (Catalyst prunes the rest down to the scan).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.dedup import collapse
from marketlake.operators.segments import market_leaders, segment_by_leader
from marketlake.session import scratch_path
from marketlake.sources.tables import load

# Fixed mapping parameters (ours, not the reference's): which keys get a
# missing approval / delivery / estimate, a zero or a missing price, an
# unknown state or category, and which brands have an English name.
APPROVED_NULL_MOD = 97
DELIVERED_NULL_MOD = 31
ESTIMATED_NULL_MOD = 89
PRICE_ZERO_MOD = 199
PRICE_NULL_MOD = 211
STATE_NULL_MOD = 23
CATEGORY_NULL_MOD = 50
BRAND_UNTRANSLATED_MOD = 5


@dataclass
class StarModel:
    fact_items: DataFrame
    dim_orders: DataFrame
    dim_sellers: DataFrame
    dim_products: DataFrame
    lookup_prod_cat: DataFrame
    lookup_geo: DataFrame
    leaders: DataFrame | None = None  # stored V2 result (3 rows), when the model is stored
    sold: DataFrame | None = None  # (product_sk, price, units, revenue) sums that stand for the items, when they are maintained


def orders_dim(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    purchase = F.col("o_orderdate")
    approved = F.when(k % APPROVED_NULL_MOD != 0, F.timestamp_add("HOUR", k % 48, purchase))
    delivered = F.when(
        k % DELIVERED_NULL_MOD != 0,
        F.timestamp_add("HOUR", (F.lit(3) + (k * 7919) % 23) * 24 + k % 24, purchase))
    estimated = F.when(k % ESTIMATED_NULL_MOD != 0, F.timestamp_add("DAY", F.lit(15) + k % 16, purchase))
    return orders.select(
        k.alias("order_sk"),
        F.concat(F.lit("o"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        purchase.alias("order_purchase_t"),
        approved.alias("order_approved_t"),
        F.timestamp_add("DAY", F.lit(1), approved).alias("order_delivered_carrier_t"),
        delivered.alias("order_delivered_customer_t"),
        estimated.alias("order_estimated_delivery_t"),
    )


def items_fact(lineitem: DataFrame) -> DataFrame:
    """L2 over lineitem: column-wise MAX per (order, line), then typing."""
    g = collapse(
        lineitem,
        keys=["l_orderkey", "l_linenumber"],
        max_cols={"l_suppkey": "seller_sk", "l_partkey": "product_sk",
                  "l_extendedprice": "price_raw", "l_quantity": "freight_raw",
                  "l_shipdate": "shipping_limit_date"},
    )
    probe = F.col("l_orderkey") + F.col("l_linenumber")
    price = (F.when(probe % PRICE_ZERO_MOD == 0, F.lit(0).cast("decimal(12,2)"))
             .when(probe % PRICE_NULL_MOD == 0, F.lit(None).cast("decimal(12,2)"))
             .otherwise(F.col("price_raw").cast("decimal(12,2)")))
    return g.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.concat(F.lit("p"), F.col("product_sk").cast("string")).alias("product_id"),
        F.concat(F.lit("s"), F.col("seller_sk").cast("string")).alias("seller_id"),
        F.col("l_orderkey").alias("order_sk"),
        "product_sk", "seller_sk", "shipping_limit_date",
        price.alias("price"),
        F.col("freight_raw").cast("decimal(10,2)").alias("freight_value"),
    )


def sellers_dim(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    # nation has 25 rows by definition of the schema: a bounded broadcast.
    s = supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left")
    return s.select(
        F.col("s_suppkey").alias("seller_sk"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip"),
        F.initcap(F.col("n_name")).alias("seller_city"),
        F.when(F.col("s_suppkey") % STATE_NULL_MOD != 0, F.col("n_name")).alias("seller_state"),
    )


def brand_number(brand):
    return F.substring_index(brand, "#", -1).cast("int")


def products_dim(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("product_sk"),
        F.concat(F.lit("p"), k.cast("string")).alias("product_id"),
        F.when(k % CATEGORY_NULL_MOD != 0, F.col("p_brand")).alias("product_category"),
        F.length("p_name").cast("decimal(20,4)").alias("name_length"),
        F.col("p_size").cast("decimal(20,4)").alias("weight_g"),
        F.col("p_retailprice").cast("decimal(20,4)").alias("length_cm"),
    )


def prod_cat_lookup(part: DataFrame) -> DataFrame:
    brands = part.select(F.col("p_brand").alias("prod_cat")).distinct()
    n = brand_number(F.col("prod_cat"))
    return (brands.filter(n % BRAND_UNTRANSLATED_MOD != 0)
            .select("prod_cat", F.concat(F.lit("category_"), n.cast("string")).alias("prod_cat_eng")))


def geo_lookup(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One geo row per nation: zip = nation key, coordinates derived from keys."""
    g = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    lat = (F.col("n_nationkey") * 7 % 180 - 90).cast("decimal(38,18)") + F.lit(0.123456789).cast("decimal(38,18)")
    lng = (F.col("n_nationkey") * 13 % 360 - 180).cast("decimal(38,18)") + F.lit(0.987654321).cast("decimal(38,18)")
    return g.select(
        F.col("n_nationkey").cast("long").alias("geo_sk"),
        F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("geo_zip"),
        lat.alias("geo_lat"), lng.alias("geo_lng"),
        F.round(lat, 6).cast("decimal(9,6)").alias("geo_lat_round"),
        F.round(lng, 6).cast("decimal(9,6)").alias("geo_lng_round"),
        F.initcap(F.col("n_name")).alias("geo_city"),
        F.col("r_name").alias("geo_state"),
    )


ITEMS_BY_MONTH = "order_sk long, seller_sk long, price decimal(12,2), purchase_month int"
_STORED: dict[tuple, str] = {}


def data_state(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    """What names stored results: the session, the folder, and the files of the tables as they are now (a listing, no read)."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in tables])
    now = files.agg(F.count(F.lit(1)), F.max("modificationTime"), F.sum("length")).first()
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir), *now


def stored_fact(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """The item fact as a stored table (written once per session and state of the data folder).

    The reference's views read a loaded ``fact_order_items`` table; here the
    grain collapse of lineitem (one full shuffle of the largest table) is
    likewise done once, written as parquet below ``spark.checkpoint.dir``,
    and every view scans the stored result. Lineage stops at the stored
    files, so a lost executor re-reads them instead of redoing the collapse.
    """
    return spark.read.parquet(_stored_model(spark, sf_dir, refresh))


def stored_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaders view stored with the item fact."""
    return spark.read.parquet(_stored_model(spark, sf_dir) + "-leaders")


def _stored_model(spark: SparkSession, sf_dir: str, refresh: bool = False) -> str:
    """The folder of the stored item fact, written if the data is new."""
    key = data_state(spark, sf_dir, ("lineitem",))
    if refresh or key not in _STORED:
        path = scratch_path(spark, "model/fact_order_items")
        items_fact(load(spark, sf_dir, "lineitem")).write.mode("overwrite").parquet(path)
        # the leaders view (3 rows) is read by four reports: store it with the fact
        fact = spark.read.parquet(path)
        market_leaders(fact).write.mode("overwrite").parquet(path + "-leaders")
        _STORED[key] = path
    return _STORED[key]


def month_index(c) -> F.Column:
    """Months since year 0, the partition column of the items by month."""
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def month_label(index: F.Column) -> F.Column:
    """'yyyy-MM' of a ``month_index``."""
    return F.format_string("%04d-%02d", F.floor(index / 12).cast("int"), index % 12 + 1)


def stored_items_by_month(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items, months): the item fact in folders of its orders' purchase month, and the months that each market segment has.

    Items are (seller_sk, order_sk, price, purchase_month); those whose order
    is unknown or has no purchase time are in the folder of the null month.
    A filter on ``purchase_month`` reads only the folders it names. Rows are
    rebalanced by month, so a month with a large share is written by several
    tasks. ``months`` has a row per segment and month.
    """
    key = ("by_month", *data_state(spark, sf_dir, ("lineitem", "orders")))
    if key not in _STORED:
        m = build_model(spark, sf_dir)
        months = m.dim_orders.select("order_sk", month_index(F.col("order_purchase_t")).alias("purchase_month"))
        items = m.fact_items.select("order_sk", "seller_sk", "price").join(months, "order_sk", "left")
        path = scratch_path(spark, "model/items_by_month")
        items.hint("rebalance", "purchase_month").write.mode("overwrite").partitionBy("purchase_month").parquet(path)
        present = spark.read.schema(ITEMS_BY_MONTH).parquet(path).filter("purchase_month IS NOT NULL").select("seller_sk", "purchase_month").distinct()
        segment_by_leader(present, m.leaders).select("market_segment", "purchase_month").distinct().write.mode("overwrite").parquet(path + "-months")
        _STORED[key] = path
    return spark.read.schema(ITEMS_BY_MONTH).parquet(_STORED[key]), spark.read.parquet(_STORED[key] + "-months")


def build_model(spark: SparkSession, sf_dir: str, stored: bool = True) -> StarModel:
    """The star model; ``stored=False`` keeps the item fact as a lazy plan."""
    t = lambda name: load(spark, sf_dir, name)
    return StarModel(
        fact_items=stored_fact(spark, sf_dir) if stored else items_fact(t("lineitem")),
        leaders=stored_leaders(spark, sf_dir) if stored else None,
        dim_orders=orders_dim(t("orders")),
        dim_sellers=sellers_dim(t("supplier"), t("nation")),
        dim_products=products_dim(t("part")),
        lookup_prod_cat=prod_cat_lookup(t("part")),
        lookup_geo=geo_lookup(t("nation"), t("region")),
    )
