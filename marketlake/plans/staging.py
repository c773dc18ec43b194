"""Text staging tables derived from the test tables (input of the ETL half).

The reference loads raw CSV text into all-text staging tables, twice or
more over time. Here the same shape is derived from the driver's tables:
every business column is a string, two loads per table (``load_no`` 1 and 2,
one day apart), and quirks injected by key modulus (blanks, ``'n/a'``,
``'12.'``, padded text, case variants, malformed dates, duplicate keys,
keys only in the second load, unchanged re-deliveries of the first file).
No randomness: the SQL oracle rebuilds the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.model import brand_number, orders_dim
from marketlake.sources.staging import stage
from marketlake.sources.tables import load

# Fixed load instants of the two generated loads.
LOAD_AT = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00"}


def _txt(c: Column) -> Column:
    return c.cast("string")


def _zoned(text: Column, where: Column, offset: str) -> Column:
    """Times that some rows bear with a zone offset."""
    return F.when(where, F.concat(text, F.lit(offset))).otherwise(text)


def _fmt(c: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text: a timestamp_ntz cast prints exactly that for
    whole-second values (all generated times are whole hours), without the
    per-row pattern formatter of ``date_format``."""
    return c.cast("timestamp_ntz").cast("string")


def _load_split(k: Column, load_no: int) -> Column:
    """Load 1: keys not divisible by 11; load 2: keys divisible by 7 or by 11."""
    return (k % 11 != 0) if load_no == 1 else ((k % 7 == 0) | (k % 11 == 0))


def _file(table: str, k: Column, load_no: int) -> Column:
    """Second-load rows with k % 14 = 0 re-deliver the first file unchanged."""
    if load_no == 1:
        return F.lit(f"{table}_1.csv")
    return F.when(k % 14 == 0, F.lit(f"{table}_1.csv")).otherwise(F.lit(f"{table}_2.csv"))


def _changed(k: Column, load_no: int) -> Column:
    return F.lit(load_no == 2) & (k % 14 != 0)


def products_load(part: DataFrame, load_no: int) -> DataFrame:
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    rows = part.filter(_load_split(k, load_no)).select(
        F.when(k % 101 == 0, F.lit("  ")).otherwise(F.concat(F.lit("p"), _txt(k))).alias("product_id"),
        F.when(_changed(k, load_no) & (k % 2 == 0), F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit(""))
        .when(k % 17 == 0, F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")))
        .otherwise(F.col("p_brand")).alias("product_category_name"),
        F.when(k % 19 == 0, F.lit("n/a")).when(k % 29 == 0, F.lit(" 12 "))
        .otherwise(_txt(F.length("p_name"))).alias("product_name_length"),
        F.when(k % 37 == 0, F.lit("12.")).otherwise(_txt(F.col("p_size") * 10)).alias("product_description_length"),
        F.when(k % 41 == 0, F.lit("-3")).otherwise(_txt(F.col("p_size") % 5)).alias("product_photos_qty"),
        F.when(_changed(k, load_no), _txt(price + 1)).otherwise(_txt(price)).alias("product_weight_g"),
        _txt(F.col("p_size")).alias("product_length_cm"),
        F.when(k % 43 != 0, _txt(F.col("p_size") + 1)).alias("product_height_cm"),
        _txt(F.col("p_size") + 2).alias("product_width_cm"),
        _file("products", k, load_no).alias("loaded_file"),
        F.concat(F.lit("p"), _txt(k)).alias("_key"),
    )
    return stage(rows, "products", F.col("_key"), load_no, LOAD_AT[load_no])


def sellers_load(supplier: DataFrame, nation: DataFrame, load_no: int) -> DataFrame:
    k = F.col("s_suppkey")
    s = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    name = F.col("n_name")
    rows = s.filter(_load_split(k, load_no)).select(
        F.concat(F.lit("s"), _txt(k)).alias("seller_id"),
        F.when(k % 19 == 0, F.lit("99999"))
        .otherwise(F.lpad(_txt(F.col("s_nationkey")), 5, "0")).alias("seller_zip_code_prefix"),
        F.when(_changed(k, load_no), F.lit(""))
        .when(k % 3 == 0, name).when(k % 3 == 1, F.lower(name))
        .otherwise(F.concat(F.lit(" "), F.lower(name), F.lit(" "))).alias("seller_city"),
        F.when(k % 23 == 0, F.lit(" ")).otherwise(F.substring(name, 1, 2)).alias("seller_state"),
        _file("sellers", k, load_no).alias("loaded_file"),
        F.concat(F.lit("s"), _txt(k)).alias("_key"),
    )
    return stage(rows, "sellers", F.col("_key"), load_no, LOAD_AT[load_no])


def orders_load(orders: DataFrame, load_no: int) -> DataFrame:
    k = F.col("order_sk")
    d = orders_dim(orders.filter(_load_split(F.col("o_orderkey"), load_no)))
    rows = d.select(
        "order_id", "customer_id",
        F.when(_changed(k, load_no), F.lit("delivered")).otherwise(F.col("order_status")).alias("order_status"),
        _fmt(F.col("order_purchase_t")).alias("order_purchase_timestamp"),
        F.when(k % 97 == 0, F.lit("")).otherwise(_zoned(_fmt(F.col("order_approved_t")), k % 19 == 0, "+02")).alias("order_approved_at"),
        _zoned(_fmt(F.col("order_delivered_carrier_t")), k % 23 == 0, " -03:30").alias("order_delivered_carrier_date"),
        F.when(k % 31 == 0, F.lit(" ")).otherwise(_fmt(F.col("order_delivered_customer_t")))
        .alias("order_delivered_customer_date"),
        _fmt(F.col("order_estimated_delivery_t")).alias("order_estimated_delivery_date"),
        _file("orders", k, load_no).alias("loaded_file"),
        F.col("order_id").alias("_key"),
    )
    return stage(rows, "orders", F.col("_key"), load_no, LOAD_AT[load_no])


def category_load(part: DataFrame, load_no: int) -> DataFrame:
    brands = part.select("p_brand").distinct()
    n = brand_number(F.col("p_brand"))
    keep = F.lit(True) if load_no == 1 else (n % 3 == 0)
    rows = brands.filter(keep).select(
        F.col("p_brand").alias("product_category_name"),
        F.when(n % 5 == 0, F.lit(""))
        .when(F.lit(load_no == 2), F.concat(F.lit("cat_"), _txt(n)))
        .otherwise(F.concat(F.lit("category_"), _txt(n))).alias("product_category_name_english"),
        F.lit(f"product_category_name_translation_{load_no}.csv").alias("loaded_file"),
        F.col("p_brand").alias("_key"),
    )
    return stage(rows, "category", F.col("_key"), load_no, LOAD_AT[load_no])


def geolocation_load(supplier: DataFrame, nation: DataFrame, load_no: int) -> DataFrame:
    k = F.col("s_suppkey")
    nk = F.col("s_nationkey")
    s = supplier.join(F.broadcast(nation), nk == F.col("n_nationkey"), "left")
    keep = F.lit(True) if load_no == 1 else (k % 7 == 0)
    zip5 = F.lpad(_txt(nk), 5, "0")
    rows = s.filter(keep).select(
        F.when(k % 5 == 0, F.concat(F.lit(" "), zip5)).otherwise(zip5).alias("geolocation_zip_code_prefix"),
        F.when(k % 29 == 0, F.lit("abc"))
        .otherwise(F.concat(_txt(nk * 7 % 180 - 90), F.lit(".123456"), _txt(k % 3))).alias("geolocation_lat"),
        F.concat(_txt(nk * 13 % 360 - 180), F.lit(".654321"), _txt(k % 4)).alias("geolocation_lng"),
        F.when(F.lit(load_no == 2), F.concat(F.lit("new "), F.lower(F.col("n_name"))))
        .when(k % 2 == 0, F.col("n_name")).otherwise(F.lower(F.col("n_name"))).alias("geolocation_city"),
        F.substring(F.col("n_name"), 1, 2).alias("geolocation_state"),
        _file("geolocation", k, load_no).alias("loaded_file"),
        _txt(k).alias("_key"),
    )
    return stage(rows, "geolocation", F.col("_key"), load_no, LOAD_AT[load_no])


def items_load(lineitem: DataFrame, load_no: int) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    keep = (ok % 13 != 0) if load_no == 1 else ((ok % 13 == 0) | (ok % 6 == 0))
    probe = ok + ln
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    rows = lineitem.filter(keep).select(
        F.concat(F.lit("o"), _txt(ok)).alias("order_id"),
        _txt(ln).alias("order_item_id"),
        F.when(F.lit(load_no == 2) & (ok % 12 == 0), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("p"), _txt(F.col("l_partkey")))).alias("product_id"),
        F.concat(F.lit("s"), _txt(F.col("l_suppkey"))).alias("seller_id"),
        F.when(probe % 43 == 0, F.lit("n/a")).otherwise(_zoned(_fmt(F.col("l_shipdate")), probe % 41 == 0, "+0530")).alias("shipping_limit_date"),
        F.when(probe % 47 == 0, F.lit("12.")).when(probe % 53 == 0, F.lit(" 12 "))
        .when(F.lit(load_no == 2), _txt(price + 1)).otherwise(_txt(price)).alias("price"),
        _txt(F.col("l_quantity").cast("decimal(10,2)")).alias("freight_value"),
        F.lit(f"order_items_{load_no}.csv").alias("loaded_file"),
        # lineitem repeats (order, line): the row's part and supplier make the id unique
        F.concat_ws("|", _txt(ok), _txt(ln), _txt(F.col("l_partkey")), _txt(F.col("l_suppkey")),
                    _txt(F.col("l_extendedprice").cast("decimal(12,2)"))).alias("_key"),
    )
    return stage(rows, "order_items", F.col("_key"), load_no, LOAD_AT[load_no])


def _money_text(cents: Column) -> Column:
    whole = ((cents - cents % 100) / 100).cast("long")
    return F.concat(_txt(whole), F.lit("."), F.lpad(_txt(cents % 100), 2, "0"))


def payments_load(orders: DataFrame, load_no: int) -> DataFrame:
    k = F.col("o_orderkey")
    n = k % 3 + 1
    o = orders.filter(_load_split(k, load_no)).select(
        k, F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("seq"),
        (F.col("o_totalprice").cast("decimal(12,2)") * 100).cast("long").alias("_total"))
    seq = F.col("seq")
    cents = (F.col("_total") - F.col("_total") % n) / n + F.when(seq == 1, F.col("_total") % n).otherwise(0)
    cents = cents.cast("long")
    ptype = (F.when(F.lit(load_no == 2), F.lit("voucher"))
             .when((k + seq) % 4 == 0, F.lit("credit_card")).when((k + seq) % 4 == 1, F.lit("boleto"))
             .when((k + seq) % 4 == 2, F.lit("voucher")).otherwise(F.lit("debit_card")))
    base = o.select(
        F.concat(F.lit("o"), _txt(k)).alias("order_id"),
        F.when((k % 61 == 0) & (seq == 1), F.lit("x")).otherwise(_txt(seq)).alias("payment_sequential"),
        ptype.alias("payment_type"),
        _txt(k % 10 + 1).alias("payment_installments"),
        _money_text(cents).alias("payment_value"),
        F.lit(f"order_payments_{load_no}.csv").alias("loaded_file"),
        F.concat_ws("|", _txt(k), _txt(seq)).alias("_key"),
    )
    if load_no == 1:
        dup = o.filter((k % 5 == 0) & (seq == 1)).select(
            F.concat(F.lit("o"), _txt(k)).alias("order_id"), F.lit("1").alias("payment_sequential"),
            F.lit("boleto").alias("payment_type"), _txt(k % 10 + 1).alias("payment_installments"),
            _money_text(cents + 100).alias("payment_value"),
            F.lit("order_payments_1.csv").alias("loaded_file"),
            F.concat_ws("|", _txt(k), F.lit("dup")).alias("_key"))
        base = base.unionByName(dup)
    return stage(base, "order_payments", F.col("_key"), load_no, LOAD_AT[load_no])


def reviews_load(orders: DataFrame, load_no: int) -> DataFrame:
    k = F.col("o_orderkey")
    keep = F.lit(True) if load_no == 1 else k % 7 == 0
    created = F.timestamp_add("DAY", F.lit(20), F.col("o_orderdate"))
    rows = orders.filter(keep).select(
        F.when(k % 67 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("r"), _txt(((k - k % 2) / 2).cast("long")))).alias("review_id"),
        F.concat(F.lit("o"), _txt(k)).alias("order_id"),
        _txt((k + load_no) % 7).alias("review_score"),
        F.when(k % 3 != 0, F.concat(F.lit("title "), _txt(k % 5))).alias("review_comment_title"),
        F.when(k % 2 != 0, F.concat(F.lit("message "), _txt(k))).alias("review_comment_message"),
        F.when(k % 59 == 0, F.lit("tbd")).otherwise(_fmt(created)).alias("review_creation_date"),
        _fmt(F.timestamp_add("DAY", F.lit(21), F.col("o_orderdate"))).alias("review_answer_timestamp"),
        F.lit(f"order_reviews_{load_no}.csv").alias("loaded_file"),
        _txt(k).alias("_key"),
    )
    return stage(rows, "order_reviews", F.col("_key"), load_no, LOAD_AT[load_no])


STAGING_TABLES = ("products", "sellers", "orders", "category", "geolocation",
                  "order_items", "order_payments", "order_reviews")


def staging(spark: SparkSession, sf_dir: str, table: str, loads=(1, 2)) -> DataFrame:
    """All requested loads of one staging table, unioned (as appended by COPY)."""
    t = lambda name: load(spark, sf_dir, name)
    makers = {
        "products": lambda n: products_load(t("part"), n),
        "sellers": lambda n: sellers_load(t("supplier"), t("nation"), n),
        "orders": lambda n: orders_load(t("orders"), n),
        "category": lambda n: category_load(t("part"), n),
        "geolocation": lambda n: geolocation_load(t("supplier"), t("nation"), n),
        "order_items": lambda n: items_load(t("lineitem"), n),
        "order_payments": lambda n: payments_load(t("orders"), n),
        "order_reviews": lambda n: reviews_load(t("orders"), n),
    }
    frames = [makers[table](n) for n in loads]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
