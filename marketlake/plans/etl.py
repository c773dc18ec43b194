"""Staging -> warehouse loads (P2-P12, L1-L11) for the eight tables.

Each ``load_*`` takes the staged text of one run and optionally the stored
snapshot of the previous run, and returns the next snapshot:

    clean (typed, blank->NULL, no-key rows dropped)
      -> dedup (latest per key, or grain collapse)
      -> FK resolution (facts)
      -> SCD-1 upsert into the stored snapshot
      -> surrogate keys for new rows

``warehouse(spark, sf_dir, runs)`` replays runs in order: run 1 loads the
first file of every table into empty tables, run 2 upserts the second.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.parse import (blank_to_null, guarded_int, guarded_money, guarded_number,
                                        guarded_ts, is_float_text, norm_key, round_coord, strict_ts)
from marketlake.operators.dedup import collapse, collapse_dealt, latest_dealt, latest_per_key
from marketlake.operators.keys import assign_sk, keyed_incoming, link_geo, resolve_fk
from marketlake.operators.quality import observed_missing, require_key
from marketlake.operators.upsert import scd1_upsert
from marketlake.plans.model import StarModel, data_state
from marketlake.plans.staging import staging
from marketlake.session import release, scratch_path
from marketlake.sources.catalog import materialize, save_snapshot
from marketlake.sources.snapshots import Snapshot, buckets_for, create
from marketlake.sources.staging import packed, spelled
from marketlake.sources.views import GroupedView

PRODUCT_MEASURES = {
    "product_name_length": "name_length", "product_description_length": "description_length",
    "product_photos_qty": "photos_qty", "product_weight_g": "weight_g",
    "product_length_cm": "length_cm", "product_height_cm": "height_cm", "product_width_cm": "width_cm",
}
ORDER_TIMES = {
    "order_purchase_timestamp": "order_purchase_t", "order_approved_at": "order_approved_t",
    "order_delivered_carrier_date": "order_delivered_carrier_t",
    "order_delivered_customer_date": "order_delivered_customer_t",
    "order_estimated_delivery_date": "order_estimated_delivery_t",
}
#: The given tables that staging is made of.
SOURCES = ("part", "supplier", "nation", "orders", "lineitem")
_LOAD = ["loaded_at", "loaded_file", "staging_id"]
ITEM_KEYS, PAYMENT_KEYS = ["order_id", "order_item_id"], ["order_id", "payment_sequential"]
#: What items and payments are dealt by while they are loaded, and stored in buckets by.
FACT_BY = ["order_id"]


def _insert_shape(df: DataFrame, cols) -> DataFrame:
    """Row as inserted: attributes + audit columns from the load columns."""
    return df.select(*cols, F.col("loaded_at").alias("first_seen_at"), F.col("loaded_at").alias("last_seen_at"),
                     F.col("loaded_file").alias("row_source_file"), "staging_id")


def _collapsed_audit():
    return [F.min("loaded_at").alias("first_seen_at"), F.max("loaded_at").alias("last_seen_at"),
            F.max("loaded_file").alias("row_source_file"), F.max("staging_id").alias("staging_id")]


# ---------------------------------------------------------------- cleaning

def clean_products(stg: DataFrame) -> DataFrame:
    return require_key(stg.select(
        blank_to_null("product_id").alias("product_id"),
        blank_to_null("product_category_name").alias("product_category"),
        *[guarded_number(c).alias(n) for c, n in PRODUCT_MEASURES.items()],
        *_LOAD), ["product_id"])


def clean_sellers(stg: DataFrame) -> DataFrame:
    return require_key(stg.select(
        blank_to_null("seller_id").alias("seller_id"),
        blank_to_null("seller_zip_code_prefix").alias("seller_zip"),
        blank_to_null("seller_city").alias("seller_city"),
        blank_to_null("seller_state").alias("seller_state"),
        *_LOAD), ["seller_id"])


def clean_orders(stg: DataFrame) -> DataFrame:
    return require_key(stg.select(
        blank_to_null("order_id").alias("order_id"),
        blank_to_null("customer_id").alias("customer_id"),
        blank_to_null("order_status").alias("order_status"),
        *[strict_ts(c).alias(n) for c, n in ORDER_TIMES.items()],
        *_LOAD), ["order_id"])


def clean_category(stg: DataFrame) -> DataFrame:
    return require_key(stg.select(
        blank_to_null("product_category_name").alias("prod_cat"),
        blank_to_null("product_category_name_english").alias("prod_cat_eng"),
        *_LOAD), ["prod_cat"])


def parse_geo(stg: DataFrame) -> DataFrame:
    """Keep parseable coordinates, normalise zip and city, round."""
    ok = is_float_text("geolocation_lat") & is_float_text("geolocation_lng")
    return stg.filter(ok).select(
        norm_key("geolocation_zip_code_prefix").alias("geo_zip"),
        F.col("geolocation_lat").cast("decimal(38,18)").alias("geo_lat"),
        F.col("geolocation_lng").cast("decimal(38,18)").alias("geo_lng"),
        round_coord("geolocation_lat").alias("geo_lat_round"),
        round_coord("geolocation_lng").alias("geo_lng_round"),
        norm_key("geolocation_city").alias("geo_city"),
        F.col("geolocation_state").alias("geo_state"),
        *_LOAD)


# ---------------------------------------------------------------- dedup (L1-L3)

def latest_products(stg: DataFrame) -> DataFrame:
    return latest_per_key(clean_products(stg), ["product_id"])


def collapse_geo(stg: DataFrame) -> DataFrame:
    g = parse_geo(stg).groupBy("geo_zip", "geo_lat_round", "geo_lng_round").agg(
        F.min("geo_lat").alias("geo_lat"), F.min("geo_lng").alias("geo_lng"),
        F.max("geo_city").alias("geo_city"), F.max("geo_state").alias("geo_state"), *_collapsed_audit())
    return g.select("geo_zip", "geo_lat", "geo_lng", "geo_lat_round", "geo_lng_round", "geo_city",
                    "geo_state", "first_seen_at", "last_seen_at", "row_source_file", "staging_id")


def _collapsed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """L2: one row per key, column-wise MAX of the parsed values, first sight by MIN."""
    return collapse(rows, keys, [c for c in rows.columns if c not in (*keys, "first_seen_at")], ["first_seen_at"]).select(*rows.columns)


def item_values(stg: DataFrame) -> DataFrame:
    s = stg.filter(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull())
    return _insert_shape(s, ["order_id", "order_item_id", "product_id", "seller_id", guarded_ts("shipping_limit_date").alias("shipping_limit_date"),
                             guarded_money("price").alias("price"), guarded_money("freight_value").alias("freight_value")])


def collapse_items(stg: DataFrame) -> DataFrame:
    """L2: one row per (order_id, order_item_id), column-wise MAX of parsed values."""
    return _collapsed(item_values(stg), ITEM_KEYS)


def payment_values(stg: DataFrame) -> DataFrame:
    s = stg.filter(F.col("order_id").isNotNull() & F.col("payment_sequential").isNotNull())
    return _insert_shape(s, ["order_id", guarded_int("payment_sequential").alias("payment_sequential"), "payment_type",
                             guarded_int("payment_installments").alias("payment_installments"), guarded_money("payment_value").alias("payment_value")])


def collapse_payments(stg: DataFrame) -> DataFrame:
    """L2 for payments; a non-numeric sequence gives a NULL key (see payment_rejects)."""
    return _collapsed(payment_values(stg), PAYMENT_KEYS)


def review_key():
    """L3 dedup key of rows with an order: review id, else order + creation text."""
    return F.coalesce(F.col("review_id"), F.concat(F.col("order_id"), F.lit("|"), F.coalesce(F.col("review_creation_date"), F.lit(""))))


def dedup_reviews(stg: DataFrame) -> DataFrame:
    s = stg.filter(F.col("order_id").isNotNull())
    latest = latest_per_key(s, [review_key()])
    return latest.select(
        "review_id", "order_id", guarded_int("review_score", 1, 5).alias("review_score"),
        "review_comment_title", "review_comment_message",
        guarded_ts("review_creation_date").alias("review_creation_date"),
        guarded_ts("review_answer_timestamp").alias("review_answer_timestamp"), *_LOAD)


# ---------------------------------------------------------------- loads

DIM_SPECS = {
    # table: (keys, attributes, surrogate key, compare columns, touch first_seen)
    "products": (["product_id"], ["product_category", *PRODUCT_MEASURES.values()], "product_sk", None, True),
    "sellers": (["seller_id"], ["seller_zip", "seller_city", "seller_state"], "seller_sk", None, True),
    "orders": (["order_id"], ["customer_id", "order_status", *ORDER_TIMES.values()], "order_sk", None, True),
    "category": (["prod_cat"], ["prod_cat_eng"], None, None, False),
    "geolocation": (["geo_zip", "geo_lat_round", "geo_lng_round"], ["geo_city", "geo_state"], "geo_sk",
                    ["row_source_file"], True),
}
_CLEAN = {"products": clean_products, "sellers": clean_sellers, "orders": clean_orders,
          "category": clean_category}


def _order(df: DataFrame, sk, keys, attrs) -> DataFrame:
    head = [sk] if sk else []
    rest = [c for c in df.columns if c not in head + keys + attrs]
    return df.select(*head, *keys, *attrs, *rest)


def _keyed(incoming: DataFrame, existing: DataFrame | None, keys, sk: str, table: str) -> DataFrame:
    return keyed_incoming(incoming, existing, keys, sk, lambda df: materialize(df, f"warehouse/{table}-incoming"))


@dataclass(frozen=True)
class Load:
    """Deduplicated rows of one run, and how they are merged into the stored table.

    ``arrived`` are the keys of the staged rows, repeats included: where they
    are given, the rows need not be stored to learn the buckets they fall into.
    """

    rows: DataFrame
    keys: list[str]
    policy: dict[str, str]
    compare: list[str]
    touch_first_seen: bool = True
    order: Callable[[DataFrame], DataFrame] = lambda df: df  # the table's order of columns
    arrived: DataFrame | None = None

    def onto(self, existing: DataFrame | None) -> DataFrame:
        """The next table as one frame."""
        snap = self.rows if existing is None else scd1_upsert(existing, self.rows, self.keys, self.policy, self.compare, self.touch_first_seen)
        return self.order(snap)


def dimension_rows(table: str, stg: DataFrame, existing: DataFrame | None = None) -> Load:
    keys, attrs, sk, compare, touch_first = DIM_SPECS[table]
    if table == "geolocation":
        cleaned, incoming = parse_geo(stg), collapse_geo(stg)
        attrs_all = ["geo_lat", "geo_lng", *attrs]
    else:
        cleaned = _CLEAN[table](stg)
        incoming = _insert_shape(latest_per_key(cleaned, keys), keys + attrs)
        attrs_all = attrs
    incoming = incoming.select(*keys, *attrs_all, "first_seen_at", "last_seen_at", "row_source_file", "staging_id")
    if sk:
        incoming = _keyed(incoming, existing, keys, sk, table)
    return Load(incoming, keys, {a: "coalesce" for a in attrs}, compare or [*attrs, "row_source_file"], touch_first,
                lambda df: _order(df, sk, keys, attrs_all), cleaned.select(*keys))


def first_dimension(table: str, stg: DataFrame, pieces: int) -> Load:
    """``dimension_rows`` of the first load of a table with one row as it came per key, dealt into ``pieces`` by the keys.

    Only the keys are shuffled and stored to be numbered: the rows move once, and the numbers come to them.
    """
    keys, attrs, sk, compare, touch_first = DIM_SPECS[table]
    cleaned = _CLEAN[table](stg)
    numbers = assign_sk(materialize(cleaned.select(*keys).distinct(), f"warehouse/{table}-keys"), keys, sk)
    rows = _insert_shape(latest_dealt(cleaned, keys, numbers, sk, pieces), [sk, *keys, *attrs])
    return Load(rows, keys, {a: "coalesce" for a in attrs}, compare or [*attrs, "row_source_file"], touch_first)


def load_dimension(table: str, stg: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return dimension_rows(table, stg, existing).onto(existing)


ITEM_POLICY = {"product_id": "overwrite", "seller_id": "overwrite", "order_sk": "coalesce",
               "product_sk": "coalesce", "seller_sk": "coalesce", "shipping_limit_date": "coalesce",
               "price": "coalesce", "freight_value": "coalesce"}
PAYMENT_POLICY = {"payment_type": "overwrite", "payment_installments": "coalesce",
                  "payment_value": "coalesce", "order_sk": "coalesce"}
REVIEW_POLICY = {c: "coalesce" for c in ("review_score", "review_comment_title", "review_comment_message",
                                         "review_creation_date", "review_answer_timestamp", "order_sk")}


def item_rows(stg: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame, pieces: int) -> Load:
    """Linked, collapsed items, dealt into ``pieces`` by order: the items move once, the orders' keys come to them.

    Products and sellers are linked ahead of it; the link of the largest id is the one beside it.
    """
    values = item_values(stg)
    g = resolve_fk(values, {
        "product_sk": (products, "product_id", "product_id", "product_sk"),
        "seller_sk": (sellers, "seller_id", "seller_id", "seller_sk")})
    g = g.withColumns({"product": F.struct("product_id", "product_sk"), "seller": F.struct("seller_id", "seller_sk")})
    g = collapse_dealt(g.drop("product_id", "product_sk", "seller_id", "seller_sk"), ITEM_KEYS, FACT_BY, pieces, ["first_seen_at"])
    g = resolve_fk(g, {"order_sk": (orders, "order_id", "order_id", "order_sk")})
    g = g.select("order_id", "order_item_id", "product.product_id", "seller.seller_id", "order_sk", "product.product_sk", "seller.seller_sk",
                 "shipping_limit_date", "price", "freight_value",
                 "first_seen_at", "last_seen_at", "row_source_file", "staging_id")
    return Load(g, ITEM_KEYS, ITEM_POLICY, [*ITEM_POLICY, "row_source_file"], arrived=values.select(*ITEM_KEYS))


def payment_rejects(stg: DataFrame) -> DataFrame:
    """Rows whose sequence number does not parse (NOT NULL key violation in the reference)."""
    s = stg.filter(F.col("order_id").isNotNull() & F.col("payment_sequential").isNotNull())
    return s.filter(guarded_int("payment_sequential").isNull())


def payment_rows(stg: DataFrame, orders: DataFrame, pieces: int) -> Load:
    values = payment_values(stg).filter(F.col("payment_sequential").isNotNull())
    g = collapse_dealt(values, PAYMENT_KEYS, FACT_BY, pieces, ["first_seen_at"])
    g = resolve_fk(g, {"order_sk": (orders, "order_id", "order_id", "order_sk")})
    g = g.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
                 "order_sk", "first_seen_at", "last_seen_at", "row_source_file", "staging_id")
    return Load(g, PAYMENT_KEYS, PAYMENT_POLICY, [*PAYMENT_POLICY, "row_source_file"], arrived=values.select(*PAYMENT_KEYS))


def review_rows(stg: DataFrame, orders: DataFrame, existing: DataFrame | None = None) -> Load:
    d = dedup_reviews(stg)
    d = resolve_fk(d, {"order_sk": (orders, "order_id", "order_id", "order_sk")})
    d = _insert_shape(d, ["review_id", "order_id", "review_score", "review_comment_title",
                          "review_comment_message", "review_creation_date", "review_answer_timestamp",
                          "order_sk"])
    d = _keyed(d, existing, ["order_id", "review_id"], "review_sk", "reviews")
    return Load(d, ["order_id", "review_id"], REVIEW_POLICY, [*REVIEW_POLICY, "row_source_file"],
                order=lambda df: df.select("review_sk", *[c for c in df.columns if c != "review_sk"]))


def geo_link_feed(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """L10 + L11 as changes: the sellers whose link to ``geo`` is not the stored one."""
    now = link_geo(sellers.withColumn("_was", F.struct(*sellers.columns)), geo)
    moved = ~F.col("geo_sk").eqNullSafe(F.col("_was.geo_sk"))
    return now.filter(moved).select(F.lit("update").alias("kind"), F.col("_was").alias("before"), F.struct(*sellers.columns).alias("after"))


class Warehouse:
    """The warehouse after ``runs`` ETL runs (run n loads staging load n).

    Tables are stored versions in buckets (``sources.snapshots``): a run
    rewrites only the buckets that its rows change, and stores its change
    feed. A version is built when it is first wanted, from its own previous
    run; facts also need the dimensions.
    """

    DIMENSIONS = ("products", "sellers", "orders", "category", "geolocation")
    TABLES = DIMENSIONS + ("items", "payments", "reviews")
    #: Numbered tables with one row as it came per key.
    FIRST_DEALT = ("products", "sellers", "orders")
    #: Maintained views: the table they follow, their groups and sums.
    VIEWS = {"sold": ("items", ("product_sk", "price"), {}), "seller_orders": ("items", ("seller_sk", "order_sk"), {})}
    _STAGING = {"items": "order_items", "payments": "order_payments", "reviews": "order_reviews"}

    def __init__(self, spark: SparkSession, sf_dir: str, runs: int = 2):
        self.spark, self.sf_dir, self.runs = spark, sf_dir, runs
        self.root = scratch_path(spark, "warehouse")
        self._built: dict[tuple[str, int], list[Snapshot]] = {}
        self._staging: dict[tuple[str, int], DataFrame] = {}
        self._views: dict[tuple[str, int], GroupedView] = {}
        self._missing: dict[tuple[str, int], dict[str, int]] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in Warehouse.TABLES:
            return self.table(name, self.runs)
        raise AttributeError(name)

    def staged(self, table: str, run: int) -> DataFrame:
        """One run's staging table, stored: staged text is digested once, whatever reads it."""
        name = self._STAGING.get(table, table)
        if (name, run) not in self._staging:
            rows, seen = observed_missing(staging(self.spark, self.sf_dir, name, loads=(run,)))
            self._staging[name, run] = save_snapshot(rows, f"{self.root}/staging/{name}-{run}")
            self._missing[name, run] = seen.get
        return self._staging[name, run]

    def missing(self, table: str, run: int) -> dict[str, int]:
        """K4 as counted while one run's staging table was written: rows under ``""``, and missing values per column."""
        self.staged(table, run)
        return self._missing[self._STAGING.get(table, table), run]

    def table(self, name: str, run: int) -> DataFrame:
        return self.versions(name, run)[-1].rows().withColumn("staging_id", spelled(F.col("staging_id")))

    def feed(self, name: str, run: int) -> DataFrame:
        """What run ``run`` did to each row it brought."""
        text = lambda side: F.when(F.col(side).isNotNull(), F.col(side).withField("staging_id", spelled(F.col(f"{side}.staging_id")))).alias(side)
        return self.versions(name, run)[0].feed().select("kind", text("before"), text("after"))

    def versions(self, name: str, run: int) -> list[Snapshot]:
        """The versions that a run makes: the load's, and for sellers the one with their links."""
        if (name, run) not in self._built:
            self._built[name, run] = self._build(name, run)
            release(self.spark)
        return self._built[name, run]

    def view(self, name: str, run: int) -> GroupedView:
        """A maintained view after run ``run``: started from the first version's feed, then following the feeds."""
        if (name, run) not in self._views:
            table, groups, sums = self.VIEWS[name]
            versions = self.versions(table, run)
            feeds = [v.feed() for v in versions]
            made = self.view(name, run - 1) if run > 1 else GroupedView.start(feeds.pop(0), f"{self.root}/views/{name}", groups, sums, versions[0].buckets)
            for feed in feeds:
                made = made.follow(feed)
            self._views[name, run] = made
            release(self.spark)
        return self._views[name, run]

    def model(self, run: int) -> StarModel:
        """The star model of the stored tables, with the maintained sums of sold items."""
        sums = self.view("sold", run).rows().select("product_sk", "price", F.col("n").alias("units"), (F.col("price") * F.col("n")).cast("decimal(22,2)").alias("revenue"))
        return StarModel(self.table("items", run), self.table("orders", run), self.table("sellers", run), self.table("products", run),
                         self.table("category", run), self.table("geolocation", run), sold=sums)

    def _rows(self, name: str, run: int, stored: DataFrame | None, pieces: int) -> Load:
        stg = packed(self.staged(name, run))
        if name in Warehouse.FIRST_DEALT and stored is None:
            return first_dimension(name, stg, pieces)
        if name in Warehouse.DIMENSIONS:
            return dimension_rows(name, stg, stored)
        orders = self.table("orders", run)
        if name == "items":
            return item_rows(stg, orders, self.table("products", run), self.table("sellers", run), pieces)
        return payment_rows(stg, orders, pieces) if name == "payments" else review_rows(stg, orders, stored)

    def _build(self, name: str, run: int) -> list[Snapshot]:
        before = self.versions(name, run - 1)[-1] if run > 1 else None
        buckets = before.buckets if before else buckets_for(self.missing(name, run)[""])
        load = self._rows(name, run, before.rows() if before else None, buckets)
        if before:
            rows = load.rows if load.arrived is not None else materialize(load.rows, f"warehouse/{name}-rows")
            made = before.upsert(rows, load.policy, load.compare, load.touch_first_seen, load.arrived)
        else:
            first, fact = load.onto(None), name in ("items", "payments")
            made = create(first.withColumn("geo_sk", F.lit(None).cast("long")) if name == "sellers" else first, f"{self.root}/{name}", load.keys,
                          buckets, FACT_BY if fact else (), fact or name in Warehouse.FIRST_DEALT)
        return [made, made.apply(geo_link_feed(made.rows(), self.table("geolocation", run)))] if name == "sellers" else [made]


_WAREHOUSES: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str, runs: int = 2, refresh: bool = False) -> Warehouse:
    """``runs`` ETL runs over the staged loads (lazily, per table), kept per session and state of the data files."""
    state = (*data_state(spark, sf_dir, SOURCES), runs)
    if refresh or state not in _WAREHOUSES:
        _WAREHOUSES[state] = Warehouse(spark, sf_dir, runs)
    return _WAREHOUSES[state]
