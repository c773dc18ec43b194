"""DuckDB SQL for the replayed warehouse (L4 upserts, L7, L8, L10, K8, K9, K11).

Run 1 inserts into empty tables, run 2 upserts (``FULL OUTER JOIN`` on the
key with one CASE per column, following the column policies of
``plans.etl``), surrogate keys continue from the previous maximum in
(md5 prefix, key) order.
"""

from __future__ import annotations

from marketlake.plans.oracle_etl_sql import (CLEAN_ORDERS, CLEAN_PRODUCTS, MEASURES, ORDER_TIMES, REVIEW, _k10, blank, geo_grain, item_grain,
                                             last_reviews, named, payment_grain, staging_ctes)
from marketlake.plans.oracle_sql import MODEL, V9_BODY, V10_BODY, V11_BODY, with_model

AUDIT = ["first_seen_at", "last_seen_at", "row_source_file", "staging_id"]
INSERT_AUDIT = ("loaded_at AS first_seen_at, loaded_at AS last_seen_at, "
                "loaded_file AS row_source_file, staging_id")


def _latest(src: str, keys: list[str], cols: list[str]) -> str:
    part = ", ".join(keys)
    return (f"SELECT {', '.join(cols)}, {INSERT_AUDIT} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {part} "
            f"ORDER BY loaded_at DESC NULLS FIRST, staging_id DESC NULLS FIRST) AS rn FROM ({src}) c) r WHERE rn = 1")


def _incoming(table: str, n: int) -> str:
    s = f"stg_{table}_{n}" if table not in ("items", "payments", "reviews") else None
    if table == "products":
        src = CLEAN_PRODUCTS.replace("stg_products", f"stg_products_{n}").replace(
            " AS DOUBLE)", " AS DECIMAL(20,4))")
        return _latest(src, ["product_id"], ["product_id", "product_category", *MEASURES.values()])
    if table == "sellers":
        src = (f"SELECT {blank('seller_id')} AS seller_id, {blank('seller_zip_code_prefix')} AS seller_zip, "
               f"{blank('seller_city')} AS seller_city, {blank('seller_state')} AS seller_state, "
               f"loaded_at, loaded_file, staging_id FROM {s} WHERE {blank('seller_id')} IS NOT NULL")
        return _latest(src, ["seller_id"], ["seller_id", "seller_zip", "seller_city", "seller_state"])
    if table == "orders":
        src = CLEAN_ORDERS.replace("stg_orders", f"stg_orders_{n}")
        return _latest(src, ["order_id"], ["order_id", "customer_id", "order_status", *ORDER_TIMES.values()])
    if table == "category":
        src = (f"SELECT {blank('product_category_name')} AS prod_cat, "
               f"{blank('product_category_name_english')} AS prod_cat_eng, loaded_at, loaded_file, staging_id "
               f"FROM {s} WHERE {blank('product_category_name')} IS NOT NULL")
        return _latest(src, ["prod_cat"], ["prod_cat", "prod_cat_eng"])
    if table == "geolocation":
        return geo_grain(s)
    linked = {"items": ("order", "product", "seller"), "payments": ("order",), "reviews": ("order",)}[table]
    links = ", ".join(f"(SELECT {k}_sk FROM wh_{k}s_{n} k WHERE k.{k}_id = g.{k}_id) AS {k}_sk" for k in linked)
    source = f"stg_order_{table}_{n}"
    if table == "items":
        return f"SELECT g.*, {links} FROM ({item_grain(source)}) g"
    if table == "payments":
        return f"SELECT g.*, {links} FROM ({payment_grain(source)}) g WHERE payment_sequential IS NOT NULL"
    return f"SELECT {named(REVIEW)}, {links}, {INSERT_AUDIT} FROM ({last_reviews(source)}) g"


def _upsert(prev: str, inc: str, cols: list[str], extra: list[str], keys: list[str], policy: dict,
            compare: list[str], touch_first: bool = True) -> str:
    on = " AND ".join(f"e.{k} IS NOT DISTINCT FROM i.{k}" for k in keys)
    changed = " OR ".join(f"e.{c} IS DISTINCT FROM i.{c}" for c in compare)
    ins = "(e._e IS NULL)"
    upd = f"(e._e IS NOT NULL AND i._i IS NOT NULL AND ({changed}))"
    out = [f"CASE WHEN {ins} THEN NULL ELSE e.{c} END AS {c}" for c in extra]
    for c in cols:
        if c in keys:
            out.append(f"CASE WHEN e._e IS NOT NULL THEN e.{c} ELSE i.{c} END AS {c}")
            continue
        if c == "first_seen_at":
            merged = f"LEAST(e.{c}, i.{c})" if touch_first else f"e.{c}"
        elif c == "last_seen_at":
            merged = f"GREATEST(e.{c}, i.{c})"
        elif c in ("row_source_file", "staging_id"):
            merged = f"i.{c}"
        else:
            merged = {"coalesce": f"COALESCE(i.{c}, e.{c})", "overwrite": f"i.{c}",
                      "keep": f"e.{c}"}[policy.get(c, "keep")]
        out.append(f"CASE WHEN {ins} THEN i.{c} WHEN {upd} THEN {merged} ELSE e.{c} END AS {c}")
    return (f"SELECT {', '.join(out)} FROM (SELECT *, TRUE AS _e FROM {prev}) e "
            f"FULL OUTER JOIN (SELECT *, TRUE AS _i FROM ({inc}) x) i ON {on}")


def _with_sk(src: str, sk: str, keys: list[str]) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
    order = ", ".join(f"{k} ASC NULLS LAST" for k in keys)
    return (f"SELECT * REPLACE (CASE WHEN {sk} IS NULL THEN (SELECT COALESCE(MAX({sk}), 0) FROM ({src}) m) "
            f"+ ROW_NUMBER() OVER (PARTITION BY {sk} IS NULL ORDER BY substr(md5({text}), 1, 3), {order}) "
            f"ELSE {sk} END AS {sk}) FROM ({src}) t")


_DIM_COLS = {
    "products": ["product_id", "product_category", *MEASURES.values(), *AUDIT],
    "sellers": ["seller_id", "seller_zip", "seller_city", "seller_state", *AUDIT],
    "orders": ["order_id", "customer_id", "order_status", *ORDER_TIMES.values(), *AUDIT],
    "category": ["prod_cat", "prod_cat_eng", *AUDIT],
    "geolocation": ["geo_zip", "geo_lat", "geo_lng", "geo_lat_round", "geo_lng_round", "geo_city", "geo_state",
                    *AUDIT],
}
_FACT_COLS = {
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "order_sk", "product_sk", "seller_sk",
              "shipping_limit_date", "price", "freight_value", *AUDIT],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
                 "order_sk", *AUDIT],
    "reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp", "order_sk", *AUDIT],
}
# What the load rules say, written out here so that a changed rule in the loads shows up as a difference.
_FILL = "coalesce"
_FACT_SPEC = {
    "items": (["order_id", "order_item_id"],
              {"product_id": "overwrite", "seller_id": "overwrite", "order_sk": _FILL, "product_sk": _FILL, "seller_sk": _FILL,
               "shipping_limit_date": _FILL, "price": _FILL, "freight_value": _FILL}, None),
    "payments": (["order_id", "payment_sequential"],
                 {"payment_type": "overwrite", "payment_installments": _FILL, "payment_value": _FILL, "order_sk": _FILL}, None),
    "reviews": (["order_id", "review_id"],
                {"review_score": _FILL, "review_comment_title": _FILL, "review_comment_message": _FILL,
                 "review_creation_date": _FILL, "review_answer_timestamp": _FILL, "order_sk": _FILL}, "review_sk"),
}
# keys, columns filled from the incoming row, surrogate key, compared columns where not all, first_seen_at may move back
_DIM_SPEC = {
    "products": (["product_id"], ["product_category", *MEASURES.values()], "product_sk", None, True),
    "sellers": (["seller_id"], ["seller_zip", "seller_city", "seller_state"], "seller_sk", None, True),
    "orders": (["order_id"], ["customer_id", "order_status", *ORDER_TIMES.values()], "order_sk", None, True),
    "category": (["prod_cat"], ["prod_cat_eng"], None, None, False),
    "geolocation": (["geo_zip", "geo_lat_round", "geo_lng_round"], ["geo_city", "geo_state"], "geo_sk", ["row_source_file"], True),
}


def _table_cte(table: str, n: int) -> str:
    inc = _incoming(table, n)
    if table in _DIM_COLS:
        keys, attrs, sk, compare, touch = _DIM_SPEC[table]
        cols = _DIM_COLS[table]
        extra = [sk] if sk else []
        if n == 1:
            body = f"SELECT {'NULL::BIGINT AS ' + sk + ', ' if sk else ''}{', '.join(cols)} FROM ({inc}) x"
        else:
            body = _upsert(f"wh_{table}_{n - 1}", inc, cols, extra, keys, {a: "coalesce" for a in attrs},
                           compare or [*attrs, "row_source_file"], touch)
        if sk:
            body = _with_sk(body, sk, keys)
        if table == "sellers":
            # a link found once stays when the zip matches nothing any more
            had = f"(SELECT geo_sk FROM wh_sellers_{n - 1} p WHERE p.seller_id = d.seller_id)" if n > 1 else "NULL::BIGINT"
            body = (f"SELECT d.*, COALESCE(z.geo_sk, {had}) AS geo_sk FROM ({body}) d LEFT JOIN "
                    f"(SELECT lower(trim(geo_zip)) AS zip, MIN(geo_sk) AS geo_sk FROM wh_geolocation_{n} GROUP BY 1) z "
                    f"ON lower(trim(d.seller_zip)) = z.zip")
        return f"wh_{table}_{n} AS ({body})"
    keys, policy, sk = _FACT_SPEC[table]
    cols = _FACT_COLS[table]
    if n == 1:
        body = f"SELECT {'NULL::BIGINT AS ' + sk + ', ' if sk else ''}{', '.join(cols)} FROM ({inc}) x"
    else:
        body = _upsert(f"wh_{table}_{n - 1}", inc, cols, [sk] if sk else [], keys, policy,
                       [*policy, "row_source_file"])
    if sk:
        body = _with_sk(body, sk, keys)
    return f"wh_{table}_{n} AS ({body})"


ORDER = ["geolocation", "products", "sellers", "orders", "category", "items", "payments", "reviews"]


def warehouse_sql(body: str, runs: int = 2) -> str:
    ctes = [MODEL.strip(), staging_ctes((1,), "_1")]
    if runs > 1:
        ctes.append(staging_ctes((2,), "_2"))
    for n in range(1, runs + 1):
        ctes += [_table_cte(t, n) for t in ORDER]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _doubles(table: str, n: int) -> str:
    dec = {"products": list(MEASURES.values()),
           "geolocation": ["geo_lat", "geo_lng", "geo_lat_round", "geo_lng_round"],
           "items": ["price", "freight_value"], "payments": ["payment_value"]}.get(table, [])
    if not dec:
        return f"SELECT * FROM wh_{table}_{n}"
    return (f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in dec)}) "
            f"FROM wh_{table}_{n}")


_K11 = [("items", "product_id", "products", "product_id", "items.product_id -> products"),
        ("items", "seller_id", "sellers", "seller_id", "items.seller_id -> sellers"),
        ("items", "order_id", "orders", "order_id", "items.order_id -> orders"),
        ("payments", "order_id", "orders", "order_id", "payments.order_id -> orders"),
        ("reviews", "order_id", "orders", "order_id", "reviews.order_id -> orders")]

_KEYS = {"products": ["product_id", "product_sk"], "sellers": ["seller_id", "seller_sk"], "orders": ["order_id", "order_sk"],
         "category": ["prod_cat"], "geolocation": ["geo_zip, geo_lat_round, geo_lng_round", "geo_sk"],
         "items": ["order_id, order_item_id"], "payments": ["order_id, payment_sequential"],
         "reviews": ["order_id, review_id", "review_sk"]}
_LINKS = [("items", "order_sk", "orders"), ("items", "product_sk", "products"), ("items", "seller_sk", "sellers"),
          ("payments", "order_sk", "orders"), ("reviews", "order_sk", "orders"), ("sellers", "geo_sk", "geolocation")]

def _feed(t: str) -> str:
    """Each incoming row of the second load beside the stored row of its key."""
    if t in _DIM_SPEC:
        keys, filled, _, compared, _ = _DIM_SPEC[t]
    else:
        (keys, filled, _), compared = _FACT_SPEC[t], None
    differs = " OR ".join(f"was.{c} IS DISTINCT FROM new.{c}" for c in compared or [*filled, "row_source_file"])
    on = " AND ".join(f"was.{k} IS NOT DISTINCT FROM new.{k}" for k in keys)
    now = " AND ".join(f"now.{k} IS NOT DISTINCT FROM new.{k}" for k in keys)
    return (f"SELECT was, now, CASE WHEN was.is_stored IS NULL THEN 'insert' WHEN {differs} THEN 'update' ELSE 'unchanged' END AS kind "
            f"FROM ({_incoming(t, 2)}) new LEFT JOIN (SELECT *, TRUE AS is_stored FROM wh_{t}_1) was ON {on} JOIN wh_{t}_2 now ON {now}")


# the items of the second version with their category, as the category reports read them
SHELVED = """, wh_sold AS (
    SELECT i.price, CAST(i.price * 100 AS BIGINT) AS cents, coalesce(c.prod_cat_eng, p.product_category, 'unknown') AS category
    FROM wh_items_2 i LEFT JOIN wh_products_2 p ON p.product_sk = i.product_sk LEFT JOIN wh_category_2 c ON c.prod_cat = p.product_category)
"""


def _shelved(report: str) -> str:
    return warehouse_sql(SHELVED + report.replace("sold JOIN shelf USING (p)", "wh_sold").replace("FROM sold", "FROM wh_sold").replace("foi_category", "wh_sold"))


QUERIES = {
    "v2_maintained": warehouse_sql(
        "SELECT seller_sk, 'leader_0' || place AS leader_label FROM (SELECT seller_sk, row_number() OVER (ORDER BY count(DISTINCT order_sk) DESC, "
        "seller_sk NULLS LAST) AS place FROM wh_items_2 GROUP BY seller_sk) WHERE place <= 3"),
    "v9_maintained": _shelved(V9_BODY),
    "v10_maintained": _shelved(V10_BODY),
    "v11_maintained": _shelved(V11_BODY),
    "l8_skewed_fk": with_model(
        "SELECT seller_state, COUNT(*) AS units, COUNT(key) AS linked, CAST(SUM(price) AS DOUBLE) AS revenue FROM (SELECT price, "
        "CASE WHEN order_sk % 3 = 0 THEN 1 WHEN order_sk % 7 <> 0 THEN seller_sk END AS key FROM fact_order_items) f "
        "LEFT JOIN dim_sellers d ON d.seller_sk = f.key GROUP BY seller_state"),
    "l5_change_feed_orders": warehouse_sql(
        "SELECT now.order_sk AS order_sk, now.order_id AS order_id, kind, was.order_status AS status_before, now.order_status AS status_after, "
        f"was.last_seen_at AS seen_before, now.last_seen_at AS seen_after FROM ({_feed('orders')}) f"),
    "l5_change_feed_items": warehouse_sql(
        "SELECT now.order_id AS order_id, now.order_item_id AS order_item_id, kind, CAST(was.price AS DOUBLE) AS price_before, "
        f"CAST(now.price AS DOUBLE) AS price_after FROM ({_feed('items')}) f"),
    "l5_change_counts": warehouse_sql(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, kind, COUNT(*) AS rows FROM ({_feed(t)}) f GROUP BY kind" for t in ORDER)),
    "k10_warehouse_keys": warehouse_sql(" UNION ALL ".join(
        _k10(f"{t}({k})", k.split(", "), f"wh_{t}_2") for t, keys in _KEYS.items() for k in keys)),
    "k11_link_orphans": warehouse_sql(" UNION ALL ".join(
        f"SELECT '{c}.{sk} -> {p}' AS relation, COUNT(*) AS orphan_rows FROM wh_{c}_2 "
        f"WHERE {sk} NOT IN (SELECT {sk} FROM wh_{p}_2)" for c, sk, p in _LINKS)),
    **{f"l4_upsert_{t}": warehouse_sql(_doubles(t, 2)) for t in ORDER},
    "l7_surrogate_keys": warehouse_sql("SELECT product_sk, product_id FROM wh_products_2"),
    "l8_fact_fk": warehouse_sql(
        "SELECT order_id, order_item_id, order_sk, product_sk, seller_sk FROM wh_items_2"),
    "l10_geo_link": warehouse_sql("SELECT seller_sk, seller_id, seller_zip, geo_sk FROM wh_sellers_2"),
    "k8_unmatched_sellers": warehouse_sql(
        "SELECT seller_sk, seller_id, seller_zip FROM wh_sellers_2 WHERE geo_sk IS NULL "
        "ORDER BY seller_zip NULLS LAST, seller_sk NULLS LAST"),
    "k9_unmatched_zips": warehouse_sql(
        "SELECT DISTINCT seller_zip FROM wh_sellers_2 WHERE geo_sk IS NULL ORDER BY seller_zip NULLS LAST"),
    "k11_orphans": warehouse_sql(" UNION ALL ".join(
        f"SELECT '{name}' AS relation, COUNT(*) AS orphan_rows FROM wh_{c}_2 ch "
        f"WHERE ch.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM wh_{p}_2 pa WHERE pa.{pk} = ch.{fk})"
        for c, fk, p, pk, name in _K11)),
}
