"""DuckDB SQL for the source queries whose content is checkable.

A CSV round trip keeps text but turns empty fields into NULL (on both the
reference's pandas path and Spark's reader), hence the NULLIFs.
"""

from __future__ import annotations

from marketlake.plans.oracle_etl_sql import CLEAN_PRODUCTS, MEASURES, _translit, with_staging
from marketlake.plans.oracle_sql import REPORTS
from marketlake.plans.source_queries import MALFORMED_MOD, ORDER_TEXT, PRODUCT_TEXT


def _nullif(cols):
    return ", ".join(f"NULLIF({c}, '') AS {c}" for c in cols)


QUERIES = {
    "s2_encoding_fallback": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents",
    "s3_folder_convert": f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_translit('lang')} AS lang, {_translit('text')} AS text FROM documents",
    "s1_s4_csv_roundtrip": with_staging(f"SELECT {_nullif(PRODUCT_TEXT)} FROM stg_products"),
    "s5_malformed_skip": with_staging(
        f"SELECT {_nullif(ORDER_TEXT)} FROM stg_orders "
        f"WHERE CAST(substr(order_id, 2) AS BIGINT) % {MALFORMED_MOD} <> 0"),
    "s7_lineage_backfill": with_staging(
        "SELECT staging_id, product_id, CASE loaded_file WHEN 'products_1.csv' THEN 'products_backfill.csv' "
        "ELSE loaded_file END AS loaded_file FROM stg_products"),
    "s9_s10_view_scan": REPORTS["v8_delay_rank"],
    "s12_rounded_products": with_staging(
        f"SELECT product_id, {', '.join(f'CAST(round({c}) AS INTEGER) AS {c}' for c in MEASURES.values())}, staging_id "
        f"FROM ({CLEAN_PRODUCTS.replace(' AS DOUBLE)', ' AS DECIMAL(20,4))')}) c"),
    "s6_s7_staging":with_staging("SELECT * FROM stg_products"),
}
