"""Registered source / sink queries.

Files are written below the shared ``spark.checkpoint.dir`` (a fresh folder
per call) from data Spark derives from the test tables, then read back
through the package's readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import reports
from marketlake.plans.etl import PRODUCT_MEASURES, clean_products
from marketlake.plans.model import build_model
from marketlake.plans.staging import staging
from marketlake.session import scratch_path
from marketlake.sources import encoding as ENC
from marketlake.sources.catalog import preview, register_view
from marketlake.sources.csv import read_csv, write_csv
from marketlake.sources.staging import backfill_lineage
from marketlake.sources.tables import load

PRODUCT_TEXT = ["product_id", "product_category_name", "product_name_length", "product_description_length",
                "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                "product_width_cm", "staging_id", "loaded_file"]
ORDER_TEXT = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
              "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
              "staging_id"]
MALFORMED_MOD = 17


def s1_s4_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 then S1: staged product text written as header CSV and read back as text."""
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(staging(spark, sf_dir, "products").select(*PRODUCT_TEXT), path)
    return read_csv(spark, path, PRODUCT_TEXT).drop("_file")


def s5_malformed_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an extra field are dropped (DROPMALFORMED), the rest parse."""
    stg = staging(spark, sf_dir, "orders")
    k = F.substring(F.col("order_id"), 2, 20).cast("long")
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in ORDER_TEXT])
    line = F.when(k % MALFORMED_MOD == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    path = scratch_path(spark, "csv-malformed")
    stg.select(line.alias("value")).write.mode("overwrite").text(path)
    return read_csv(spark, path, ORDER_TEXT, on_malformed="skip", header=False).drop("_file")


DOC_TEXT = ["doc_id", "lang", "text"]


def _mixed_encoding_folder(spark: SparkSession, sf_dir: str) -> str:
    """Documents as CSV: German ones in Latin-1, the others in UTF-8."""
    docs = load(spark, sf_dir, "documents").select(*DOC_TEXT)
    root = scratch_path(spark, "encodings")
    german = F.coalesce(F.col("lang") == "de", F.lit(False))
    for name, cond, enc in (("latin", german, "ISO-8859-1"), ("utf8", ~german, "UTF-8")):
        (docs.filter(cond).write.mode("overwrite").option("header", True).option("encoding", enc)
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{root}/{name}"))
    return root


def s2_encoding_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of every file, decoded by the first encoding that fits the file."""
    folder = ENC.read_folder(spark, _mixed_encoding_folder(spark, sf_dir), recursive=True)
    return ENC.decoded_records(folder, DOC_TEXT).select(*DOC_TEXT)


def s3_folder_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4: every file of a folder decoded, transliterated and written as CSV; the records written."""
    out = scratch_path(spark, "converted")
    ENC.convert_folder(spark, _mixed_encoding_folder(spark, sf_dir), out, DOC_TEXT, recursive=True)
    return ENC.read_converted(spark, out, DOC_TEXT).select(*DOC_TEXT)


def s6_s7_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S7: staged product text with id, source file and load time."""
    return staging(spark, sf_dir, "products")


def s7_lineage_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows staged without a file name get one; the others keep theirs."""
    stg = staging(spark, sf_dir, "products")
    unnamed = stg.withColumn("loaded_file", F.when(F.col("loaded_file") != "products_1.csv", F.col("loaded_file")))
    return backfill_lineage(unnamed, "products_backfill.csv").select("staging_id", "product_id", "loaded_file")


def s9_s10_view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S10: a report registered as a view, then scanned by name."""
    register_view(reports.v8_delay_rank(build_model(spark, sf_dir)), "rpt_delay_rank")
    return spark.table("rpt_delay_rank")


def s12_rounded_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rounding cast of the preview, over every row."""
    measures = tuple(PRODUCT_MEASURES.values())
    return preview(clean_products(staging(spark, sf_dir, "products")), None, measures).select("product_id", *measures, "staging_id")


QUERIES = {
    "s7_lineage_backfill": s7_lineage_backfill,
    "s9_s10_view_scan": s9_s10_view_scan,
    "s12_rounded_products": s12_rounded_products,
    "s1_s4_csv_roundtrip": s1_s4_csv_roundtrip,
    "s2_encoding_fallback": s2_encoding_fallback,
    "s3_folder_convert": s3_folder_convert,
    "s5_malformed_skip": s5_malformed_skip,
    "s6_s7_staging": s6_s7_staging,
}
