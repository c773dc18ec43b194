"""Dimension loads driven by file arrival (``readStream`` + ``foreachBatch``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.etl import load_dimension
from marketlake.sources.csv import text_schema
from marketlake.sources.staging import staging_id


def _latest_version(spark: SparkSession, table_dir: str, below: str) -> DataFrame | None:
    """The newest complete snapshot version of ``table_dir`` (``v000001`` ...) before ``below``, if any.

    Listed through the Hadoop FileSystem of the path, so it works on any
    shared storage the cluster uses, not only a local disk.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    versions = sorted(st.getPath().getName() for st in fs.listStatus(path)
                      if st.isDirectory() and st.getPath().getName().startswith("v") and st.getPath().getName() < below
                      and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")))
    return spark.read.parquet(f"{table_dir.rstrip('/')}/{versions[-1]}") if versions else None


def start_dimension_load(spark: SparkSession, table: str, landing_dir: str, columns: Sequence[str],
                         key: str, table_dir: str, checkpoint_dir: str, available_now: bool = True):
    """Upsert every new file of ``landing_dir`` into the ``table`` snapshot.

    Each micro-batch is staged (deterministic staging id from file and key,
    the batch id as load number, processing time as load time), then
    ``load_dimension`` cleans, dedups, upserts and assigns keys against the
    latest stored version, and the result is written as the next version.
    The stream checkpoint makes file consumption exactly-once; a batch that
    is retried after a failure starts from the version before its own and
    rewrites its own folder.
    """
    stream = (spark.readStream.schema(text_schema(columns)).option("header", True)
              .option("escape", '"').csv(landing_dir)
              .withColumn("loaded_file", F.col("_metadata.file_name")))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        staged = batch.select(
            *columns, staging_id(table, F.concat_ws("|", F.col("loaded_file"), F.col(key)), batch_id)
            .alias("staging_id"), "loaded_file", F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"))
        own = f"v{batch_id + 1:06d}"
        existing = _latest_version(spark, table_dir, own)
        snap = load_dimension(table, staged, existing)
        snap.write.mode("overwrite").parquet(f"{table_dir.rstrip('/')}/{own}")

    writer = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
