"""Table snapshots, views and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import compiled, scratch_path


#: Parquet codec of stored tables: digests and numbers written as text take half of what the default leaves.
STORED_AS = "zstd"


def save_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table version and return a scan of it.

    ``DROP ... ; CREATE ...`` becomes "write a new version folder, then read
    it": the write never touches the folder being read, so an upsert can
    read version n and produce version n+1 safely, and the returned scan has
    no lineage to recompute if an executor is lost later.
    """
    w = df.write.mode("overwrite").option("compression", STORED_AS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with compiled(df.sparkSession):
        w.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``save_snapshot`` into a fresh folder below ``spark.checkpoint.dir``."""
    return save_snapshot(df, scratch_path(df.sparkSession, name))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW`` (a stored, re-evaluated query)."""
    df.createOrReplaceTempView(name)
    return df


def list_views(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Registered views whose name starts with ``prefix``, sorted."""
    views = spark.sql("SHOW VIEWS").select(F.col("viewName").alias("view_name"))
    return views.filter(F.col("view_name").startswith(prefix)).orderBy("view_name")


def preview(df: DataFrame, n: int | None = 10, round_to_int: tuple[str, ...] = ()) -> DataFrame:
    """``SELECT ... LIMIT n`` (None: every row); numeric columns in ``round_to_int`` are
    rounded before the int cast (the reference rounds, a plain cast truncates)."""
    out = df.select(*[F.round(F.col(c)).cast("int").alias(c) if c in round_to_int else F.col(c)
                      for c in df.columns])
    return out if n is None else out.limit(n)
