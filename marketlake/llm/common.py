"""Helpers shared by the operators: shared-folder tables, table loading, bounded samples."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, seen by driver and executors.

    Where the setting is absent a folder is made only for a ``local`` master
    (tests, a laptop); on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="marketlake-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    ``stored_path`` of the result names the folder (see ``discard``).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing will read again."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def extended(batch: pa.RecordBatch, drop: tuple, **new: pa.Array) -> pa.RecordBatch:
    """``batch`` without some columns and with new ones at the end; the others are passed on as they are."""
    kept = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new.values()], names=[*kept, *new])


def give_back() -> None:
    """Return this Python worker's freed memory to the system at the end of a task: an idle worker outlives its stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim:
        trim(0)


def ddl(df: DataFrame, drop: tuple = ()) -> str:
    """The schema of ``df`` without some columns, for mapInArrow."""
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name not in drop)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column that a resolver could take for it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(c: Column) -> Column:
    """An id as text; null becomes the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def in_sample(key: Column, share: Column | float) -> Column:
    """True for about ``share`` of the keys, chosen by hash alone (the same at every run)."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < share * F.lit(float(1 << 30))
