"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: event times are compared in UTC, ANSI casts
# raise on malformed input (the strict parsers depend on it) and AQE re-plans
# joins / coalesces partitions / splits skewed partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marketlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's base configuration.

    On a cluster ``master`` stays None (spark-submit decides) and the shuffle
    partition count should be sized so one partition stays around 128-256 MB
    of shuffle data; locally it defaults to 2x the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and master and master.startswith("local"):
        cores = master[master.find("[") + 1:-1] if "[" in master else "1"
        n = os.cpu_count() if cores == "*" else int(cores)
        shuffle_partitions = max(2, 2 * n)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be storage every
    executor sees; without it a cluster job fails. Only a ``local`` master
    (unit tests, a laptop) gets a private temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "marketlake", f"{name}-{uuid.uuid4().hex[:12]}")


#: Bytes of a method beyond which the JVM interprets it for ever instead of compiling it.
LONGEST_COMPILED = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside have no method too long to be compiled.

    Spark fuses a stage's operators into one method of at most 65,535 bytes,
    which for wide rows is more than the JVM compiles: such a stage runs
    several times slower. Stages beyond ``LONGEST_COMPILED`` run operator by
    operator, with each one's expressions in methods of their own. The
    session's own setting is put back, unless it is lower already.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LONGEST_COMPILED)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nothing refers to any more.

    Spark deletes them when the driver happens to collect its garbage, which
    a large heap puts off; until then they stand on the disk beside the tables.
    What Spark's listeners have not finished with yet goes with a later call.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
