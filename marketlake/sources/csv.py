"""CSV sources and sinks.

Raw files are read with an explicit all-string schema (no inference pass
over the data), header on, RFC-4180 quoting, and the file name from the
``_metadata`` column so lineage survives the union of many files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def text_schema(columns: Sequence[str], keep_corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
             on_malformed: str = "fail", multiline: bool = False, encoding: str = "UTF-8",
             path_glob: str | None = None, header: bool = True, whole_path: bool = False) -> DataFrame:
    """Header CSV into string columns plus ``_file`` (its name, or its whole path).

    ``on_malformed``: ``fail`` (FAILFAST), ``skip`` (lines that do not parse
    against all columns go, whatever columns are asked for later) or ``keep``
    (PERMISSIVE with the raw line in ``_corrupt_record``). ``multiline``
    allows quoted newlines (review comments) at the cost of whole-file splits.
    """
    mode = {"fail": "FAILFAST", "skip": "PERMISSIVE", "keep": "PERMISSIVE"}[on_malformed]
    reader = (spark.read.schema(text_schema(columns, on_malformed != "fail"))
              .option("header", header).option("mode", mode).option("escape", '"')
              .option("multiLine", multiline).option("encoding", encoding)
              .option("enforceSchema", False))
    if on_malformed != "fail":
        # with column pruning a line would only be judged by the columns a query asks for
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if on_malformed == "skip":
        df = df.filter(F.col(CORRUPT).isNull()).select(*columns, "_metadata")
    return df.withColumn("_file", F.col("_metadata.file_path" if whole_path else "_metadata.file_name")).drop("_metadata")


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """UTF-8 CSV with a header row and no index column."""
    w = (df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
