"""Encoding detection and repair (S2) and folder conversion (S3), as Spark jobs.

The reference tries decoders in order on each whole file and keeps the
first that succeeds. Here the pass that counts the quotes of each byte range
also tells whether its lines are UTF-8; the ranges of a file together name
its encoding. Records are cut in parallel (``sources.records``), decoded by
their file's encoding and parsed; no list of files passes through the driver.
Latin-1 maps every byte, so later fallbacks are unreachable; the list stays a
parameter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.text import transliterate
from marketlake.sources.catalog import materialize
from marketlake.sources.csv import write_csv
from marketlake.sources.records import cut_records, decoded, parse, ranges, scan_lines

# Fixed value: the reference's decoder order.
ENCODINGS = ("utf-8", "latin1", "iso-8859-1", "cp1252")

# What cp1252 has where Latin-1 has control codes, by the codec; codes it leaves open stay.
C1 = "".join(map(chr, range(0x80, 0xA0)))
CP1252 = "".join(bytes([ord(c)]).decode("cp1252", "ignore") or c for c in C1)


def detect_encoding(found: DataFrame, candidates: Sequence[str] = ENCODINGS) -> DataFrame:
    """Per file of ``records.ranges``, the first candidate that decodes every line."""
    valid = found.groupBy("file").agg(F.min("valid").alias("_utf8"))
    enc = F.lit(None).cast("string")
    for c in reversed(candidates):  # the others decode every byte
        enc = F.when(F.col("_utf8"), F.lit(c)).otherwise(enc) if c == "utf-8" else F.lit(c)
    return valid.select("file", enc.alias("encoding"))


@dataclass
class Folder:
    """The lines of a folder's files, their stored byte ranges, and each file's encoding (NULL where no candidate decodes it)."""

    lines: DataFrame
    ranges: DataFrame
    encodings: DataFrame


def read_folder(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = False,
                candidates: Sequence[str] = ENCODINGS, suffix: str = "_conv") -> Folder:
    """Every file of a folder that is not itself a conversion."""
    lines = scan_lines(spark, path, glob, recursive)
    lines = lines.filter(~F.element_at(F.split("file", "/"), -1).contains(suffix))
    found = materialize(ranges(lines), "csv-ranges")
    return Folder(lines, found, detect_encoding(found, candidates))


def decoded_records(folder: Folder, columns: Sequence[str]) -> DataFrame:
    """The CSV records of the files in their encodings, plus ``_file`` (full path) and ``encoding``."""
    records = cut_records(folder.lines, folder.ranges).join(folder.encodings.filter("encoding IS NOT NULL"), "file")
    charset = F.when(F.col("encoding") == "utf-8", "UTF-8").otherwise("ISO-8859-1")
    text = decoded(F.col("record"), charset)
    text = F.when(F.col("encoding") == "cp1252", F.translate(text, C1, CP1252)).otherwise(text)
    return parse(records.select("first", text.alias("record"), F.col("file").alias("_file"), "encoding"), columns, ("_file", "encoding"))


def read_converted(spark: SparkSession, out: str, columns: Sequence[str]) -> DataFrame:
    """The records ``convert_folder`` wrote, plus ``_file``."""
    lines = scan_lines(spark, out)
    records = cut_records(lines, materialize(ranges(lines), "csv-ranges"))
    return parse(records.withColumnRenamed("file", "_file"), columns, ("_file",))


def convert_folder(spark: SparkSession, path: str, out: str, columns: Sequence[str], glob: str = "*.csv", recursive: bool = False,
                   candidates: Sequence[str] = ENCODINGS, suffix: str = "_conv") -> DataFrame:
    """S3: decode, transliterate and write every CSV file of a folder; one report row per file.

    A file becomes the folder ``out/converted=<path below the input folder, without .csv><suffix>``
    with UTF-8 CSV files. The report has file, encoding, status (``converted``
    or ``failed``, where no candidate fits), rows, and the folder written
    (NULL for a file without records).
    """
    folder = read_folder(spark, path, glob, recursive, candidates, suffix)
    root = quote(path.split(":")[-1].strip("/")) + "/"
    stem = F.regexp_replace(F.substring_index(F.col("_file"), root, -1), r"\.csv$", "")
    named = transliterate(decoded_records(folder, columns), list(columns)).withColumn("converted", F.concat(stem, F.lit(suffix)))
    named = materialize(named, "converted-records")  # decoded once, for the files and for the report
    write_csv(named.select(*columns, "converted"), out, ("converted",))
    counts = named.groupBy(F.col("_file").alias("file"), "converted").agg(F.count(F.lit(1)).alias("rows"))
    name = F.replace(F.replace("converted", F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))  # as partition folders are named
    return folder.encodings.join(counts, "file", "left").select(
        "file", "encoding", F.when(F.col("encoding").isNotNull(), "converted").otherwise("failed").alias("status"),
        F.coalesce("rows", F.lit(0)).alias("rows"), F.concat(F.lit(f"{out}/converted="), name).alias("output"))
