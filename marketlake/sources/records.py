"""CSV records of files of any size, read in parallel although quoted fields hold line ends.

A line end belongs to a field when an odd number of quotes stands before it
in its file, so a range of a file cannot be cut into records on its own. Here
the scan's own byte ranges are used: one pass counts the quotes of each range,
a running sum over the ranges of a file (one row per range) says whether a
range starts inside a quoted field, and a second pass cuts lines into records
range by range with that start. The pieces on both sides of a border, at most
two per range, are joined at the end. Lines keep their bytes until a record
is whole; decoding and parsing are expressions on records.

Quotes are expected as RFC 4180 has them: around a whole field, doubled inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.sources.csv import text_schema

RANGE = ("file", "start", "length")


def scan_lines(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(file, start, length, at, raw): every line as undecoded bytes, the byte range it was read with and its place in it.

    The text source copies the bytes of a line without decoding them. Lines
    end at line feeds alone; a carriage return before one stays in ``raw``.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).option("lineSep", "\n")
    m = "_metadata."
    return reader.text(path).select(
        F.col(f"{m}file_path").alias("file"), F.col(f"{m}file_block_start").alias("start"), F.col(f"{m}file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))


def _quotes(raw: Column) -> Column:
    return F.octet_length(raw) - F.octet_length(F.replace(raw, F.lit('"'), F.lit("")))


def ranges(lines: DataFrame) -> DataFrame:
    """(file, start, length, inside, valid) per range: whether it starts inside a quoted field, and whether all its lines are UTF-8.

    One row per range, so the running sum of a file is a window over few rows.
    """
    counted = lines.groupBy(*RANGE).agg(F.sum(_quotes(F.col("raw")).cast("long")).alias("quotes"), F.min(F.is_valid_utf8("raw")).alias("valid"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return counted.select(*RANGE, (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"), "valid")


def cut_records(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(file, first, record): the records of all files, still undecoded; ``first`` marks a file's first one.

    ``found`` is ``ranges(lines)``, stored. Where the ranges of the two passes
    differ (the cluster changed in between and the scan was split anew) the
    query fails instead of cutting wrongly.
    """
    known = lines.join(found.select(*RANGE, "inside"), list(RANGE), "left")
    same = F.when(F.col("inside").isNull(), F.raise_error(F.lit("the scan was split differently since its quotes were counted; run it again"))).otherwise(F.col("inside"))
    in_range = Window.partitionBy(*RANGE).orderBy("at")
    quotes = F.sum(_quotes(F.col("raw"))).over(in_range.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.coalesce(quotes, F.lit(0)) + same.cast("int")) % 2 == 0  # not inside a field: a record starts here
    numbered = known.withColumn("opens", opens)
    numbered = numbered.withColumn("no", F.sum(F.col("opens").cast("int")).over(in_range))
    # the window has dealt and sorted the lines by range: the groups need no further exchange
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "raw"))), lambda x: x["raw"]), "\n")
    pieces = numbered.groupBy(*RANGE, "no").agg(text.alias("piece"), (F.sum(_quotes(F.col("raw"))) % 2).alias("odd"))
    # no = 0: goes on from the range before; odd quotes in a piece that starts a record: goes on in the next range
    pieces = pieces.withColumn("whole", (F.col("no") > 0) & (F.col("odd") == 0))
    whole = pieces.filter("whole").select("file", ((F.col("start") == 0) & (F.col("no") == 1)).alias("first"), F.col("piece").alias("record"))

    in_file = Window.partitionBy("file").orderBy("start", "no")
    border = pieces.filter("NOT whole").withColumn("joined", F.sum((F.col("no") > 0).cast("int")).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("start", "no", "piece")))
    joined = border.groupBy("file", "joined").agg(parts.alias("parts"))
    across = joined.select("file", ((F.col("parts")[0]["start"] == 0) & (F.col("parts")[0]["no"] == 1)).alias("first"),
                           F.array_join(F.transform("parts", lambda x: x["piece"]), "\n").alias("record"))
    return whole.unionByName(across)


def decoded(raw: Column, charset: Column) -> Column:
    """Bytes as text: UTF-8 as it is, Latin-1 byte by byte."""
    return F.when(charset == "UTF-8", raw).otherwise(F.decode(raw.cast("binary"), "ISO-8859-1"))


def parse(records: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``columns`` as text, and ``keep``, of (first, record) rows in text form. Headers are checked and left out, empty lines too."""
    plain = F.regexp_replace("record", "\r$", "")
    rows = records.select(*keep, "first", F.when(F.col("first"), F.ltrim(plain, F.lit("﻿"))).otherwise(plain).alias("record")).filter("record <> ''")
    fields = F.from_csv(F.col("record"), text_schema(columns).simpleString()[7:-1].replace(":", " "), {"mode": "FAILFAST", "escape": '"', "multiLine": "true"})
    rows = rows.select(*keep, "first", fields.alias("f"))
    header = F.array(*[F.col(f"f.`{c}`") for c in columns])
    named = F.coalesce(F.array_join(header, "\n", "") == "\n".join(columns), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("the header does not name the expected columns: "), F.array_join(header, ","))).cast("boolean")
    body = F.when(~F.col("first"), True).when(named, False).otherwise(wrong)
    return rows.filter(body).select(*[F.col(f"f.`{c}`") for c in columns], *keep)
