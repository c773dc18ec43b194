"""Corpus pipeline: language ID, SimHash near-dedup, benchmark decontamination, source mixing, sharding.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``; every stage's rows
are written to the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import decontaminate, langid, mixing, sharding, simhash
from marketlake.llm.common import free_name, stored, table

#: What the sharding stage adds to a document.
PLACE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters; mixtures of languages stay, and all rows where no language could be learned."""
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs
    whole = free_name(docs, "whole_row")
    row = docs.select("*", F.struct(*docs.columns).alias(whole))
    found = langid.label(row, model, keep=(whole,))
    return found.filter(F.col("lang_pred") != "und").select(f"{whole}.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark items, verbatim or re-parameterised."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixed_rows(docs, mixing.word_count())


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; columns of the input that bear the names of ``PLACE`` give way to them."""
    whole = free_name(docs, "whole_row")
    own = [F.col(c) for c in docs.columns if c.lower() not in PLACE]
    row = docs.select("*", F.struct(*own).alias(whole))
    return sharding.shard(row, keep=(whole,)).select(f"{whole}.*", *PLACE)


STAGES = [("language ID", language), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("mixing sources", mixture), ("sharding", shards)]

#: SQL cannot express the language model or XXH64 with a seed; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
