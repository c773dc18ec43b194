"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (chat, collocations, decontaminate, embedding_dedup, hard_negatives, langid, mixing, page_text, pii, sharding, simhash,
                            suffix_dedup, toxicity)
from marketlake.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.filter(~F.col("held_out")))
    found = langid.label(docs.select("doc_id", "held_out", "text"), model, keep=("held_out",))
    return found.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", "spans")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    found = chat.read_back(chat.render(chat.fold(chat.log_of_turns(turns.unionByName(added)))))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), mixing.word_count())
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, label=label)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.redactions(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_sharding": op3_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_page_text": op5_page_text,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_chat": op7_chat,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_pii": op12_pii,
    "op13_collocations": op13_collocations,
}

#: DuckDB SQL where SQL can express the query.
ORACLES: dict[str, str] = {"op7_chat": chat.OP7_SQL, "op10_mixing": mixing.OP10_SQL, "op11_hard_negatives": hard_negatives.OP11_SQL,
                           "op13_collocations": collocations.OP13_SQL}
