"""Registered queries against DuckDB, and the pipeline against its stages' definitions."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marketlake.llm import mixing, simhash
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["op7_chat", "op10_mixing", "op11_hard_negatives", "op13_collocations"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = entry.queries()[name](spark, SF_SMALL)
    want = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want.fetchall(), key=repr)


CLASHING = ["id", "t", "size", "shard", "fp", "key", "dedup_id", "contaminated_id", "mix_row", "whole_row", "Law", "copies"]


@pytest.mark.parametrize("rows", [0, 40])
def test_pipeline_takes_odd_rows_and_clashing_names(spark, tmp_path, rows):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(rows)
    odd = docs.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text").crossJoin(docs.limit(1).drop("doc_id", "text"))
    docs = docs.unionByName(odd).unionByName(docs.limit(3))
    docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    place = set(corpus_pipeline.PLACE)
    assert out.columns == [c for c in docs.columns + CLASHING if c.lower() not in place] + list(corpus_pipeline.PLACE)
    got = out.collect()
    assert len(got) > 0 if rows else got == []
    assert all(r["key"] == CLASHING.index("key") and r["fp"] == CLASHING.index("fp") for r in got)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    ids = {r["doc_id"] for r in out}
    assert all(r["text"] == texts[r["doc_id"]] for r in out) and {r["shard"] for r in out} <= set(range(24))
    assert not any(b in texts[i] for i in ids for b in bench)
    fps = {i: simhash.fingerprint(texts[i]) for i in ids}
    assert all((fps[a] ^ fps[b]).bit_count() > 4 for a in ids for b in ids if a < b)
    gone = [i for i in texts if i not in ids]
    near = {i for i in texts if any(j < i and (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).bit_count() <= 4 for j in fps)}
    leaks = {i for i in texts if any(b in texts[i] for b in bench)}
    # what goes is a copy, a leak, or beyond its source's budget (the mix takes none of it)
    rest = [i for i in gone if i not in near and i not in leaks]
    assert len(rest) < len(texts) / 4
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert mixing.BUCKETS == 4096


def test_language_stage_keeps_mixtures_and_rows_without_labels(spark):
    texts = {"en": "the cat sat on the mat and the dog ran to the house", "ru": "кошка сидела на ковре и собака бежала домой",
             "el": "η γάτα κάθισε στο χαλί και ο σκύλος έτρεξε"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(list(texts.items()) * 20)] + [(100, " ".join(" ".join([t] * 8) for t in texts.values()), None), (101, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert kept == set(range(60)) | {100}
    assert corpus_pipeline.language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "").count() == len(rows)
