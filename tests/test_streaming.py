"""File-arrival loads: two files, two micro-batches, one upserted snapshot."""

import os

from marketlake.session import scratch_path
from marketlake.streaming import start_dimension_load

COLS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(COLS) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_stream_upserts_sellers(spark):
    base = scratch_path(spark, "stream-test")
    landing, table, ckpt = (os.path.join(base, d) for d in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    _write(os.path.join(landing, "sellers_1.csv"), [("s1", "00001", "rio", "RJ"), ("s2", "00002", "sao paulo", "SP")])
    q = start_dimension_load(spark, "sellers", landing, COLS, "seller_id", table, ckpt)
    q.awaitTermination()
    _write(os.path.join(landing, "sellers_2.csv"), [("s2", "00002", "", "SP"), ("s3", "00003", "belem", "PA")])
    q = start_dimension_load(spark, "sellers", landing, COLS, "seller_id", table, ckpt)
    q.awaitTermination()
    versions = sorted(d for d in os.listdir(table) if d.startswith("v"))
    snap = {r["seller_id"]: r for r in spark.read.parquet(os.path.join(table, versions[-1])).collect()}
    assert set(snap) == {"s1", "s2", "s3"}
    assert snap["s2"]["seller_city"] == "sao paulo"          # blank incoming keeps the stored city
    assert snap["s2"]["row_source_file"] == "sellers_2.csv"  # audit follows the newer file
    assert sorted(r["seller_sk"] for r in snap.values()) == [1, 2, 3]
