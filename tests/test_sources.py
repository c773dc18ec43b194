"""Source / catalog helpers: views, listing, preview, CSV read modes, lineage backfill."""

import os

import pytest
from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.sources import encoding as ENC
from marketlake.sources import records
from marketlake.sources.catalog import list_views, preview, register_view, save_snapshot
from marketlake.sources.csv import CORRUPT, read_csv
from marketlake.sources.staging import backfill_lineage, stage


def test_views_listing_and_preview(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5), (3, 4.4)], "k int, w double")
    register_view(df, "rpt_test_b")
    register_view(df, "rpt_test_a")
    register_view(df, "int_other")
    names = [r[0] for r in list_views(spark, "rpt_test_").collect()]
    assert names == ["rpt_test_a", "rpt_test_b"]
    rows = preview(spark.table("rpt_test_a"), 2, round_to_int=("w",)).collect()
    assert len(rows) == 2 and {r["w"] for r in rows} <= {3, 4}  # rounded, not truncated


def test_snapshot_versions_are_independent(spark):
    base = scratch_path(spark, "snap")
    v1 = save_snapshot(spark.range(3), os.path.join(base, "v1"))
    v2 = save_snapshot(v1.withColumn("id", F.col("id") + 10), os.path.join(base, "v2"))
    assert sorted(r[0] for r in v2.collect()) == [10, 11, 12]
    assert sorted(r[0] for r in v1.collect()) == [0, 1, 2]


def test_csv_modes(spark):
    path = scratch_path(spark, "csv-modes")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w", encoding="utf-8") as f:
        f.write("a,b\n1,x\n2,y,extra\n3,\"multi\nline\"\n")
    cols = ["a", "b"]
    skip = read_csv(spark, path, cols, on_malformed="skip", multiline=True)
    assert sorted(r["a"] for r in skip.collect()) == ["1", "3"]
    keep = read_csv(spark, path, cols, on_malformed="keep", multiline=True).collect()
    assert [r[CORRUPT] is not None for r in sorted(keep, key=lambda r: r["a"])] == [False, True, False]
    assert {r["_file"] for r in keep} == {"a.csv"}


def test_stage_and_backfill(spark):
    rows = spark.createDataFrame([("k1", None), ("k2", "f.csv")], "_key string, loaded_file string")
    out = stage(rows, "t", F.col("_key"), 1, "2024-01-01 00:00:00", loaded_file="default.csv").collect()
    assert sorted(r["loaded_file"] for r in out) == ["default.csv", "f.csv"]
    assert len({r["staging_id"] for r in out}) == 2
    again = stage(rows, "t", F.col("_key"), 1, "2024-01-01 00:00:00").collect()
    assert {r["staging_id"] for r in out} == {r["staging_id"] for r in again}  # deterministic
    assert backfill_lineage(rows, "x.csv").filter(F.col("loaded_file").isNull()).count() == 0


def test_folder_conversion_keys_files_by_path_and_respects_the_order(spark):
    root = scratch_path(spark, "mixed")
    for folder, enc in (("a b", "utf-8"), ("c", "latin1"), ("d", "cp1252")):
        os.makedirs(f"{root}/{folder}")
        with open(f"{root}/{folder}/orders.csv", "w", encoding=enc) as f:
            f.write('k,t\n1,"caf\u00e9, ""x""\nS\u00e3o"\n' + ("2,\u201cq\u201d \u20ac\n" if enc == "cp1252" else ""))
    with open(f"{root}/c/old_conv.csv", "w") as f:
        f.write("k,t\n9,z\n")

    def texts(candidates):
        found = ENC.read_folder(spark, root, recursive=True, candidates=candidates)
        return {(r["_file"].split("/")[-2], r["k"]): r["t"] for r in ENC.decoded_records(found, ["k", "t"]).collect()}
    got = texts(("utf-8", "cp1252"))
    assert {k: v for k, v in got.items() if k[1] == "1"} == {(d, "1"): 'caf\u00e9, "x"\nS\u00e3o' for d in ("a%20b", "c", "d")}
    assert got[("d", "2")] == "\u201cq\u201d \u20ac" and len(got) == 4
    assert texts(("latin1", "utf-8"))[("a%20b", "1")].startswith("caf\u00c3\u00a9")
    out = scratch_path(spark, "conv")
    report = {r["file"].split("/")[-2]: r for r in ENC.convert_folder(spark, root, out, ["k", "t"], recursive=True, candidates=("utf-8", "cp1252")).collect()}
    assert {d: (r["encoding"], r["status"], r["rows"]) for d, r in report.items()} == {
        "a%20b": ("utf-8", "converted", 1), "c": ("cp1252", "converted", 1), "d": ("cp1252", "converted", 2)}
    for r in report.values():
        rows = ENC.read_converted(spark, r["output"], ["k", "t"]).collect()
        assert len(rows) == r["rows"] and {x["t"] for x in rows if x["k"] == "1"} == {'cafe, "x"\nSao'}
    only = {r["status"] for r in ENC.convert_folder(spark, root, scratch_path(spark, "conv"), ["k", "t"], recursive=True, candidates=("utf-8",)).collect()}
    assert only == {"converted", "failed"}


def one_file(path, rows, end="\n"):
    quoted = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\r\n') or x == "" else x
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\ufeffk,t" + end + end + "".join(f"{k},{quoted(t) if t is not None else ''}{end}" for k, t in rows))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_of_quoted_line_ends_is_cut_in_parallel(spark, end):
    root = scratch_path(spark, "records")
    os.makedirs(root)
    texts = ["plain", 'a "quoted" word', "two\nlines", "\n\n,\"\n", "", None, "tail\r\n", 'only ""quotes""', "x" * 700 + "\n" + "y" * 700, "\n" * 3000]
    rows = [(str(i), texts[i * 7 % len(texts)]) for i in range(400)]
    one_file(f"{root}/big.csv", rows, end)
    one_file(f"{root}/small.csv", rows[:3], end)
    sizes = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for n in sizes:
            spark.conf.set(n, "5000")
        lines = records.scan_lines(spark, root)
        found = save_snapshot(records.ranges(lines), scratch_path(spark, "ranges"))
        n = found.filter("file LIKE '%big.csv'").count()
        assert n == -(-os.path.getsize(f"{root}/big.csv") // 5000) and lines.rdd.getNumPartitions() >= n
        assert found.filter("inside").count() > 3
        got = records.parse(records.cut_records(lines, found), ["k", "t"]).collect()
        with pytest.raises(Exception, match="does not name"):
            records.parse(records.cut_records(lines, found), ["k", "other"]).collect()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        again = records.scan_lines(spark, root)
        with pytest.raises(Exception, match="split differently"):
            records.cut_records(again, found).collect()
    finally:
        for k, v in sizes.items():
            spark.conf.set(k, v)
    want = read_csv(spark, root, ["k", "t"], multiline=True).drop("_file").collect()
    written = [(k, t or None) for k, t in [*rows, *rows[:3]]]  # an empty field is NULL, quoted or not
    assert sorted(map(tuple, got), key=repr) == sorted(written, key=repr)
    # the whole-file reader puts a line feed for the line end it has detected, inside fields too
    plain = lambda rows: sorted(((k, t and t.replace(end, "\n")) for k, t in rows), key=repr)
    assert plain(got) == plain(want)
