"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verified Hamming distance.

Fingerprints are made inside the Arrow batches of one scan. Everything after
works on *distinct* fingerprints: copies of a text never meet each other.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits agree on at
least ``blocks - max_bits`` of ``blocks`` bit blocks, so they share one of the
C(blocks, max_bits) keys that keep only those blocks. The search is exact for
every ``blocks``; more blocks give longer keys (fewer chance meetings) and
more rows. ``block_count`` picks the smallest number whose keys have at least
four times as many values as there are fingerprints.

Dense groups are contracted before pairs are compared: each key group links
its members to its smallest and largest fingerprint where the distance allows,
the components of those links are found, and only groups that still hold two
components compare pairs, between components, with the group's largest
component on one side only. A group of thousands of near copies therefore
yields a row per member, not a row per pair, and loses no link that could
join two components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, extended, stored
from marketlake.llm.components import components

SEED = 42
#: Shingles hashed at a time, so that a very long text needs a bounded bit matrix.
PIECE = 1 << 15


def _hashes(buf: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(buf[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned SimHash of the word shingles of a text (0 without words)."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    buf = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(buf, SEED)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lens[:-1] + 1)))
    ends = (starts + lens)[shingle - 1:].tolist()
    n = len(ends)
    starts = starts[:n].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        h = _hashes(buf, starts[at:at + PIECE], ends[at:at + PIECE])
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) per row; ``fp`` holds the 64 bits as a signed long.

    Null and empty texts have fingerprint 0. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("t")], np.uint64)
            yield extended(b, ("t",), fp=pa.array(fps.view(np.int64)))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def block_count(n: int, max_bits: int) -> int:
    """The smallest number of blocks whose keys have 4 n values or more."""
    for blocks in range(max_bits + 1, 17):
        if (64 * (blocks - max_bits)) // blocks >= np.log2(4 * max(n, 1)):
            return blocks
    return 16


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Signed 64-bit masks, each keeping ``blocks - max_bits`` of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(parts[i] for i in keep) for keep in combinations(range(blocks), blocks - max_bits)]
    assert len(masks) == comb(blocks, max_bits)
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _apart(x: str, y: str) -> F.Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def fingerprint_groups(distinct: DataFrame, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """(fp, group) for each distinct fingerprint that links to another one.

    ``group`` is the smallest fingerprint reachable over links of at most
    ``max_bits`` differing bits.
    """
    masks = block_masks(blocks or block_count(distinct.count(), max_bits), max_bits)
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])).alias("x")
    ).select("fp", "x.m", "x.k")
    shared = keys.groupBy("m", "k").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo < hi")
    members = stored(keys.join(shared, ["m", "k"]), "members")
    stars = stored(
        members.select("fp", F.explode(F.array("lo", "hi")).alias("to")).filter("fp <> `to`").filter(_apart("fp", "to") <= max_bits)
        .select(F.greatest("fp", "to").alias("a"), F.least("fp", "to").alias("b")).distinct(), "stars")
    first = stored(components(stars), "first")

    comp = F.coalesce("component", "fp").alias("c")
    labelled = stored(members.join(first, members["fp"] == first["node"], "left").select("m", "k", "fp", comp), "labelled")
    open_groups = (labelled.groupBy("m", "k", "c").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy("m", "k").agg(F.max(F.struct("n", "c"))["c"].alias("most"), F.count(F.lit(1)).alias("cs"))
                   .filter("cs > 1").drop("cs"))
    mixed = stored(labelled.join(open_groups, ["m", "k"]), "mixed")
    left = mixed.filter("c <> most").select("m", "k", F.col("fp").alias("fp1"), F.col("c").alias("c1"))
    pairs = (left.join(mixed.drop("most"), ["m", "k"]).filter("c1 <> c").filter(_apart("fp1", "fp") <= max_bits)
             .select(F.greatest("c1", "c").alias("a"), F.least("c1", "c").alias("b")).distinct())
    over = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    out = stored(components(over.union(pairs)), "groups")
    discard(members, stars, labelled, mixed, first)
    return out.select(F.col("node").alias("fp"), F.col("component").alias("group"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per input row: id, fp, grp (a fingerprint naming the group), component (smallest id of the group).

    Rows with equal fingerprints are one node. A null id takes part in the
    links and is returned; the component ignores null ids (null if the group
    has no other). Repeated rows are returned as often as they come.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    groups = fingerprint_groups(distinct.select("fp"), max_bits)
    named = distinct.join(groups, "fp", "left").select("fp", "least", F.coalesce("group", "fp").alias("grp"))
    heads = named.groupBy("grp").agg(F.min("least").alias("component"))
    lookup = stored(named.join(heads, "grp").select("fp", "grp", "component"), "lookup")
    return fps.join(lookup, "fp").select("id", "fp", "grp", "component")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each near-duplicate group: the one with the smallest id.

    Rows that share both group and id count as one document (one of them
    stays). Groups without any id keep one row.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    heads = found.filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("id", "grp").agg(F.count(F.lit(1)).alias("n"))
    heads = stored(heads, "heads")
    own = docs[id_col].cast("long")
    once = heads.filter(F.col("id").isNotNull() & (F.col("n") == 1)).select("id")
    kept = docs.join(once, own == once["id"], "left_semi")
    odd = heads.filter(F.col("id").isNull() | (F.col("n") > 1))
    if odd.isEmpty():
        return kept
    # rows without an id, or whose id comes again: fingerprint them beside their columns and keep one per group
    odd_ids = odd.select("id").distinct()
    again = docs.join(odd_ids, own.eqNullSafe(odd_ids["id"]), "left_semi")
    cols = docs.columns
    packed = again.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), F.struct(*cols).alias("row"))
    packed = packed.withColumn("row_key", F.xxhash64("row"))
    pick = (fingerprints(packed, "row_key", "t", shingle).withColumnRenamed("id", "row_key").distinct()
            .join(packed, "row_key").join(odd.withColumnRenamed("id", "oid"), F.col("id").eqNullSafe(F.col("oid")))
            .join(stored(found.select(F.col("fp").alias("f"), F.col("grp").alias("g")).distinct(), "found"),
                  (F.col("fp") == F.col("f")) & (F.col("g") == F.col("grp"))))
    rest = pick.groupBy("id", "grp").agg(F.min_by("row", "row_key").alias("row")).select("row.*")
    return kept.unionByName(rest)
