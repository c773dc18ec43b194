"""Hard-negative mining with exact Four-Russians scores.

Components become integers, and a row's integers are stored as bit planes:
for every plane one byte per group of eight dimensions. An anchor's eight
integers of a group have 256 subset sums; a candidate's byte of that group and
plane is the index of the sum it adds. A score is the lookups of all groups,
shifted by plane and added (the sign plane is subtracted): the exact integer
inner product, without a multiplication.

Scores are wanted twice. First each anchor meets the rows of its own label and
keeps its best as positives; then it meets all rows and keeps, for every
positive, the best of another label whose score lies in the positive's window.
Anchors are a stated query set: their blocks (of bounded size, the tables live
in one task) meet slices of all rows, so a label that holds most rows is many
tasks. A task reads a slice in batches and returns its few best rows per
anchor; the best of all slices come from a ranked window, which drops the rest
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketlake.llm.common import discard, stored


@dataclass(frozen=True)
class Settings:
    """``positives`` and ``negatives`` per anchor and positive; a negative scores ``low`` to ``high`` percent of the positive.

    ``anchors`` and ``rows`` are the sizes of the blocks and slices that meet in a task; they do not change the result.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchors: int = 1024
    rows: int = 8192


def usable(v: Column) -> Column:
    """Not null, without null or non-finite components."""
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


# -- integers, bit planes, tables

def integers(flat: np.ndarray, sizes: np.ndarray, groups: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors laid end to end; the components a vector lacks are 0."""
    out = np.zeros((len(sizes), 8 * groups), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = np.floor(scale * flat.astype(np.float64)).astype(np.int64)
    return out


def pack(v: np.ndarray, bits: int) -> np.ndarray:
    """(rows, planes, groups) bytes of two's-complement integers."""
    planes = (v[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers that ``pack`` has packed."""
    bits = planes.shape[1]
    worth = np.left_shift(np.int64(1), np.arange(bits))
    worth[-1] = -worth[-1]
    return np.einsum("rpd,p->rd", np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64), worth)


def subset_sums(v: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, rows): for every byte, the sum of those of a group's eight integers whose bit is set."""
    groups = v.shape[1] // 8
    sums = np.zeros((groups, 256, len(v)), kind)
    for bit in range(8):
        sums[:, 1 << bit:2 << bit] = sums[:, :1 << bit] + v[:, bit::8].T.astype(kind)[:, None, :]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray, step: int = 128) -> np.ndarray:
    """(anchors, rows) inner products: lookups of each plane are added, planes are shifted together from the top."""
    rows, bits, groups = planes.shape
    out = np.empty((sums.shape[2], rows), sums.dtype)
    for at in range(0, rows, step):
        part = planes[at:at + step]
        total = np.zeros((len(part), sums.shape[2]), sums.dtype)
        found = np.empty_like(total)
        for j in reversed(range(bits)):
            total += total
            for g in range(groups):
                np.take(sums[g], part[:, j, g], axis=0, out=found, mode="clip")
                if j == bits - 1:
                    total -= found
                else:
                    total += found
        out[:, at:at + len(part)] = total.T
    return out


def best(s: np.ndarray, k: int, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and scores of the ``k`` largest of each row, the first place first among equals; changes ``s``. ``least`` marks what is not there."""
    found, every = [], np.arange(len(s))
    for _ in range(k):
        at = s.argmax(axis=1)
        found.append((at, s[every, at]))
        s[every, at] = least
    return found


# -- tasks

def _meet(pick: Callable, bits: int, groups: int, kind: type) -> Callable:
    """Rows of a part come as its anchors, then its slice of rows; ``pick`` gets (anchors, rows, scores) of each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, anchors, sums = None, [], None
        for batch in batches:
            for b in _runs(batch):
                key = b.column("part")[0].as_py()
                if key != part:
                    part, anchors, sums = key, [], None
                rows = b.to_pandas()
                asks = rows["asks"].to_numpy(bool)
                if asks.any():
                    anchors.append(rows[asks])
                rows = rows[~asks].reset_index(drop=True)
                if not anchors or not len(rows):
                    continue
                if sums is None:
                    anchors = [pd.concat(anchors, ignore_index=True)]
                    sums = subset_sums(unpack(_planes(anchors[0], bits, groups)), kind)
                yield from pick(anchors[0], rows, scores(_planes(rows, bits, groups), sums))
    return run


def _planes(rows: pd.DataFrame, bits: int, groups: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows["planes"]), np.uint8).reshape(len(rows), bits, groups)


def _runs(batch: pa.RecordBatch, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch that belong to one part, of bounded length."""
    parts = batch.column("part").to_numpy(zero_copy_only=False)
    ends = np.append(np.flatnonzero(parts[1:] != parts[:-1]) + 1, len(parts))
    start = 0
    for end in ends:
        for at in range(start, end, most):
            yield batch.slice(at, min(most, end - at))
        start = end


def _least(s: np.ndarray) -> int:
    return int(np.iinfo(s.dtype).min)


def _best_of_label(k: int) -> Callable:
    """The ``k`` best rows per anchor, itself excepted. All rows of the part bear the anchor's label."""
    def pick(anchors: pd.DataFrame, rows: pd.DataFrame, s: np.ndarray) -> Iterator[pa.RecordBatch]:
        least, ids = _least(s), rows["id"].to_numpy()
        lo, hi = np.searchsorted(ids, anchors["id"].to_numpy(), "left"), np.searchsorted(ids, anchors["id"].to_numpy(), "right")
        for a in np.flatnonzero(hi > lo):
            itself = rows["row"].to_numpy()[lo[a]:hi[a]] == anchors["row"].iloc[a]
            s[a, lo[a]:hi[a]][itself] = least
        for at, score in best(s, k, least):
            there = score > least
            if not there.any():
                continue
            a, r = anchors[there], rows.iloc[at[there]]
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "id": a["id"].to_numpy(), "row": a["row"].to_numpy(), "label": a["label"].to_numpy(), "planes": a["planes"].to_numpy(),
                "positive": r["id"].to_numpy(), "positive_row": r["row"].to_numpy(), "score": score[there].astype(np.int64)}), preserve_index=False)
    return pick


def _best_of_windows(s: Settings) -> Callable:
    """The best rows of another label inside each positive's window of scores."""
    def pick(anchors: pd.DataFrame, rows: pd.DataFrame, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        least = _least(found)
        codes = pd.factorize(pd.concat([anchors["label"], rows["label"]], ignore_index=True))[0]
        found[codes[:len(anchors), None] == codes[None, len(anchors):]] = least
        have = anchors["positive_scores"].map(len).to_numpy()
        for p in range(int(have.max(initial=0))):
            who = np.flatnonzero(have > p)
            score = np.array([x[p] for x in anchors["positive_scores"].iloc[who]], np.int64)
            top, bottom = score * s.high // 100, -(-score * s.low // 100)
            # a window may lie beyond what the scores' type holds; no score is there then
            ceiling = np.clip(top, least + 1, np.iinfo(found.dtype).max).astype(found.dtype)
            inside = np.where(found[who] <= ceiling[:, None], found[who], found.dtype.type(least))
            for at, value in best(inside, s.negatives, least):
                there = (value > least) & (value >= bottom) & (value <= top)
                if not there.any():
                    continue
                a, r = anchors.iloc[who[there]], rows.iloc[at[there]]
                yield pa.RecordBatch.from_pandas(pd.DataFrame({
                    "id": a["id"].to_numpy(), "row": a["row"].to_numpy(), "p": np.full(len(a), p, np.int32),
                    "positive": [x[p] for x in a["positives"]], "positive_score": score[there],
                    "negative": r["id"].to_numpy(), "negative_row": r["row"].to_numpy(), "score": value[there].astype(np.int64)}), preserve_index=False)
    return pick


# -- the operator

def _indexed(rows: DataFrame, id_col: Column, label: Column, vec: Column, anchor: Column, s: Settings) -> tuple[DataFrame, int, int]:
    """Stored (id, label, asks, planes, row) of the rows that take part, and the numbers of planes and groups."""
    rows = rows.select(id_col.alias("id"), label.alias("label"), vec.cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    widest, largest = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x) * s.scale)))).first()
    groups, most = max(1, -(-(widest or 0) // 8)), largest or 0.0
    if most >= 2.0 ** 31 or 8 * groups * (int(most) + 1) ** 2 >= 2 ** 62:
        raise ValueError(f"scores of components as large as {most / s.scale:g} may pass 64 bits")
    bits = (int(most) + 1).bit_length() + 1
    scale = s.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            flat = v.flatten().to_numpy(zero_copy_only=False)
            planes = pack(integers(flat, v.value_lengths().to_numpy(zero_copy_only=False), groups, scale), bits).reshape(b.num_rows, -1)
            kept = [n for n in b.schema.names if n != "v"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array([x.tobytes() for x in planes], pa.binary())], names=[*kept, "planes"])

    packed = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, asks boolean, planes binary")
    packed = packed.groupBy("id", "label", "planes").agg(F.max("asks").alias("asks"))
    return stored(packed.withColumn("row", F.xxhash64("label", "planes")), "planes"), bits, groups


def _parts(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """Every block of anchors beside every slice of rows of the same ``grp``; both have ``blocks`` and ``slices``, their numbers."""
    def part(block: Column, piece: Column) -> Column:
        return F.concat_ws(":", F.col("grp").cast("string"), block.cast("string"), piece.cast("string"))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    block, piece = (F.pmod(F.xxhash64("id", "row"), F.col(n)) for n in ("blocks", "slices"))
    asked = anchors.withColumn("other", every("slices")).withColumn("part", part(block, F.col("other"))).withColumn("asks", F.lit(True))
    given = rows.withColumn("other", every("blocks")).withColumn("part", part(F.col("other"), piece)).withColumn("asks", F.lit(False))
    return asked.unionByName(given, allowMissingColumns=True).drop("blocks", "slices", "other", "grp")


def _dealt(parts: DataFrame, n: int) -> DataFrame:
    return parts.repartition(max(1, n), "part").sortWithinPartitions("part", F.desc("asks"), "id", "row")


def mine(rows: DataFrame, anchor: Column, id_col: str | Column = "vec_id", label: str | Column = "label", vec: str | Column = "embedding",
         settings: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` holds for.

    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. Rows equal in id, label and integers count once;
    rows that share only an id are rows of their own. Vectors shorter than the
    longest are 0 beyond their end. Equal scores are ordered by id. An anchor
    without another row of its label, or a window without a row, gives no
    row; an empty table gives none. Components so large that a score could
    pass 64 bits end the query, as an overflow does.
    """
    s = settings
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    index, bits, groups = _indexed(rows, as_column(id_col), as_column(label), as_column(vec), anchor, s)
    kind = np.int32 if 8 * groups * 4 ** (bits - 1) < 2 ** 30 else np.int64
    id_type, label_type = (index.schema[c].dataType.simpleString() for c in ("id", "label"))

    # positives: blocks and slices per label
    blocks = F.ceil(F.sum(F.col("asks").cast("long")) / s.anchors).cast("long")
    sizes = stored(index.groupBy("label").agg(blocks.alias("blocks"), F.ceil(F.count(F.lit(1)) / s.rows).cast("long").alias("slices"))
                   .filter("blocks > 0"), "label-sizes")
    known = index.join(sizes, "label").withColumn("grp", F.col("label"))
    tasks = sizes.agg(F.sum(F.col("blocks") * F.col("slices"))).first()[0] or 0
    near = (_dealt(_parts(known.filter("asks"), known), min(tasks, 1 << 16))
            .mapInArrow(_meet(_best_of_label(s.positives), bits, groups, kind),
                        f"id {id_type}, row long, label {label_type}, planes binary, positive {id_type}, positive_row long, score long"))
    first = F.row_number().over(W.partitionBy("id", "row").orderBy(F.desc("score"), "positive", "positive_row"))
    top = near.withColumn("p", first).filter(F.col("p") <= s.positives)
    listed = F.array_sort(F.collect_list(F.struct("p", "positive", "score")))
    anchors = stored(top.groupBy("id", "row", "label", "planes").agg(listed.alias("l"))
                     .select("id", "row", "label", "planes", F.col("l.positive").alias("positives"), F.col("l.score").alias("positive_scores")), "positives")

    # negatives: all rows
    n_blocks, n_slices = max(1, -(-anchors.count() // s.anchors)), max(1, -(-index.count() // s.rows))
    whole = [F.lit(0).alias("grp"), F.lit(n_blocks).cast("long").alias("blocks"), F.lit(n_slices).cast("long").alias("slices")]
    parts = _parts(anchors.select("*", *whole), index.drop("asks").select("*", *whole))
    found = (_dealt(parts, min(n_blocks * n_slices, 1 << 16))
             .mapInArrow(_meet(_best_of_windows(s), bits, groups, kind),
                         f"id {id_type}, row long, p int, positive {id_type}, positive_score long, negative {id_type}, negative_row long, score long"))
    rank = F.row_number().over(W.partitionBy("id", "row", "p").orderBy(F.desc("score"), "negative", "negative_row"))
    out = stored(found.withColumn("rank", rank).filter(F.col("rank") <= s.negatives)
                 .select(F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
                         "positive_score", F.col("score").alias("negative_score")), "negatives")
    discard(index, sizes, anchors)
    return out


OP11_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM given a JOIN given c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
