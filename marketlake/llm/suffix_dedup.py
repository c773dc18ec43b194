"""Removal of bytes covered by repeated strings: distributed prefix doubling over anchored suffixes.

Plain prefix doubling ranks every byte position again at offsets 1, 2, 4, ...
That is nine sorts of a table with a row per byte, far more than the input.
The same pairs of ranks at growing offsets are used here, with two savings.

*Ranks are names, not numbers.* The rank of the string of length 2k at i is
named by the pair (name of length k at i, name of length k at i + k); names
are polynomial hashes, so a rank needs no global numbering. Decisions rest on
pairs of 64-bit names; single names only prune.

*Positions are anchored.* Among the 256 suffixes that start in the first
bytes of a window, the one whose 32-byte name is least is the window's anchor.
Equal windows have equal anchors at equal offsets, and all window starts with
one anchor form a run: about one row per 128 bytes.

1. Rank of 144 bytes at the anchor: Spark groups the runs by it and drops the
   unique ones, which cannot repeat (the first reranking).
2. Rank of a whole run's bytes, a pair of names: runs that come twice are
   settled, every window in them repeats. A thousand copies of a passage end
   here, pre-aggregated into one row.
3. Where a surviving anchor rank holds an unsettled run, one representative
   of each distinct run is cut into blocks of 16 starts. What all windows of a
   block share (385 bytes) is ranked: unique ones cannot repeat. The bytes the
   block covers are ranked: blocks that come twice are settled.
4. Only the blocks left, those around the ends of a repeat, are spelled out
   into window starts and ranked by the pair (200 bytes at p, 200 bytes at
   p + 200), the last doubling.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, extended, shared_folder, stored
from marketlake.operators.skew import counted_semi_join

#: Bytes of a name used to choose anchors, suffixes an anchor is chosen from, bytes hashed at a time.
GRAM, SPAN, PIECE = 32, 256, 1 << 20
#: Window starts in a block.
BLOCK = 16
BASE = 0x9E3779B97F4A7C15 | 3
_TABLE = np.random.default_rng(400).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for pieces of up to n bytes."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, PIECE + 4096)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.empty(size, np.uint64)
            p[0] = 1
            done = 1
            while done < size:
                k = min(done, size - done)
                p[done:done + k] = p[:k] * np.uint64(pow(base, done, 1 << 64))
                done += k
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


class _Names:
    """Names of all substrings of a byte array in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple:
    """(text index, first start, last start, anchor, anchor rank, rank pair) of all runs in texts laid end to end."""
    n = len(data)
    names = _Names(data)
    lens = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends)), lens)
    starts = np.nonzero(np.arange(n) + length <= ends[text])[0]
    if not len(starts):
        e = np.zeros(0, np.int64)
        return e, e, e, e, e, e, e
    at = np.arange(n - GRAM + 1)
    low = np.uint64(PIECE.bit_length() + 1)
    key = names.of(at, at + GRAM) * np.uint64(0xD6E8FEB86659FD93)
    key = (key >> low << low) | at.astype(np.uint64)          # leftmost of equal names
    k = 1
    while k < SPAN:
        step = min(k, SPAN - k)
        key = np.minimum(key[:-step], key[step:])
        k += step
    anchor = (key[starts] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    owner = text[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.nonzero(new)[0]
    last = np.concatenate((first[1:], [len(starts)])) - 1
    lo, hi, a = starts[first], starts[last], anchor[first]
    half = lo + length // 2
    rank = names.of(a, a + (length - SPAN))
    r1, r2 = names.of(lo, half), names.of(half, hi + length) + (hi - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return owner[first], lo, hi, a, rank.view(np.int64), r1.view(np.int64), r2.view(np.int64)


def _pieces(ends: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from byte, to byte): whole texts up to PIECE bytes, or overlapping parts of a longer one."""
    i, begin = 0, 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, begin + PIECE, side="right")))
        if ends[j - 1] - begin <= PIECE:
            yield i, j, begin, int(ends[j - 1])
        else:
            a = begin
            while True:
                b = min(a + PIECE, int(ends[i]))
                yield i, i + 1, a, b
                if b == ends[i]:
                    break
                a = b - length + 1
        begin, i = int(ends[j - 1]), j


def _column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column laid end to end, and the end of each value."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _all_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = b.column("rid").to_numpy()
            data, ends = _column_bytes(b.column("t"))
            for i, j, x, y in _pieces(ends, length):
                owner, lo, hi, at, rank, r1, r2 = _runs(data[x:y], np.minimum(ends[i:j], y) - x, length)
                # offsets inside the piece become offsets inside the text
                shift = x - np.concatenate(([0], ends))[i:j][owner]
                yield pa.RecordBatch.from_arrays([pa.array(rid[i:j][owner]), pa.array(lo + shift), pa.array(hi + shift), pa.array(at + shift),
                                                  pa.array(rank), pa.array(r1), pa.array(r2)], names=["rid", "lo", "hi", "anchor", "rank", "r1", "r2"])
    return run


def _listed(batches: Iterator[pa.RecordBatch], length: int, fields: tuple) -> Iterator[tuple]:
    """(rid, names of a stretch of text, offset of the stretch, columns of its list), some thousand list entries at a time."""
    for b in batches:
        rid, lists = b.column("rid").to_numpy(), b.column("parts")
        data, ends = _column_bytes(b.column("t"))
        for k, (begin, end) in enumerate(zip(np.concatenate(([0], ends)), ends)):
            listed = lists[k].values
            cols = [listed.field(f).to_numpy() for f in fields]
            order = np.argsort(cols[0], kind="stable")
            for i in range(0, len(order), 2048):
                part = [c[order[i:i + 2048]] for c in cols]
                from_, to = max(0, int(part[0].min()) - SPAN), min(int(end - begin), int(part[1].max()) + length + SPAN)
                yield rid[k], _Names(data[begin + from_:begin + to]), from_, part


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry index and 0, 1, ... within each entry."""
    return np.repeat(np.arange(len(count)), count), np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)


def _blocks(length: int):
    """Blocks of the listed runs: what their windows share and what they cover, each as a rank pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rid, names, off, (lo, hi, anchor, n) in _listed(batches, length, ("lo", "hi", "anchor", "n")):
            low, high = (anchor - hi) // BLOCK, (anchor - lo) // BLOCK
            i, k = _spread(high - low + 1)
            k += low[i]
            top = anchor[i] - BLOCK * k                      # last start a whole block would have
            first, last = np.maximum(lo[i], top - BLOCK + 1), np.minimum(hi[i], top)
            end = top - BLOCK + 1 + length
            x, y, half = first - off, last - off + length, (top + end) // 2 - off
            mid = x + length // 2
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                np.full(len(i), rid), first, last, names.of(top - off, half).view(np.int64), names.of(half, end - off).view(np.int64),
                names.of(x, mid).view(np.int64), (names.of(mid, y) + (last - first).astype(np.uint64)).view(np.int64), n[i] > 1)],
                names=["rid", "lo", "hi", "s1", "s2", "r1", "r2", "settled"])
    return run


def _window_ranks(length: int):
    """The rank pair of every window start of the listed blocks."""
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rid, names, off, (lo, hi, open_) in _listed(batches, length, ("lo", "hi", "open")):
            i, step = _spread(hi - lo + 1)
            p = lo[i] + step
            q = p - off
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (
                np.full(len(p), rid), p, names.of(q, q + half).view(np.int64), names.of(q + half, q + length).view(np.int64), open_[i] > 0)],
                names=["rid", "p", "h1", "h2", "undecided"])
    return run


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        kept, spans = [], []
        for text, starts in zip((x.as_py() for x in b.column("t")), (x.as_py() for x in b.column("marks"))):
            # starts lo..hi repeat, so bytes lo..hi+length go; overlapping or touching ranges are one span
            got: list[list[int]] = []
            for lo, hi in sorted((m["lo"], m["hi"] + length) for m in starts) if starts is not None else ():
                if got and lo <= got[-1][1]:
                    got[-1][1] = max(got[-1][1], hi)
                else:
                    got.append([lo, hi])
            edges = [0, *(x for g in got for x in g), len(text)]
            kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2])))
            spans.append([{"start": a, "end": z} for a, z in got])
        yield extended(b, ("t", "marks"), spans=pa.array(spans, kind), kept=pa.array(kept, pa.binary()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, n_bytes, spans, kept) per row: maximal byte ranges covered by strings of ``length`` bytes that also start elsewhere, and the rest.

    Every row is a document of its own, repeated rows and rows without an id
    too. Null texts are empty. ``kept`` is binary, as a range may end inside a
    character. ``length`` must be an even number above 288.
    """
    if length % 2 or length < SPAN + GRAM:
        raise ValueError("length must be even and at least 288")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    base = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "texts")
    runs = stored(base.filter(F.octet_length("t") >= length).select("rid", "t")
                  .mapInArrow(_all_runs(length), "rid long, lo long, hi long, anchor long, rank long, r1 long, r2 long"), "runs")
    again = stored(runs.groupBy("rank").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "again")
    left = stored(counted_semi_join(runs, again, ["rank"], "c"), "runs")
    discard(runs, again)

    # the texts that still have a run go through the next steps; they are parted from the others once
    touched = left.select("rid").distinct().withColumn("hit", F.lit(True))
    parted = f"{shared_folder(spark)}/llm/parted-{uuid.uuid4().hex[:12]}"
    base.join(touched, "rid", "left").withColumn("hit", F.coalesce("hit", F.lit(False))).write.partitionBy("hit").parquet(parted)
    discard(base)
    texts = spark.read.schema(base.schema.add("hit", "boolean")).parquet(parted)
    hit_texts = texts.filter("hit").select("rid", "id", "t")

    classes = stored(left.groupBy("rank", "r1", "r2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "lo", "hi", "anchor")).alias("one")), "classes")
    settled = counted_semi_join(left, classes.filter("n > 1"), ["rank", "r1", "r2"], "n").select("rid", "lo", "hi")

    unsettled = classes.groupBy("rank").agg(F.min("n").alias("least")).filter("least = 1").select("rank")
    runs_of = (classes.join(unsettled, "rank", "left_semi").select("one.*", "n")
               .groupBy("rid").agg(F.collect_list(F.struct("lo", "hi", "anchor", "n")).alias("parts")))
    blocks = stored(hit_texts.select("rid", "t").join(runs_of, "rid")
                    .mapInArrow(_blocks(length), "rid long, lo long, hi long, s1 long, s2 long, r1 long, r2 long, settled boolean"), "blocks")
    shared = blocks.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("c"), F.min("settled").alias("done")).filter("c > 1 AND NOT done")
    shared = stored(shared.select("s1", "s2", "c"), "shared")
    left_blocks = stored(counted_semi_join(blocks, shared, ["s1", "s2"], "c"), "blocks")
    block_classes = stored(left_blocks.groupBy("s1", "s2", "r1", "r2").agg(F.count(F.lit(1)).alias("n"), F.max("settled").alias("done"), F.min(F.struct("rid", "lo", "hi")).alias("one")), "block-classes")
    alike = counted_semi_join(left_blocks.filter("NOT settled"), block_classes.filter("n > 1 OR done"), ["s1", "s2", "r1", "r2"], "n").select("rid", "lo", "hi")

    open_ = (F.col("n") == 1) & ~F.col("done")
    mixed = block_classes.groupBy("s1", "s2").agg(F.max(open_).alias("any"), F.count(F.lit(1)).alias("c")).filter("any AND c > 1").select("s1", "s2")
    spell = (block_classes.join(mixed, ["s1", "s2"], "left_semi").select("one.*", open_.cast("long").alias("open"))
             .groupBy("rid").agg(F.collect_list(F.struct("lo", "hi", "open")).alias("parts")))
    windows = stored(hit_texts.select("rid", "t").join(spell, "rid").mapInArrow(_window_ranks(length), "rid long, p long, h1 long, h2 long, undecided boolean"), "windows")
    twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h1", "h2")
    single = windows.filter("undecided").join(twice, ["h1", "h2"], "left_semi").select("rid", F.col("p").alias("lo"), F.col("p").alias("hi"))

    marks = stored(settled.union(alike).union(single).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("marks")), "marks")
    discard(left, classes, blocks, shared, left_blocks, block_classes, windows)
    kind = rows.schema["id"].dataType.simpleString()
    size = F.octet_length("t").cast("long").alias("n_bytes")
    spans = "array<struct<start:bigint,end:bigint>>"
    cut = (hit_texts.join(marks, "rid", "left").select("id", size, "t", "marks")
           .mapInArrow(lambda batches: _cut(batches, length), f"id {kind}, n_bytes long, spans {spans}, kept binary"))
    whole = texts.filter("NOT hit").select("id", size, F.array().cast(spans).alias("spans"), F.col("t").alias("kept"))
    return cut.union(whole)
