"""Sharding by histogram sort: near-equal bytes, one exchange of the rows.

Rows are ordered by three numbers of 60 bits (``LEVELS``): ``key``, from the
MD5 of the id, so a shard is a random part of the corpus; ``tie``, from text
CRC and size, for rows that share an id; and ``row``, a random number of the
stored row, for rows equal in all of that, which may change places freely.
Splitters are found without moving rows: each round counts the exact bytes
below the boundaries of ``1 << DIGIT`` probes inside every range that still
holds a wanted splitter (at most ``shards - 1`` ranges, so a round's histogram
has a fixed bound), and goes on with the probe interval that straddles it.
With ``tolerance`` 0 this goes down to single rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketlake.llm.common import id_text, stored

KEY_BITS, DIGIT = 60, 12
LEVELS = ("key", "tie", "row")


def random_key(id_col: Column) -> Column:
    return F.conv(F.substring(F.md5(id_text(id_col).cast("binary")), 1, 15), 16, 10).cast("long")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 8; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.0) -> list[tuple[int, ...]]:
    """First place, by ``LEVELS``, of shards 1 .. shards-1, from rows of these columns and ``size``.

    A row belongs to the shard in which the middle of its bytes lies when all
    bytes are laid out in order and cut into equal parts. A probe interval
    smaller than ``tolerance`` times a shard is not refined further.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    found = _search(rows, LEVELS, 0, list(range(1, shards)), total, shards, tolerance)
    return [found[j] for j in range(1, shards)]


def _search(rows: DataFrame, levels: tuple, start: int, splits: list[int], total: int, shards: int, tolerance: float) -> dict[int, tuple]:
    """The places of some splitters within ``rows``, which ``start`` bytes lie below, by ``levels``."""
    level, rest = levels[0], levels[1:]
    found: dict[int, tuple] = {}
    active: dict[int, tuple[int, list[int]]] = {0: (start, splits)}  # range -> bytes below it, splitters in it

    def place(value: int) -> tuple:
        return value, *[0] * len(rest)

    for bits in range(DIGIT, KEY_BITS + 1, DIGIT):
        if not active:
            break
        shift, last = KEY_BITS - bits, bits == KEY_BITS
        inside = rows.filter(F.shiftright(level, shift + DIGIT).isin(list(active))) if bits > DIGIT else rows
        counts = inside.groupBy(F.shiftright(level, shift).alias("at")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("c")).collect()
        probes: dict[int, list] = {p: [] for p in active}
        for at, n, c in sorted(counts):
            probes[at >> DIGIT].append((at, n, c))
        deeper: dict[int, tuple[int, list[int]]] = {}
        for p, (below, wanted) in active.items():
            wanted = list(wanted)
            for at, n, c in probes[p]:
                while wanted and shards * below >= total * wanted[0]:
                    found[wanted.pop(0)] = place(at << shift)
                straddled = [j for j in wanted if total * j < shards * (below + n)]
                wanted = wanted[len(straddled):]
                if straddled and last and c > 1 and rest and shards * n > tolerance * total:
                    # rows that share a key: the next level decides among them
                    within = _search(rows.filter(F.col(level) == at), rest, below, straddled, total, shards, tolerance)
                    found.update({j: (at, *x) for j, x in within.items()})
                elif last or shards * n <= tolerance * total:
                    # one row left, or near enough: its middle decides
                    for j in straddled:
                        found[j] = place((at if shards * (2 * below + n) >= 2 * total * j else at + 1) << shift)
                elif straddled:
                    deeper[at] = (below, straddled)
                below += n
            for j in wanted:
                found[j] = place((p + 1) << (shift + DIGIT))
        active = deeper
    return found


def _not_before(place: tuple) -> Column:
    """Rows at or after a place."""
    level, value = LEVELS[-len(place)], place[0]
    if not any(place[1:]):
        return F.col(level) >= value
    return (F.col(level) > value) | ((F.col(level) == value) & _not_before(place[1:]))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", keep: tuple = (), tolerance: float = 0.0) -> DataFrame:
    """``keep`` columns, id, size, text_crc32, law, shard, slot, grown_shard per row, under the law ``bytes``.

    Slots run from 0 without gaps inside a shard, in the order of ``LEVELS``.
    Null texts have size 8 and the CRC-32 of nothing (0). Rows without an id,
    or with a repeated one, share a key; where a splitter falls among them
    they are parted by text CRC and size, and equal rows by count, so the
    sizes are near equal whatever the ids. An empty table gives no rows.
    """
    text = F.col(text_col)
    rows = docs.select(*keep, F.col(id_col).alias("id"), byte_size(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), random_key(F.col(id_col)).alias("key"),
                       F.monotonically_increasing_id().alias("row"))
    tie = F.shiftleft("text_crc32", 28).bitwiseOR(F.col("size").bitwiseAND((1 << 28) - 1))
    # stored, so that every round and the exchange see the same number of a row
    rows = stored(rows.withColumn("tie", tie).withColumn("row", random_key(F.col("row"))), "shard-keys")
    first = splitters(rows.select(*LEVELS, "size"), shards, tolerance)
    number = sum((_not_before(place).cast("int") for place in first), F.lit(0))
    order = ("shard", *LEVELS)
    # ranges of the whole order: no key, however frequent, makes one task heavy
    dealt = rows.withColumn("shard", number).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.select(*keep, "id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at")), "shards")
    part = F.shiftright("at", 33)
    pieces = dealt.groupBy("shard", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(pieces.select("shard", "part", "first", before.alias("before")), "offsets")  # at most a row per shard and partition
    found = dealt.withColumn("part", part).join(F.broadcast(offsets), ["shard", "part"])
    slot = F.col("at") - F.col("first") + F.col("before")
    return found.select(*keep, "id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
