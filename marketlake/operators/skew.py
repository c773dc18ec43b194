"""Joins whose keys may be held by a large share of all rows (2.5, L8).

``salted_join`` finds heavy keys with a frequent-items sketch (one pass, bounded
memory, no shuffle of the keys), gives each as many salts as its share of the
rows asks for, copies the other side's rows of those keys once per salt, and
joins on key and salt: one join, in which every row meets all its partners. A
key that the sketch estimates wrongly costs time, never rows.

``counted_semi_join`` is for a side whose keys come with the number of rows
that hold them: the keys above a share are bounded in number by that share.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Salts per shuffle partition: small pieces, so that some falling together does not make a task heavy.
PIECES = 16
#: Rows that one task sorts and aggregates at most, where pieces are dealt by the number of rows.
ROWS_PER_PIECE = 500_000


def even_pieces(rows: DataFrame, per: int = ROWS_PER_PIECE) -> int:
    """Pieces for ``repartition``: the session's shuffle partitions, or more where each would hold over ``per`` of ``rows``.

    Spark merges the pieces of a plain shuffle by their compressed size; a
    number given to ``repartition`` stands, so a task's memory is that of
    ``per`` rows at any size of the input. Counts ``rows``: give a stored table.
    """
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / per))


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = 1000) -> DataFrame:
    """(hot, part): hashes of the keys held by about one row in ``share`` or more, and their part of all rows; at most ``share`` rows."""
    tracked = 10 * share
    found = df.agg(F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {share}, {tracked})").alias("top"), F.count(F.lit(1)).alias("rows"))
    top = found.select("rows", F.explode("top").alias("t")).select(F.col("t.item").alias("hot"), (F.col("t.count") / F.col("rows")).alias("part"))
    return top.filter(F.col("part") * share >= 1)


def salted_join(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left", share: int = 1000, pieces: int | None = None) -> DataFrame:
    """``rows.join(other, keys, how)`` for inner, left, left_semi and left_anti joins, with heavy keys of ``rows`` spread.

    Salts come from a hash of the whole row, so a task that runs again deals
    its rows the same way; equal rows stay together. ``other``'s rows are
    copied at most ``pieces`` times in all per row of a heavy key, in
    proportion to the key's share. Null keys match nothing, and are spread too.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    pieces = pieces or PIECES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(rows, keys, share))  # at most ``share`` rows
    salts = F.coalesce(F.ceil(F.col("part") * pieces), F.lit(1))
    key = F.xxhash64(*keys)
    dealt = (rows.join(heavy, key == F.col("hot"), "left")
             .select(*rows.columns, F.pmod(F.xxhash64(*rows.columns, F.lit("salt")), salts).alias("_salt")))
    copied = (other.join(heavy, key == F.col("hot"), "left")
              .select(*other.columns, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt")))
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def counted_semi_join(rows: DataFrame, counts: DataFrame, keys: Sequence[str], n: str, share: int = 1000) -> DataFrame:
    """The rows of ``rows`` with a key in ``counts``, whose column ``n`` is the number of rows that hold it.

    Fewer than ``share`` keys can each hold more than one in ``share`` of the
    counted rows: they are broadcast, and only the others' rows are shuffled.
    ``counts`` should be a stored table, as it is read twice.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    heavy = F.broadcast(counts.filter(F.col(n) > math.ceil(total / share)).select(*keys))
    cold = rows.join(heavy, list(keys), "left_anti").join(counts.select(*keys), list(keys), "left_semi")
    return rows.join(heavy, list(keys), "left_semi").unionByName(cold)
