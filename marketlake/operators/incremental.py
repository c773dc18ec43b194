"""Grouped sums that follow a table by its change feeds: deltas with retractions.

An update takes its image before out of the sums and puts its image after in,
so the work is that of the load, not of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def signed_rows(feed: DataFrame) -> DataFrame:
    """The rows that a feed (kind, before, after) takes out (``sign`` -1) and puts in (1).

    Each image is read by itself, so a reader of few columns reads no others.
    """
    changed = feed.filter("kind <> 'unchanged'")
    images = [changed.filter(F.col(side).isNotNull()).select(F.lit(sign).cast("long").alias("sign"), f"{side}.*") for side, sign in (("before", -1), ("after", 1))]
    return images[0].unionByName(images[1])


def delta(feed: DataFrame, groups: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """(``groups``, n, ``sums``): by how much a feed changes the rows and the sums of each group; unchanged groups are left out.

    ``sums`` names SQL expressions over the table's columns, of whole numbers
    or decimals (their sums are exact in any order); null counts as nothing.
    """
    parts = [F.coalesce(F.sum(F.expr(f"sign * ({e})")), F.lit(0)).alias(name) for name, e in sums.items()]
    changed = signed_rows(feed).groupBy(*groups).agg(F.sum("sign").alias("n"), *parts)
    return changed.filter(reduce(or_, [F.col(c) != 0 for c in ("n", *sums)]))


def delta_images(kinds: Mapping[str, DataType], groups: Sequence[str]) -> list[Column]:
    """(kind, before, after) of stored sums ``e_*`` (with ``_e``) joined with a ``delta``'s ``i_*`` (with ``_i``); ``kind`` is null where no change came."""
    known, came = F.col("_e").isNotNull(), F.col("_i").isNotNull()

    def after(c: str) -> Column:
        e, i = F.col(f"e_{c}"), F.col(f"i_{c}")
        return F.coalesce(e, i) if c in groups else (F.coalesce(e, F.lit(0)) + F.coalesce(i, F.lit(0))).cast(kinds[c])

    before = F.when(known & came, F.struct(*[F.col(f"e_{c}").alias(c) for c in kinds]))
    kind = F.when(came, F.when(known, "update").otherwise("insert"))
    return [kind.alias("kind"), before.alias("before"), F.struct(*[after(c).alias(c) for c in kinds]).alias("after")]


def delta_feed(state: DataFrame, change: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(kind, before, after) of the stored sums under a ``delta``; ``state`` needs the groups of ``change`` only.

    A group without rows left stays in the state with ``n`` 0, to be hidden
    by its readers: state tables know inserts and updates alone.
    """
    old = state.select(*[F.col(c).alias(f"e_{c}") for c in state.columns], F.lit(True).alias("_e"))
    new = change.select(*[F.col(c).alias(f"i_{c}") for c in change.columns], F.lit(True).alias("_i"))
    same = [F.col(f"e_{g}").eqNullSafe(F.col(f"i_{g}")) for g in groups]
    return new.join(old, reduce(and_, same), "left").select(*delta_images({f.name: f.dataType for f in state.schema}, groups))
