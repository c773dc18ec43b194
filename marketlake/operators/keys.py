"""Surrogate keys (L7), foreign-key resolution (L8) and the geo link.

Surrogate keys must be stable: a row keeps its key across reloads and new
rows get keys above the current maximum. ``monotonically_increasing_id``
depends on partitioning and ``row_number`` over a global order runs in one
task, so keys are numbered in the order (md5 prefix of the natural key,
natural key) in two passes: count rows per hash bucket (at most 16^d rows),
turn the counts into offsets (a window over that bounded table), then
number rows inside each bucket (one task per bucket, buckets are uniform
because md5 is) and add the bucket offset.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.parse import norm_key
from marketlake.operators.skew import salted_join

HEX_DIGITS = 3  # 4096 buckets


def key_bucket(keys: Sequence[str], digits: int = HEX_DIGITS) -> Column:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, digits)


def assign_sk(df: DataFrame, keys: Sequence[str], sk: str, digits: int = HEX_DIGITS,
              previous: DataFrame | None = None) -> DataFrame:
    """Fill NULL ``sk`` values (or a missing ``sk`` column) with new keys.

    Rows that already have a key keep it; new rows are numbered from
    ``max(sk) + 1`` in (md5 prefix, natural key) order. When the keyed rows
    all come from a stored ``previous`` snapshot, its maximum is read from
    there (a cheap scan) instead of from ``df``.
    """
    if sk not in df.columns:
        df = df.withColumn(sk, F.lit(None).cast("long"))
    cols = df.columns
    src = previous if previous is not None else df
    base = src.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("_base"))  # one row
    tagged = df.withColumn("_bucket", F.when(F.col(sk).isNull(), key_bucket(keys, digits)))
    counts = tagged.filter(F.col("_bucket").isNotNull()).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # <= 16^digits rows: the offset window and the broadcast are bounded
    offsets = counts.select(
        "_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_offset"))
    offsets = offsets.crossJoin(F.broadcast(base))
    w = Window.partitionBy("_bucket").orderBy(*[F.asc_nulls_last(k) for k in keys])
    new = (tagged.filter(F.col("_bucket").isNotNull())
           .join(F.broadcast(offsets), "_bucket")
           .withColumn(sk, F.col("_base") + F.col("_offset") + F.row_number().over(w)))
    old = tagged.filter(F.col("_bucket").isNull())
    return old.select(*cols).unionByName(new.select(*cols))


def keyed_incoming(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str], sk: str,
                   store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """L7 ahead of the upsert: ``incoming`` with the stored ``sk`` of its key, or a new one.

    ``store`` writes the deduplicated rows once; the numbering reads what it
    returns, so cleaning and dedup run once and the upsert's outer join is
    not part of the numbering.
    """
    if existing is None:
        known = incoming.withColumn(sk, F.lit(None).cast("long"))
    else:
        stored_keys = existing.select(*[F.col(k).alias(f"_{k}") for k in keys], sk)
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        known = incoming.join(stored_keys, same, "left").select(*incoming.columns, sk)
    return assign_sk(store(known), keys, sk, previous=existing)


def resolve_fk(fact: DataFrame, links: Mapping[str, tuple[DataFrame, str, str, str]], spread: bool = False) -> DataFrame:
    """Natural key -> surrogate key via LEFT JOINs.

    ``links``: output sk column -> (dimension, fact natural-key column,
    dimension natural-key column, dimension sk column). Unmatched keys give
    NULL (reported by K8 / K9). Dimension keys are unique, so the joins do
    not multiply rows; AQE broadcasts a dimension when it is small enough.
    ``spread`` salts the keys that many fact rows hold (``operators.skew``).
    """
    out = fact
    for sk, (dim, fact_col, dim_col, dim_sk) in links.items():
        if spread:
            out = salted_join(out, dim.select(F.col(dim_col).alias(fact_col), F.col(dim_sk).alias(sk)), [fact_col])
            continue
        d = dim.select(F.col(dim_col).alias(f"_{sk}_nk"), F.col(dim_sk).alias(sk))
        out = out.join(d, out[fact_col] == d[f"_{sk}_nk"], "left").drop(f"_{sk}_nk")
    return out


def link_geo(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """L10 + L11: add ``geo_sk`` to sellers by normalised zip.

    The lookup holds several rows per zip (one per rounded coordinate); the
    reference's UPDATE ... FROM then picks an arbitrary one. Here the
    smallest geo_sk per zip is used, which makes the link deterministic.
    """
    per_zip = geo.groupBy(norm_key(F.col("geo_zip")).alias("_zip")).agg(F.min("geo_sk").alias("geo_sk"))
    had = F.col("_had") if "geo_sk" in sellers.columns else F.lit(None).cast("long")
    base = sellers.withColumnRenamed("geo_sk", "_had")
    j = base.join(per_zip, norm_key(F.col("seller_zip")) == F.col("_zip"), "left")
    # a zip that no longer matches keeps its link, as an update from a join would
    return j.select(*[c for c in base.columns if c != "_had"], F.coalesce("geo_sk", had).alias("geo_sk"))
