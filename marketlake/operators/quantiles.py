"""Exact quantiles (PERCENTILE_CONT), global or per group, without a task that sees a whole group.

Spark's ``percentile`` is exact, but its final step merges the value->count
maps of a group in one task, so memory grows with the group's distinct
values. Here no task holds more than one range of (group, value):

1. value counts per (group, value): a value held by a third of the rows is
   one row after the map-side combine;
2. the counts are dealt out by ranges of (group, value) and stored with the
   number of their range (``ranged``). Ranges follow the distribution, so
   neither an outlier nor a group with most values makes a range heavy;
3. counts per (group, range) give each range's offset within its group: a
   window over at most one row per range;
4. only the ranges that hold a wanted position are read again; a running
   count inside each finds the values at ``floor(p*(n-1))`` and
   ``ceil(p*(n-1))``;
5. linear interpolation between them, as PERCENTILE_CONT does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.sources.catalog import materialize


def ranged(counts: DataFrame, by: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """``counts`` stored in ranges of (group, value), numbered by ``_range``.

    Stored (below the shared folder, when called) because the later steps read
    it twice and must see the same ranges, also after a lost executor.
    """
    n = ranges or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(counts.repartitionByRange(n, *by, value).withColumn("_range", F.spark_partition_id()), "value_counts")


def _join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi-join on ``cols``, which the result has once."""
    named = right.withColumnsRenamed({c: f"_same_{c}" for c in cols})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in cols])
    return left.join(named, same, how).drop(*[f"_same_{c}" for c in cols])


def quantiles_from_ranged(t: DataFrame, value: str, count: str, by: Sequence[str], probs: Sequence[float],
                          names: Sequence[str] | None = None, carry: dict | None = None) -> DataFrame:
    """Grouped PERCENTILE_CONT from a frame made by ``ranged`` with the same ``by`` and ``value``.

    Rows with a NULL value only contribute to ``carry``; values may repeat.
    ``carry`` maps an output name to a column of ``t`` whose per-group SUM is
    returned as well.
    """
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    carry = dict(carry or {})
    c = F.when(F.col(value).isNotNull(), F.col(count)).otherwise(F.lit(0))
    per = t.groupBy(*by, "_range").agg(F.sum(c).alias("_rc"), *[F.sum(col).alias(k) for k, col in carry.items()])
    totals = per.groupBy(*by).agg(F.sum("_rc").alias("_n"), *[F.sum(k).alias(k) for k in carry])

    group = Window.partitionBy(*by)
    offsets = per.select(*by, "_range", "_rc", (F.sum("_rc").over(group.orderBy("_range")) - F.col("_rc")).alias("_off"),
                         F.sum("_rc").over(group).alias("_n"))
    ends = [end for p in probs for end in (F.floor((F.col("_n") - 1) * F.lit(float(p))), F.ceil((F.col("_n") - 1) * F.lit(float(p))))]

    def among(first: Column, last: Column) -> Column:
        return reduce(lambda a, b: a | b, [e.between(first, last) for e in ends])

    wanted = offsets.filter(among(F.col("_off"), F.col("_off") + F.col("_rc") - 1))
    held = t.filter(F.col(value).isNotNull()).select(*by, "_range", F.col(value).cast("double").alias("_v"), F.col(count).alias("_c"))
    inside = _join(held, wanted.drop("_rc"), [*by, "_range"], "inner")
    run = F.sum("_c").over(Window.partitionBy(*by, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = inside.select(*by, "_v", "_n", (F.col("_off") + run - F.col("_c")).alias("_first"), (F.col("_off") + run - 1).alias("_last"))
    # at most two rows per probability and group survive the filter
    found = ranked.filter(among(F.col("_first"), F.col("_last"))).groupBy(*by).agg(
        *[F.max(F.when(e.between(F.col("_first"), F.col("_last")), F.col("_v"))).alias(f"_end{i}") for i, e in enumerate(ends)])

    res = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi, lo_v, hi_v = F.floor(pos), F.ceil(pos), F.col(f"_end{2 * i}"), F.col(f"_end{2 * i + 1}")
        res.append(F.when(lo == hi, lo_v).otherwise((hi - pos) * lo_v + (pos - lo) * hi_v).alias(name))
    # groups without values keep their totals
    return _join(totals, found, by, "left").select(*by, *res, *carry)


def quantiles_from_counts(counts: DataFrame, value: str, count: str, by: Sequence[str], probs: Sequence[float],
                          names: Sequence[str] | None = None, carry: dict | None = None) -> DataFrame:
    """Grouped PERCENTILE_CONT from a (group..., value, count) frame; see ``quantiles_from_ranged``."""
    return quantiles_from_ranged(ranged(counts, by, value), value, count, by, probs, names, carry)


def grouped_quantiles(df: DataFrame, col: str, by: Sequence[str], probs: Sequence[float],
                      names: Sequence[str] | None = None) -> DataFrame:
    """Exact ``PERCENTILE_CONT(p)`` of ``col`` per group, one row per group that has values."""
    vc = (df.select(*by, F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
          .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")))
    return quantiles_from_counts(vc, "_v", "_c", by, probs, names)


def total_quantiles(t: DataFrame, value: str, count: str, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One row with the ``PERCENTILE_CONT(p)`` over all of a frame made by ``ranged`` without groups."""
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    g = quantiles_from_ranged(t.withColumn("_all", F.lit(0)), value, count, ["_all"], probs, names)
    return g.agg(*[F.max(n).alias(n) for n in names])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], ranges: int | None = None,
                    names: Sequence[str] | None = None) -> DataFrame:
    """One row with the exact ``PERCENTILE_CONT(p)`` of ``col`` for each p (NULLs ignored, all NULL without values)."""
    vc = df.select(F.col(col).alias("_v")).groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    return total_quantiles(ranged(vc, [], "_v", ranges), "_v", "_c", probs, names)
