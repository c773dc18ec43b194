"""Dedup operators: keep-latest per key (L1, L3) and grain collapse (L2).

Both are aggregations, not windows: ``groupBy`` gets a map-side partial
aggregate, so a key holding a third of the rows is reduced to one row per
input partition before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.skew import heavy_keys


def collapse(df: DataFrame, keys: Sequence[str | Column],
             max_cols: Mapping[str, str] | Sequence[str] = (),
             min_cols: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """L2: ``GROUP BY keys`` with a column-wise MAX / MIN of the rest.

    The result can mix columns of different source rows, as in the reference.
    ``max_cols`` / ``min_cols`` map source column -> output name (a plain
    sequence keeps the names).
    """
    def as_map(cols):
        return dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}

    aggs = [F.max(c).alias(a) for c, a in as_map(max_cols).items()]
    aggs += [F.min(c).alias(a) for c, a in as_map(min_cols).items()]
    return df.groupBy(*keys).agg(*aggs)


def collapse_dealt(rows: DataFrame, keys: Sequence[str], by: Sequence[str], pieces: int, min_cols: Sequence[str]) -> DataFrame:
    """``collapse`` of every other column by MAX, in one shuffle of ``rows`` into ``pieces`` by some of the ``keys``.

    What comes out still lies by ``by``: joins on it and buckets made of it
    need no other shuffle. Keys that many rows hold (at most 1,000) are reduced
    before it, as ``collapse`` does.
    """
    def reduced(df: DataFrame) -> DataFrame:
        return collapse(df, keys, [c for c in df.columns if c not in (*keys, *min_cols)], min_cols).select(*rows.columns)

    hot = [r["hot"] for r in heavy_keys(rows.select(*keys), keys).collect()]
    if hot:
        held = F.xxhash64(*keys).isin(hot)
        rows = rows.filter(~held).unionByName(reduced(rows.filter(held)))
    return reduced(rows.repartition(pieces, *by))


def latest_per_key(df: DataFrame, keys: Sequence[str | Column],
                   order_cols: Sequence[str] = ("loaded_at", "staging_id"),
                   key_names: Sequence[str] | None = None) -> DataFrame:
    """L1 / L3: the row ranked first by ``order_cols`` DESC within each key.

    Matches ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY c1 DESC, c2 DESC) = 1``
    including PostgreSQL's NULLS FIRST for DESC (a NULL sort value wins).
    Exact ties on all sort columns are broken by the remaining columns, so
    the result is deterministic. ``keys`` may be expressions (L3's
    ``COALESCE(review_id, ...)``); ``key_names`` names them in the output
    (expression keys are dropped unless named).
    """
    key_cols, names = [], []
    for i, k in enumerate(keys):
        if isinstance(k, str):
            key_cols.append(F.col(k))
            names.append(k)
        else:
            key_cols.append(k)
            names.append(key_names[i] if key_names else f"_key{i}")
    payload = [c for c in df.columns if c not in names]
    best = F.max(_ranked(payload, order_cols)).alias("_best")
    out = df.groupBy(*[c.alias(n) for c, n in zip(key_cols, names)]).agg(best)
    visible = [n for n in names if not n.startswith("_key")]
    return out.select(*visible, *_unranked(payload, order_cols))


def _ranked(payload: Sequence[str], order_cols: Sequence[str]) -> Column:
    """The columns as a struct that is largest for the latest row; a column that rows are ranked by lies in it once."""
    rank = []
    for i, c in enumerate(order_cols):
        rank += [F.col(c).isNull().alias(f"_null{i}"), F.col(c).alias(f"_sort{i}")]
    return F.struct(*rank, *[F.col(c) for c in payload if c not in order_cols])


def _unranked(payload: Sequence[str], order_cols: Sequence[str]) -> list[Column]:
    """The columns of a ``_ranked`` struct ``_best``."""
    fields = {c: f"_sort{i}" for i, c in enumerate(order_cols)}
    return [F.col("_best").getField(fields.get(c, c)).alias(c) for c in payload]


def latest_dealt(rows: DataFrame, keys: Sequence[str], numbers: DataFrame, sk: str, pieces: int,
                 order_cols: Sequence[str] = ("loaded_at", "staging_id")) -> DataFrame:
    """``latest_per_key`` with the ``sk`` that ``numbers`` (``keys``, ``sk``) has for each key.

    Rows and numbers meet in one shuffle into ``pieces`` by the keys
    (``collapse_dealt``), so buckets made of the keys need no other.
    """
    payload = [c for c in rows.columns if c not in keys]
    given = rows.select(*keys, _ranked(payload, order_cols).alias("_best"), F.lit(None).cast("long").alias(sk))
    numbered = numbers.select(*keys, F.lit(None).cast(given.schema["_best"].dataType).alias("_best"), sk)
    return collapse_dealt(given.unionByName(numbered), keys, keys, pieces, []).select(*keys, *_unranked(payload, order_cols), sk)
