"""SCD-1 upsert without MERGE.

``INSERT ... ON CONFLICT (key) DO UPDATE SET ... WHERE <changed>`` becomes a
full outer join of the stored snapshot with the incoming rows on the key,
and one expression per column choosing the stored value, the incoming one
or a merge of both. The result is the next snapshot; writing it to a new
version folder (``sources.catalog.save_snapshot``) replaces the table
atomically, so the operator is idempotent: ``upsert(upsert(e, i), i)``
equals ``upsert(e, i)``.

The join key is unique on both sides (incoming rows are deduplicated first),
so the join cannot skew on a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = ("first_seen_at", "last_seen_at", "row_source_file", "staging_id")
STORED, INSERT, UPDATE, UNCHANGED = range(4)


def _matched(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"e_{k}").eqNullSafe(F.col(f"i_{k}")) for k in keys])


def _sides(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    e = existing.select(*[F.col(c).alias(f"e_{c}") for c in existing.columns], F.lit(True).alias("_e"))
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in incoming.columns], F.lit(True).alias("_i"))
    return e, i


def _rules(columns: Sequence[str], incoming: Sequence[str], keys: Sequence[str], policy: Mapping[str, str], compare: Sequence[str],
           touch_first_seen: bool) -> tuple[Column, list[Column]]:
    """What a joined row is (``INSERT``, ``UPDATE``, ``UNCHANGED``, or ``STORED`` where nothing came), and the next value of every column.

    Every value asks for it first, so that a task works it out once per row
    and not once per column.
    """
    in_e, in_i = F.col("_e").isNotNull(), F.col("_i").isNotNull()
    differs = reduce(or_, [~F.col(f"e_{c}").eqNullSafe(F.col(f"i_{c}")) for c in compare], F.lit(False))
    state = F.when(~in_i, STORED).when(~in_e, INSERT).when(differs, UPDATE).otherwise(UNCHANGED)

    def pick(col: str) -> Column:
        ev = F.col(f"e_{col}")
        if col not in incoming:
            return F.when(state == INSERT, F.lit(None)).otherwise(ev)
        iv = F.col(f"i_{col}")
        if col in keys:
            return F.when(in_e, ev).otherwise(iv)
        if col == "first_seen_at":
            merged = F.least(ev, iv) if touch_first_seen else ev
        elif col == "last_seen_at":
            merged = F.greatest(ev, iv)
        elif col in ("row_source_file", "staging_id"):
            merged = iv
        else:
            rule = policy.get(col, "keep")
            merged = {"coalesce": F.coalesce(iv, ev), "overwrite": iv, "keep": ev}[rule]
        return F.when(state == INSERT, iv).when(state == UPDATE, merged).otherwise(ev)

    return state, [pick(c).alias(c) for c in columns]


def scd1_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                policy: Mapping[str, str], compare: Sequence[str],
                touch_first_seen: bool = True) -> DataFrame:
    """Merge ``incoming`` into ``existing`` (same columns; extra existing-only
    columns such as the surrogate key are kept, and NULL for new keys).

    ``policy`` per non-key column: ``coalesce`` (incoming unless NULL),
    ``overwrite`` (incoming even if NULL), ``keep`` (stored value). Audit
    columns follow L6: first_seen = LEAST, last_seen = GREATEST, source file
    and staging id overwritten. A matched row is updated only when some
    ``compare`` column IS DISTINCT FROM the incoming value; otherwise it is
    kept as stored (including its old last_seen_at).
    """
    e, i = _sides(existing, incoming)
    _, after = _rules(existing.columns, incoming.columns, keys, policy, compare, touch_first_seen)
    return e.join(i, _matched(keys), "full_outer").select(*after)


def images(columns: Sequence[str], incoming: Sequence[str], keys: Sequence[str], policy: Mapping[str, str], compare: Sequence[str],
           touch_first_seen: bool = True) -> list[Column]:
    """(kind, before, after) of rows joined as ``e_*`` (with ``_e``) and ``i_*`` (with ``_i``).

    ``kind`` is null for stored rows that nothing came for; their ``after`` is the stored row.
    """
    state, after = _rules(columns, incoming, keys, policy, compare, touch_first_seen)
    before = F.when(F.col("_e").isNotNull(), F.struct(*[F.col(f"e_{c}").alias(c) for c in columns]))
    kind = F.when(state == INSERT, "insert").when(state == UPDATE, "update").when(state == UNCHANGED, "unchanged")
    return [kind.alias("kind"), F.when(F.col("_i").isNotNull(), before).alias("before"), F.struct(*after).alias("after")]


def change_feed(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], policy: Mapping[str, str], compare: Sequence[str],
                touch_first_seen: bool = True) -> DataFrame:
    """What ``scd1_upsert`` does to each incoming row: (kind, before, after).

    ``kind`` is ``insert``, ``update`` or ``unchanged``; ``before`` is the
    stored row (NULL for inserts), ``after`` the next one. One row per
    incoming row, so the feed is as large as the load, not as the table.
    """
    e, i = _sides(existing, incoming)
    return i.join(e, _matched(keys), "left").select(*images(existing.columns, incoming.columns, keys, policy, compare, touch_first_seen))


def apply_changes(existing: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next version: stored rows that the feed does not change, and the feed's inserts and updates."""
    new = feed.filter("kind <> 'unchanged'").select("after.*")
    gone = new.select(*[F.col(k).alias(f"i_{k}") for k in keys])
    e = existing.select(*[F.col(c).alias(f"e_{c}") for c in existing.columns])
    kept = e.join(gone, _matched(keys), "left_anti").select(*[F.col(f"e_{c}").alias(c) for c in existing.columns])
    return kept.unionByName(new)
