"""Maintained views: grouped sums stored as bucketed versions, brought up to date by change feeds."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from marketlake.operators.incremental import delta, delta_images
from marketlake.sources.catalog import materialize
from marketlake.sources.snapshots import Snapshot, create


@dataclass(frozen=True)
class GroupedView:
    """``groups``, the number of rows ``n`` and ``sums`` of a table, as of one of its versions."""

    groups: tuple[str, ...]
    sums: Mapping[str, str]
    state: Snapshot

    @classmethod
    def start(cls, first: DataFrame, root: str, groups: tuple[str, ...], sums: Mapping[str, str], buckets: int | None = None) -> GroupedView:
        """The view of a table's first version, from that version's feed; in the table's number of ``buckets`` it need not be counted first."""
        return cls(groups, sums, create(delta(first, groups, sums), root, groups, buckets))

    def follow(self, feed: DataFrame) -> GroupedView:
        """The view after one more version of the table: only buckets with changed groups are read and written."""
        change = materialize(delta(feed, self.groups, self.sums), "views/delta")
        return replace(self, state=self.state.merge(change, delta_images({f.name: f.dataType for f in self.state.schema}, self.groups)))

    def rows(self) -> DataFrame:
        return self.state.rows().filter("n <> 0")
