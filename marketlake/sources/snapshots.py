"""Table versions in hash buckets: a load rewrites only the buckets it changes.

A table is a folder of version folders. Rows lie in buckets by the hash of
their key; a version's folder holds the buckets that this version rewrote,
its manifest names for every bucket the version that holds its rows, and its
feed holds what the load did to each incoming row, with the image before.
Stored and incoming rows meet in one shuffle by bucket and are written once:
a rewritten bucket's rows bear what the load did to them beside their columns
(``_kind``, ``_before``); incoming rows that left their bucket as it was lie
in a folder of their own. The first version's feed is its rows.
Nothing that a reader may use is ever overwritten: data and feed first, then
the manifest, which makes the version. A load that is retried after a failure
writes its own version again.

The manifest has a row per bucket (``buckets`` is fixed when the table is
made), so it is read by the driver; keys are unique, so buckets are even.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.upsert import apply_changes, images
from marketlake.session import compiled
from marketlake.sources.catalog import STORED_AS, save_snapshot

ROWS_PER_BUCKET, LEAST, MOST = 250_000, 8, 4096


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: ``held`` maps each bucket with rows to the version that wrote it.

    ``same`` names the buckets that the load brought rows for and did not
    change; None where the feed lies in a folder of its own. ``by`` are the
    columns of the key that the buckets go by, all of them if none are named.
    """

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int
    version: int
    held: Mapping[int, int]
    same: tuple[int, ...] | None = None
    by: tuple[str, ...] = ()

    def bucket(self, prefix: str = "") -> Column:
        """By the hash that ``repartition(buckets, *by)`` deals rows by: a piece of it is a bucket."""
        return F.pmod(F.hash(*[F.col(f"{prefix}{k}") for k in self.by or self.keys]), F.lit(self.buckets))

    def rows(self, only: Iterable[int] | None = None) -> DataFrame:
        """The table, or its rows in some buckets: other buckets' files are not listed."""
        wanted = self.held if only is None else {b: self.held[b] for b in only if b in self.held}
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/version={v}/bucket={b}" for b, v in sorted(wanted.items())])

    def feed(self) -> DataFrame:
        """(kind, before, after) per row of the load that made this version; all rows are inserts in the first."""
        if self.version == 1:
            return self.rows().select(F.lit("insert").alias("kind"), F.lit(None).cast(self.schema).alias("before"), F.struct(*self.schema.names).alias("after"))
        kinds = T.StructType().add("kind", T.StringType()).add("before", self.schema).add("after", self.schema)
        if self.same is None:
            return self.spark.read.schema(kinds).parquet(f"{self.root}/feed/version={self.version}")
        paths = [f"{self.root}/data/version={self.version}/bucket={b}" for b, v in sorted(self.held.items()) if v == self.version]
        paths += [f"{self.root}/data/version={self.version}{SAME}/bucket={b}" for b in sorted(self.same)]
        if not paths:
            return self.spark.createDataFrame([], kinds)
        stored = T.StructType([*self.schema.fields, T.StructField("_kind", T.StringType()), T.StructField("_before", self.schema)])
        feed = self.spark.read.schema(stored).parquet(*paths).filter("_kind IS NOT NULL")
        return feed.select(F.col("_kind").alias("kind"), F.col("_before").alias("before"), F.struct(*self.schema.names).alias("after"))

    def upsert(self, incoming: DataFrame, policy: Mapping[str, str], compare: Sequence[str], touch_first_seen: bool = True,
               arrived: DataFrame | None = None) -> Snapshot:
        """The next version (``operators.upsert.scd1_upsert``). Only buckets that the incoming rows fall into are read."""
        return self.merge(incoming, images(self.schema.names, incoming.columns, self.keys, policy, compare, touch_first_seen), arrived)

    def merge(self, incoming: DataFrame, result: Sequence[Column], arrived: DataFrame | None = None) -> Snapshot:
        """The next version by ``result`` (kind, before, after) of the stored rows ``e_*`` joined with the incoming ``i_*``.

        Rows of a bucket that the load changes are written whole, of the others those that the load brought.
        ``incoming`` is read twice, once for its keys alone, unless ``arrived`` has these, in any number.
        """
        landed = incoming if arrived is None else arrived
        touched = [r[0] for r in landed.select(self.bucket()).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return replace(self, version=self.version + 1, same=())._published([])
        version = str(self.version + 1)
        for once in (True, False):
            seen, met = Observation(), _meet(self.rows(touched), incoming, self.keys, self.bucket(), 4 * len(touched), once)
            done = _changes(met.select("bucket", "_repeats", *result))
            done = done.observe(seen, F.collect_set(F.when(F.col("_changed"), F.col("bucket"))).alias("changed"), F.max("_repeats").alias("repeats"))
            rows = done.filter("_changed OR kind IS NOT NULL").select(
                "after.*", F.col("kind").alias("_kind"), F.col("before").alias("_before"),
                F.when(F.col("_changed"), version).otherwise(version + SAME).alias("version"), "bucket")
            with compiled(self.spark):
                rows.write.mode("overwrite").options(compression=STORED_AS, partitionOverwriteMode="dynamic").partitionBy("version", "bucket").parquet(f"{self.root}/data")
            if not seen.get["repeats"]:
                break  # else not every row met its partners: written again, each with each
        changed = set(seen.get["changed"])
        return replace(self, version=self.version + 1, same=tuple(b for b in touched if b not in changed))._published(changed)

    def apply(self, feed: DataFrame) -> Snapshot:
        """The next version by a feed: stored with it; buckets with inserts or updates are written anew."""
        nxt = replace(self, version=self.version + 1, same=None)
        _store(feed.select("kind", "before", "after", self.bucket("after.").alias("bucket")), f"{self.root}/feed/version={nxt.version}")
        done = nxt.feed()
        changed = [r[0] for r in done.filter(DIFFERS).select(self.bucket("after.")).distinct().collect()]
        if changed:
            _write(nxt, apply_changes(self.rows(changed), done, self.keys))
        return nxt._published(changed)

    def _published(self, changed: Iterable[int]) -> Snapshot:
        made = replace(self, held=dict(self.held) | dict.fromkeys(changed, self.version))
        _publish(made)
        return made


#: An update may end in the row it began with.
DIFFERS = "kind <> 'unchanged' AND NOT before <=> after"

#: Ends the name of the folder of incoming rows that left their bucket as it was.
SAME = "-same"


def _meet(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], bucket: Column, tasks: int | None = None, once: bool = False) -> DataFrame:
    """(bucket, e_*, _e, i_*, _i, _repeats): the full outer join of both on their keys (null matches null), in one shuffle by bucket.

    ``tasks`` is their number, so that a task of a larger table does not hold
    more buckets. ``once`` takes keys for unique on either side, which is
    cheaper: rows that bear ``_repeats`` then lack partners.
    """
    sides = {"e": stored, "i": incoming}

    def rows(side: str) -> DataFrame:
        filled = [(F.struct(*df.columns) if s == side else F.lit(None).cast(df.schema)).alias(s) for s, df in sides.items()]
        return sides[side].select(bucket.alias("bucket"), *filled)

    by = [F.coalesce(f"e.{k}", f"i.{k}").alias(f"_key{n}") for n, k in enumerate(keys)]
    dealt = [tasks, "bucket"] if tasks else ["bucket"]
    groups = rows("e").union(rows("i")).repartition(*dealt).groupBy("bucket", *by)
    if once:
        repeats = (F.count("e") > 1) | (F.count("i") > 1)
        pairs = groups.agg(F.first("e", ignorenulls=True).alias("e"), F.first("i", ignorenulls=True).alias("i"), repeats.alias("_repeats"))
    else:
        lists = groups.agg(F.collect_list("e").alias("e"), F.collect_list("i").alias("i"))
        pairs = lists.select("bucket", F.explode_outer("e").alias("e"), "i").select("bucket", "e", F.explode_outer("i").alias("i"), F.lit(False).alias("_repeats"))
    named = [F.col(f"{s}.{c}").alias(f"{s}_{c}") for s, df in sides.items() for c in df.columns]
    return pairs.select("bucket", *named, *[F.when(F.col(s).isNotNull(), True).alias(f"_{s}") for s in sides], "_repeats")


def _changes(done: DataFrame) -> DataFrame:
    """``done`` (bucket, kind, before, after) with ``_changed``: whether any row of its bucket is; rows of a bucket lie in one task."""
    differs = F.coalesce(F.expr(DIFFERS), F.lit(False))
    return done.withColumn("_changed", F.max(differs).over(Window.partitionBy("bucket")))


def _store(rows: DataFrame, path: str) -> None:
    with compiled(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", STORED_AS).partitionBy("bucket").parquet(path)


def _write(snapshot: Snapshot, rows: DataFrame, dealt: bool = False) -> None:
    named = rows.select(*snapshot.schema.fieldNames()).withColumn("bucket", snapshot.bucket())
    _store(named if dealt else named.repartition("bucket"), f"{snapshot.root}/data/version={snapshot.version}")


def buckets_for(rows: int) -> int:
    return min(MOST, max(LEAST, rows // ROWS_PER_BUCKET))


def _publish(snapshot: Snapshot) -> None:
    rows = [(b, v) for b, v in snapshot.held.items()]
    head = [F.lit(snapshot.buckets).alias("buckets"), F.lit("\n".join(snapshot.keys)).alias("keys"), F.lit(snapshot.schema.json()).alias("schema"),
            F.lit(None if snapshot.same is None else json.dumps(snapshot.same)).cast("string").alias("same"), F.lit(json.dumps(snapshot.by)).alias("by")]
    table = snapshot.spark.createDataFrame([*rows, (None, None)], "bucket int, version int").select("*", *head)
    table.coalesce(1).write.mode("overwrite").parquet(f"{snapshot.root}/manifest/version={snapshot.version}")


def create(df: DataFrame, root: str, keys: Sequence[str], buckets: int | None = None, by: Sequence[str] = (), dealt: bool = False) -> Snapshot:
    """Version 1 of a table, from rows with unique keys; buckets by their number unless given.

    ``dealt`` rows come from ``repartition(buckets, *by)`` and are written without another shuffle.
    """
    spark, schema = df.sparkSession, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if buckets is None:
        df = save_snapshot(df, f"{root}/counted")
        buckets = buckets_for(df.count())
    made = Snapshot(spark, root, tuple(keys), schema, buckets, 1, {}, by=tuple(by))
    _write(made, df, dealt)
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{root}/data/version=1")
    return made._published([r[0] for r in written.select("bucket").distinct().collect()])


def open_version(spark: SparkSession, root: str, version: int) -> Snapshot:
    """A published version of a table."""
    rows = spark.read.parquet(f"{root}/manifest/version={version}").collect()
    head = rows[0]
    schema = T.StructType.fromJson(json.loads(head["schema"]))
    held = {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}
    return Snapshot(spark, root, tuple(head["keys"].split("\n")), schema, head["buckets"], version, held, head["same"] and tuple(json.loads(head["same"])), tuple(json.loads(head["by"])))
