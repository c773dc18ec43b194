"""Mixing sources to target weights: hash-random keys, prefix sums, exact cuts, epochs.

Each row gets a random key, the MD5 of its id. Equal ranges of the key
(``BUCKETS`` of them) split every source evenly, also one that holds most
rows. Sizes are summed per (source, range); running sums over that small
table say which ranges lie wholly inside a source's budget and which one the
cut falls into. Inside that range the rows are counted per (key, id, size), and
running sums over these counts find the group of equal rows that holds the cut.
That group, be it a third of all rows (no id, one size), is parted by a stored
random number in the same way: counts per range of it, then one range is numbered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from marketlake.llm.common import free_name, id_text, stored

#: Ranges per source: three hexadecimal digits of the key.
BUCKETS = 4096
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Runs of characters other than ASCII white space; null counts none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple = (5, 2, 1), cap: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes; no target exceeds ``cap`` times its source, and what is
    over goes to the others by weight. In order of cap / weight that has a
    closed form: the share per weight is the first one that its own source's
    cap does not fall below.
    """
    n = len(weights)
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % n + 1).cast("int"))
    s = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * cap)
    order = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    s = (s.withColumn("place", F.row_number().over(order))
         .withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("open", F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(W.partitionBy())))
    s = s.withColumn("per", (F.col("total") - F.col("capped")) / F.col("open"))
    fits = F.when(F.col("cap") / F.col("w") >= F.col("per"), F.struct("place", "per"))
    s = s.withColumn("per", F.min(fits).over(W.partitionBy())["per"])
    return s.select("source", "source_size", F.least(F.col("per") * F.col("w"), F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", keep: tuple = (),
        weights: tuple = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per input row: ``keep`` columns, id, source, size, source_size, target, copies, taken.

    ``copies`` (0 to ``cap``) is how often the row is taken and ``taken`` its
    words in the mix. Whole epochs come first; the rest of the budget takes
    rows in key order as long as a row's middle lies within it, so a source
    misses its target by half a document at most. Null sources are a source
    of their own, null ids have one common key, rows of size 0 are taken when
    their place is. Rows equal in id and size may swap places, which changes
    nothing that is returned about them. No task holds all rows of an id.
    """
    key = F.md5(F.concat(id_text(F.col(id_col)), F.lit(":mix")).cast("binary"))
    rows = docs.select(*keep, F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), key.alias("key"), F.rand().alias("spread"))
    rows = stored(rows, "mix").withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    buckets = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("b")), "buckets")
    goal = stored(targets(buckets.groupBy("source").agg(F.sum("b").alias("source_size")), weights, cap), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("epochs", whole).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    before = F.coalesce(F.sum("b").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = buckets.withColumn("before", before).withColumnRenamed("source", "s")
    cut = (ends.join(goal, F.col("s").eqNullSafe(F.col("source"))).filter(F.col("before") + F.col("b") > F.col("rest"))
           .groupBy("s").agg(F.min(F.struct("bucket", "before")).alias("cut")))
    plan = stored(goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
                  .select(F.col("source").alias("s"), "source_size", "target", "epochs", "rest", F.col("cut.bucket").alias("cut_at"), F.col("cut.before").alias("cut_from")), "plan")
    found = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    at_cut = F.col("rest").__gt__(0) & F.coalesce(F.col("bucket") == F.col("cut_at"), F.lit(False))
    below = F.coalesce(F.col("bucket") < F.col("cut_at"), F.lit(True)) & (F.col("rest") > 0)
    plain = found.filter(~at_cut).withColumn("copies", F.col("epochs") + below.cast("long"))
    edge = _taken_at_cut(found.filter(at_cut)).withColumn("copies", F.col("epochs") + F.col("last").cast("long")).drop("last")
    out = plain.unionByName(edge)
    return out.select(*keep, "id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def _taken_at_cut(edge: DataFrame) -> DataFrame:
    """``edge``, the rows of each source's cut range, with ``last``: whether the rest of the budget takes the row.

    Middles of rows in order never decrease, so per source one group of equal
    rows (``at``) holds the cut: groups before it are taken, groups after it
    are not, and of its own rows the first ``n``.
    """
    place = F.struct("key", "id", "size")
    groups = edge.groupBy("source", "key", "id", "size").agg(F.count(F.lit(1)).alias("rows"), F.first("cut_from").alias("cut_from"), F.first("rest").alias("rest"))
    run = F.sum(F.col("size") * F.col("rows")).over(W.partitionBy("source").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, W.currentRow))
    groups = groups.withColumn("from", F.col("cut_from") + run - F.col("size") * F.col("rows"))

    def fits(n: Column) -> Column:
        return F.col("from") + n * F.col("size") - F.col("size") / 2 <= F.col("rest")

    about = F.floor((F.col("rest") - F.col("from")) / F.greatest(F.col("size"), F.lit(1)) + 0.5).cast("long")   # off by one at most, by rounding
    n = F.when(fits(about + 1), about + 1).when(fits(about), about).otherwise(about - 1)
    at = (groups.filter(~fits(F.col("rows"))).withColumn("n", F.when(F.col("size") > 0, F.greatest(n, F.lit(0))).otherwise(0))
          .groupBy("source").agg(F.min(F.struct("key", "id", "size", "n")).alias("m"))
          .select(F.col("source").alias("s"), F.struct("m.key", "m.id", "m.size").alias("at"), F.col("m.n").alias("n")))
    at = stored(at, "cut_groups")
    near = edge.join(at, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("part", F.floor(F.col("spread") * BUCKETS).cast("int"))
    sure = near.filter(F.col("at").isNull() | (place < F.col("at")) | (place > F.col("at"))).withColumn("last", F.col("at").isNull() | (place < F.col("at")))
    equal = near.filter((place >= F.col("at")) & (place <= F.col("at")))

    parts = equal.groupBy("source", "part").agg(F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"))
    before = F.sum("rows").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("rows")
    split = (parts.withColumn("before", before).filter(F.col("before") + F.col("rows") > F.col("n"))
             .groupBy("source").agg(F.min(F.struct("part", "before")).alias("m"))
             .select(F.col("source").alias("s"), F.col("m.part").alias("split"), F.col("m.before").alias("before")))
    equal = equal.join(stored(split, "cut_parts"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    inside = equal.filter(F.col("part") == F.col("split"))
    number = F.row_number().over(W.partitionBy("source", "part").orderBy("spread"))
    inside = inside.withColumn("last", F.col("before") + number <= F.col("n"))
    outside = equal.filter(F.col("split").isNull() | (F.col("part") != F.col("split"))).withColumn("last", F.coalesce(F.col("part") < F.col("split"), F.lit(True)))
    return reduce(DataFrame.unionByName, (t.select(*edge.columns, "last") for t in (sure, inside, outside)))


def mixed_rows(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", **settings) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it."""
    whole = free_name(docs, "mix_row")
    row = docs.select("*", F.struct(*docs.columns).alias(whole))
    taken = mix(row, size, id_col, source_col, keep=(whole,), **settings)
    return taken.filter("copies > 0").select(whole, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(f"{whole}.*")


OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS k
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM per_source),
-- in order of size by weight: what one weight gets if every source before is full; the first that its own source can take is right
levels AS (
  SELECT *, 3.0::DOUBLE * source_size / w AS ratio, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST) AS place FROM weighted),
shares AS (
  SELECT a.place, a.ratio,
         ((SELECT sum(source_size) FROM levels) - coalesce((SELECT sum(3 * b.source_size) FROM levels b WHERE b.place < a.place), 0))::DOUBLE
         / (SELECT sum(b.w) FROM levels b WHERE b.place >= a.place)::DOUBLE AS per
  FROM levels a),
per_weight AS (
  SELECT arg_min(per, place) AS per FROM shares WHERE ratio >= per),
budget AS (
  SELECT source, source_size, least(per * w, 3.0::DOUBLE * source_size) AS target FROM weighted, per_weight),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_epochs FROM budget),
placed AS (
  SELECT s.*, e.source_size, e.target, e.full_epochs, e.target - e.full_epochs * e.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size / 2.0::DOUBLE AS middle
  FROM sized s JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (full_epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
