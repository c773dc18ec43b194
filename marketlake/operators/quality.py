"""Data-quality and profiling operators.

Every check is one distributed aggregate or filter; results are DataFrames
(nothing is collected). Wide profiles compute all columns in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlake.functions.exact import round_ratio

# The reference's format rules.
ID_PATTERN = r"^[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*$"
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
COUNT_PATTERN = r"^[0-9]*$"
PAYMENT_TYPE_PATTERN = r"^[a-z]*[_]?[a-z]*$"
DATETIME_PATTERN = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
ZIP_PATTERN = r"\d*"              # as written in the reference: never fails
ZIP_PATTERN_STRICT = r"^\d+$"     # corrected alternative
FLOAT_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _violates(col: str, pattern: str) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).rlike(pattern)


def rows_loaded(df: DataFrame, file_col: str = "loaded_file") -> DataFrame:
    """K1: rows per loaded file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows_loaded"))


def format_violations(df: DataFrame, rules: Mapping[str, str], show: Sequence[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """K2: rows where any non-null column fails its pattern.

    ``limit`` reproduces the reference's ``LIMIT 50`` preview; by default
    the whole violation set is returned.
    """
    cond = None
    for col, pattern in rules.items():
        v = _violates(col, pattern)
        cond = v if cond is None else cond | v
    out = df.filter(cond).select(*(show or df.columns))
    return out if limit is None else out.limit(limit)


def violation_counts(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """K2 summary: (column, violations) for every rule, in one pass."""
    agg = df.agg(*[F.sum(F.when(_violates(c, p), 1).otherwise(0)).alias(c) for c, p in rules.items()])
    stack = ", ".join(f"'{c}', `{c}`" for c in rules)
    return agg.selectExpr(f"stack({len(rules)}, {stack}) AS (column_name, violations)")


def violation_rows(df: DataFrame, rules: Mapping[str, str], id_col: str = "staging_id") -> DataFrame:
    """K2 rows: (row id, column) of every value that fails its pattern, in one pass."""
    failed = F.array_compact(F.array(*[F.when(_violates(c, p), F.lit(c)) for c, p in rules.items()]))
    return df.select(id_col, F.explode(failed).alias("column_name"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """K3: natural keys occurring more than once, with their count."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1")
    return out if limit is None else out.limit(limit)


def require_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose natural key columns are all present."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def missing_pct(df: DataFrame, cols: Sequence[str], long: bool = False) -> DataFrame:
    """K4: ``ROUND(100 * share of NULL-or-blank, 3)`` per column, one row
    (``long``: one (column_name, pct_missing) row per column).

    The reference divides by zero on an empty table; here the value is NULL.
    """
    n = F.count(F.lit(1))
    aggs = [n.alias("total_rows")]
    for c in cols:
        missing = F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), 1).otherwise(0))
        aggs.append(round_ratio(missing * 100, n, 3).alias(f"pct_missing_{c}"))
    wide = df.agg(*aggs)
    if not long:
        return wide
    stack = ", ".join(f"'{c}', `pct_missing_{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, pct_missing)")


def observed_missing(df: DataFrame) -> tuple[DataFrame, Observation]:
    """K4 without a scan of its own: ``df`` counting its rows (under ``""``) and missing text per column while it is written."""
    seen = Observation()
    blank = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c)) == "")).alias(c) for c, kind in df.dtypes if kind == "string"]
    return df.observe(seen, F.count(F.lit(1)).alias(""), *blank), seen


def near_duplicates(df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    """K5: values that collapse under ``lower(trim(x))`` with their variants.

    Variants are the distinct raw spellings of one normalised value (deduped
    map-side by ``collect_set``), sorted and joined with ``'|'``. Ordered by
    row count DESC, then the normalised value (a deterministic tie-break).
    """
    norm = F.lower(F.trim(F.col(col))).alias(f"{col}_norm")
    g = df.groupBy(norm).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(col).alias("distinct_variants"),
        F.array_join(F.sort_array(F.collect_set(col)), "|").alias("variants"))
    out = g.filter("distinct_variants > 1").orderBy(F.desc("total_rows"), F.asc_nulls_last(f"{col}_norm"))
    return out if limit is None else out.limit(limit)


def guarded_range(df: DataFrame, cols: Sequence[str], parse) -> DataFrame:
    """K6: min / max of each column after a guarded parse, one row."""
    aggs = []
    for c in cols:
        v = parse(F.col(c))
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return df.agg(*aggs)


def coordinate_bounds(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """K7: guarded min / max of latitude and longitude plus out-of-range counts."""
    def num(c):
        return F.when(F.col(c).rlike(FLOAT_PATTERN), F.col(c).try_cast("decimal(38,18)"))
    la, lo = num(lat), num(lng)
    return df.agg(
        F.min(la).cast("double").alias("latitude_min"), F.max(la).cast("double").alias("latitude_max"),
        F.min(lo).cast("double").alias("longitude_min"), F.max(lo).cast("double").alias("longitude_max"),
        F.sum(F.when((la < -90) | (la > 90), 1).otherwise(0)).alias("latitude_out_of_range"),
        F.sum(F.when((lo < -180) | (lo > 180), 1).otherwise(0)).alias("longitude_out_of_range"))


def unmatched(df: DataFrame, fk: str, show: Sequence[str], order: Sequence[str],
              limit: int | None = None) -> DataFrame:
    """K8: rows whose foreign key did not resolve."""
    out = df.filter(F.col(fk).isNull()).select(*show).orderBy(*[F.asc_nulls_last(c) for c in order])
    return out if limit is None else out.limit(limit)


def unmatched_values(df: DataFrame, fk: str, col: str) -> DataFrame:
    """K9: distinct values behind unresolved keys."""
    return df.filter(F.col(fk).isNull()).select(col).distinct().orderBy(F.asc_nulls_last(col))


def key_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """NOT NULL and UNIQUE rules on a key, as (table, rule, violations)."""
    null_rows = df.filter(" OR ".join(f"`{k}` IS NULL" for k in keys))
    nulls = null_rows.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"), "violations")
    dups = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations"))
            .select(F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), "violations"))
    return nulls.unionByName(dups)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join), counted."""
    c = child.select(F.col(fk).alias("_fk")).filter(F.col("_fk").isNotNull())
    p = parent.select(F.col(pk).alias("_fk"))
    return (c.join(p, "_fk", "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows"))
            .select(F.lit(relation).alias("relation"), "orphan_rows"))
