"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.plans import reports
from marketlake.plans.model import build_model

Query = Callable[[SparkSession, str], DataFrame]


def _report(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(build_model(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


REPORT_QUERIES: dict[str, Query] = {
    name: _report(getattr(reports, name))
    for name in ("v1_seller_quarterly v2_market_leaders v3_segment_median v4_seller_delay_tier "
                 "v5_segment_delay_risk v6_late_counts v7_l6m_late_rate v8_delay_rank "
                 "v9_category_performance v10_top_categories v11_price_tiers "
                 "v12_state_reliability v13_mom_growth").split()
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(REPORT_QUERIES)
    from marketlake.plans.etl_queries import QUERIES as ETL_QUERIES
    out.update(ETL_QUERIES)
    from marketlake.plans.analyses import QUERIES as ANALYSES
    out.update(ANALYSES)
    from marketlake.plans.source_queries import QUERIES as SOURCES
    out.update(SOURCES)
    return out


def all_oracles() -> dict[str, str]:
    from marketlake.plans import oracle_sql
    out: dict[str, str] = {}
    out.update(oracle_sql.REPORTS)
    from marketlake.plans import oracle_etl_sql
    out.update(oracle_etl_sql.QUERIES)
    from marketlake.plans import oracle_analyses_sql
    out.update(oracle_analyses_sql.QUERIES)
    from marketlake.plans import oracle_warehouse_sql
    out.update(oracle_warehouse_sql.QUERIES)
    from marketlake.plans import oracle_source_sql
    out.update(oracle_source_sql.QUERIES)
    return out
