"""Date ranges read only the month folders they name, and give the rows of the unpruned views."""

import pytest
from pyspark.sql import functions as F

from marketlake.operators import stats
from marketlake.plans import analyses as A
from marketlake.plans import reports as R
from marketlake.plans.model import build_model, month_index, month_label, stored_items_by_month
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(str, df.collect()))


def test_month_folders_hold_every_item(spark):
    items, months = stored_items_by_month(spark, SF_SMALL)
    m = build_model(spark, SF_SMALL)
    assert items.count() == m.fact_items.count()
    known = m.dim_orders.select("order_sk", month_index(F.col("order_purchase_t")).alias("want"))
    assert items.join(known, "order_sk", "left").filter(~F.col("want").eqNullSafe(F.col("purchase_month"))).count() == 0
    assert months.groupBy("market_segment", "purchase_month").count().filter("count > 1").count() == 0
    labels = known.select(month_label(F.col("want")).alias("a"), "order_sk").join(m.dim_orders, "order_sk")
    assert labels.filter(F.col("a") != F.date_format("order_purchase_t", "yyyy-MM")).count() == 0


@pytest.mark.parametrize("quarter", ["1998.Q2", "1995.Q1", "2050.Q4"])
def test_one_quarter_reads_three_months(spark, quarter):
    got = A.a2_box_one_quarter(spark, SF_SMALL, quarter)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    v1 = R.v1_seller_quarterly(build_model(spark, SF_SMALL)).filter(F.col("quarterly") == quarter)
    parts = F.split("quarterly", r"\.")
    v1 = v1.select(parts[0].cast("int").alias("year"), parts[1].alias("quarter"), "performance_tier", "order_volume")
    assert _rows(got) == _rows(stats.box_stats(v1, "order_volume", ["year", "quarter", "performance_tier"]))


@pytest.mark.parametrize("start, end", [("1995-04", "2001-07"), ("1995-01", "1995-02"), ("1996-05", "1996-06"), ("1990-01", "2050-01")])
def test_pivot_of_two_months_equals_the_whole_series(spark, start, end):
    v13 = R.v13_mom_growth(build_model(spark, SF_SMALL))
    assert _rows(A.a20_pivot_start_end(spark, SF_SMALL, start, end)) == _rows(stats.pivot_start_end(v13, "market_segment", "monthly", "t3m_revenue", start, end))


def test_pivot_and_burn_in_prune_months(spark):
    for df in (A.a20_pivot_start_end(spark, SF_SMALL), A.a19_burn_in(spark, SF_SMALL, "2001-01")):
        assert "PartitionFilters: []" not in [line for line in df._jdf.queryExecution().executedPlan().toString().split("Scan parquet") if "purchase_month" in line][0]
    v13 = R.v13_mom_growth(build_model(spark, SF_SMALL))
    for after in ("1995-03", "2001-01", "1994-01"):
        want = stats.after(v13, "monthly", after).select("market_segment", "monthly", "this_month_revenue", "t3m_revenue")
        assert _rows(A.a19_burn_in(spark, SF_SMALL, after)) == _rows(want)
