"""G4-G6: the gold SQL models, as DataFrame functions.

* revenue_trends: 7-ROW rolling measures and a 30-ROW lag (row offsets, not
  calendar days).  A global window is used on purpose: the input is one row
  per day, so the single task holds a few thousand rows at any fact size.
* top_products: ranks per period from value counts, so no task holds a whole month.
* customer_ltv: three global quartiles over customer-grain data, told by the few
  cut rows at which a quartile begins, never by a single-partition window.

The models' trailing ORDER BY has no effect on a materialised table, so it
is not applied here (it would cost a range-sampling job and a shuffle); the
report queries that need an order sort their own (small) results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.ranking import By, ntile_columns, rank_within
from ledgerflow.session import scratch_path


def revenue_trends(daily: DataFrame) -> DataFrame:
    """G4."""
    by_date = Window.orderBy("date")
    last7 = by_date.rowsBetween(-6, 0)
    rev = F.col("total_revenue")
    rolled = daily.select(
        "date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category",
        F.round(F.sum(rev).over(last7) / F.count(rev).over(last7).cast("decimal(20,0)"), 2).alias("revenue_7d_avg"),
        F.round(F.sum(rev).over(last7), 2).alias("revenue_7d_sum"),
        F.lag(rev, 30).over(by_date).alias("earlier"),
    )
    ago = F.col("earlier")
    # narrow operands keep 18 fractional digits in the quotient: one exact rounding
    growth = F.when(
        ago > 0,
        F.round(((rev - ago) * 100).cast("decimal(20,2)") / ago.cast("decimal(16,2)"), 2),
    )
    return rolled.select(
        "date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category",
        "revenue_7d_avg", "revenue_7d_sum", growth.alias("mom_growth_pct"),
    )


def _once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table: it is read several times, and its lineage may be long."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def top_products(perf: DataFrame, stored: bool = False) -> DataFrame:
    """G5.  DESC sorts put NULLs first, as the SQL models' database does.

    The ranks and the period's revenue come from aggregates of ``perf`` joined back to it.
    ``stored``: ``perf`` is a table already; else it is written once, since it is read
    by each of them.
    """
    if not stored:
        perf = _once(perf, "performance")
    totals = perf.groupBy("period").agg(F.sum("revenue").alias("_period_revenue"))
    totals = totals.select(F.col("period").alias("_t_period"), "_period_revenue")
    ranked = rank_within(perf, ["period"], By("revenue"), "revenue_rank")
    ranked = rank_within(ranked, ["period"], By("units_sold"), "volume_rank")
    ranked = ranked.join(totals, ranked["period"].eqNullSafe(totals["_t_period"]), "left").drop("_t_period")
    period_total = F.nullif(F.col("_period_revenue"), F.lit(0)).cast("decimal(18,2)")
    share = F.round((F.col("revenue") * 100).cast("decimal(20,2)") / period_total, 2)
    return ranked.select(
        "product_id", "product_name", "category", "period", "units_sold", "revenue", "avg_price",
        F.round(F.col("return_rate") * 100, 2).alias("return_rate_pct"),
        "revenue_rank", "volume_rank",
        share.alias("revenue_share_pct"),
    )


def customer_ltv(segments: DataFrame, best_is_4: bool = False, stored: bool = False) -> DataFrame:
    """G6.  Quartiles are taken over DESC order as in the model, so quartile 4
    is the LOWEST spend / fewest orders / oldest order and 'champion' labels
    that group.  ``best_is_4=True`` flips the order so 4 is the best.
    Ties inside a quartile boundary are broken by customer_id ascending.
    ``stored``: ``segments`` is a table already; else the columns in use are written once."""
    base = segments.select("customer_id", "segment", "total_spent", "order_count", "last_order_at", "clv_score")
    q = base if stored else _once(base, "segments")
    orders = [
        (By("total_spent", not best_is_4), "monetary_quartile"),
        (By("order_count", not best_is_4), "frequency_quartile"),
        (By("last_order_at", not best_is_4, nulls_first=False), "recency_quartile"),
    ]
    q = ntile_columns(q, 4, orders, "customer_id")
    m, f, r = F.col("monetary_quartile"), F.col("frequency_quartile"), F.col("recency_quartile")
    rfm_segment = (
        F.when((m == 4) & (f == 4), "champion")
        .when((m >= 3) & (f >= 3), "loyal")
        .when(r == 4, "new")
        .when((r <= 2) & (m >= 3), "at_risk")
        .otherwise("regular")
    )
    avg_value = F.round(F.col("total_spent") / F.nullif(F.col("order_count"), F.lit(0)).cast("decimal(20,0)"), 2)
    return q.select(
        "customer_id", "segment",
        rfm_segment.alias("rfm_segment"),
        (m + f + r).alias("rfm_score"),
        "total_spent", "order_count",
        avg_value.alias("avg_order_value"),
        "last_order_at",
        F.round("clv_score", 4).alias("clv_score"),
        "monetary_quartile", "frequency_quartile", "recency_quartile",
    )
