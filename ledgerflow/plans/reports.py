"""RP1-RP13: the serving-layer queries, as DataFrame functions.

Each returns a lazy DataFrame.  "Latest period" and similar lookups are
uncorrelated scalar subqueries (``DataFrame.scalar()``), which Catalyst runs
once and inlines as a literal -- no collect() on the driver.  Top-k reads
are ``orderBy().limit()``, planned as ``TakeOrderedAndProject`` (a per-task
top-k merged on one task: k rows per task, never the whole input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.functions import as_of_date, exact_avg


def _since(as_of, days: int):
    return F.col("date") >= F.date_sub(as_of_date(as_of), days)


def summary(daily: DataFrame, segments: DataFrame, as_of=None, days: int = S.RECENT_DAYS) -> DataFrame:
    """RP1: trailing-window totals (empty window -> zeros) plus all-time counts
    of vip and at_risk customers.  avg_order_value is the unweighted mean of
    the daily averages; unique_customers is the largest daily count.

    Both inputs go through ONE global aggregate over their union (each side
    partial-aggregated per task), instead of a query per figure."""
    d = daily.filter(_since(as_of, days)).select(
        "total_revenue", "total_orders", "avg_order", "unique_customers", F.lit(None).cast("string").alias("segment")
    )
    s = segments.select(
        F.lit(None).cast(daily.schema["total_revenue"].dataType).alias("total_revenue"),
        F.lit(None).cast(daily.schema["total_orders"].dataType).alias("total_orders"),
        F.lit(None).cast(daily.schema["avg_order"].dataType).alias("avg_order"),
        F.lit(None).cast(daily.schema["unique_customers"].dataType).alias("unique_customers"),
        "segment",
    )
    return d.unionByName(s).agg(
        F.lit(f"last_{days}_days").alias("period"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.avg("avg_order"), F.lit(0)).alias("avg_order_value"),
        F.coalesce(F.max("unique_customers"), F.lit(0)).alias("unique_customers"),
        F.count_if(F.col("segment") == "vip").alias("vip_customers"),
        F.count_if(F.col("segment") == "at_risk").alias("at_risk_customers"),
    )


def recent_daily_sales(daily: DataFrame, as_of=None, days: int = S.RECENT_DAYS) -> DataFrame:
    """RP2: the last ``days`` days, newest first, date as 'YYYY-MM-DD'."""
    return (
        daily.filter(_since(as_of, days))
        .orderBy(F.col("date").desc())
        .select(
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category",
        )
    )


def recent_trends(trends: DataFrame, n: int = S.TRENDS_LIMIT) -> DataFrame:
    """RP3."""
    rev = F.col("total_revenue")
    return (
        trends.select(
            "date", "total_revenue",
            F.coalesce("revenue_7d_avg", rev).alias("revenue_7d_avg"),
            F.coalesce("revenue_7d_sum", rev).alias("revenue_7d_sum"),
            "mom_growth_pct",
        )
        .orderBy(F.col("date").desc())
        .limit(n)
    )


def trends_fallback(daily: DataFrame, n: int = S.TRENDS_LIMIT) -> DataFrame:
    """RP4: unrounded 7-row measures straight from daily_sales, no growth."""
    w = Window.orderBy("date").rowsBetween(-6, 0)
    return (
        daily.select(
            "date", "total_revenue",
            F.avg("total_revenue").over(w).alias("revenue_7d_avg"),
            F.sum("total_revenue").over(w).alias("revenue_7d_sum"),
            F.lit(None).cast("double").alias("mom_growth_pct"),
        )
        .orderBy(F.col("date").desc())
        .limit(n)
    )


def latest_period(df: DataFrame):
    """Uncorrelated scalar subquery: MAX(period)."""
    return df.select(F.max("period")).scalar()


def top_products_report(top: DataFrame, period: str | None = None, limit: int = S.TOP_PRODUCTS_LIMIT) -> DataFrame:
    """RP5: one period (default: the latest), by revenue rank; equal ranks
    are cut by product_id so the limit is deterministic."""
    wanted = F.lit(period) if period else latest_period(top)
    return (
        top.filter(F.col("period") == wanted)
        .orderBy(F.col("revenue_rank").asc(), F.col("product_id").asc())
        .limit(limit)
        .select(
            "product_id", "product_name", "category", "period", "units_sold", "revenue", "avg_price",
            "return_rate_pct", F.col("revenue_rank").alias("rank"),
        )
    )


def top_products_fallback(perf: DataFrame, limit: int = S.TOP_PRODUCTS_LIMIT) -> DataFrame:
    """RP6: latest period straight from product_performance, unknown names
    shown as 'Unknown'.  The top-k is taken first (per-task partial top-k),
    then ranked: every row that outranks a top-k row is itself in the top-k,
    so RANK over the k rows equals RANK over the whole period."""
    latest = perf.filter(F.col("period") == latest_period(perf))
    top = latest.orderBy(F.col("revenue").desc_nulls_first(), F.col("product_id").asc()).limit(limit)
    w = Window.partitionBy("period").orderBy(F.col("revenue").desc_nulls_first())
    return top.select(
        "product_id",
        F.coalesce("product_name", F.lit("Unknown")).alias("product_name"),
        F.coalesce("category", F.lit("Unknown")).alias("category"),
        "period", "units_sold", "revenue", "avg_price",
        F.round(F.col("return_rate") * 100, 2).alias("return_rate_pct"),
        F.rank().over(w).alias("rank"),
    ).orderBy(F.col("rank").asc(), F.col("product_id").asc())


def segment_summary(segments: DataFrame) -> DataFrame:
    """RP7."""
    return (
        segments.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("count"),
            exact_avg("total_spent", 2).alias("avg_spent"),
            exact_avg("order_count", 1).alias("avg_orders"),
            exact_avg("clv_score", 4).alias("avg_clv"),
        )
        .orderBy(F.col("avg_spent").desc_nulls_first())
    )


def customer_ltv_lookup(ltv: DataFrame, customer_id: int) -> DataFrame:
    """RP8: one row, or none (the caller's 'not found')."""
    return ltv.filter(F.col("customer_id") == F.lit(customer_id)).select(
        "customer_id", "segment", "rfm_segment", "rfm_score", "total_spent",
        "avg_order_value", "order_count", "last_order_at", "clv_score",
    )


def recent_runs(runs: DataFrame, n: int = S.RUNS_LIMIT) -> DataFrame:
    """RP9: newest first (insertion sequence breaks equal timestamps)."""
    return runs.orderBy(F.col("started_at").desc(), F.col("seq").desc()).limit(n).select(
        "run_id", "pipeline_name", "layer", "status", "rows_read", "rows_written",
        "duration_ms", "started_at", "finished_at",
    )


def catalog(cat: DataFrame) -> DataFrame:
    """RP10."""
    return cat.orderBy("layer", "table_name").select(
        "table_name", "layer", "location", "format", "row_count", "size_bytes", "last_updated",
    )


def recent_dq(dq: DataFrame, n: int = S.DQ_LIMIT) -> DataFrame:
    """RP11."""
    return dq.orderBy(F.col("run_at").desc(), F.col("seq").desc()).limit(n).select(
        "table_name", "layer", "check_name", "status", "rows_tested", "rows_failed", "run_at",
    )


def category_rollup(top: DataFrame, n: int = S.DASHBOARD_TOP_N) -> DataFrame:
    """RP12: revenue and units per category over the dashboard's top-n list."""
    return (
        top_products_report(top, None, n)
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units"))
        .orderBy(F.col("revenue").asc())
    )


def run_status_counts(runs: DataFrame, n: int = S.RUNS_LIMIT) -> DataFrame:
    """RP13a: status counts over the recent-runs list."""
    recent = recent_runs(runs, n)
    return recent.agg(
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "running").alias("running"),
    )


def dq_pass_rate(dq: DataFrame, n: int = S.DQ_LIMIT) -> DataFrame:
    """RP13b: share of passing checks (percent, 1 decimal) over the recent list."""
    recent = recent_dq(dq, n)
    return recent.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "pass").alias("passed"),
    ).withColumn(
        "pass_rate_pct",
        F.round(F.try_divide((F.col("passed") * 100).cast("decimal(20,0)"), F.col("checks").cast("decimal(20,0)")), 1),
    )
