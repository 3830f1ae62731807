"""Named queries over the driver tables: each is ``(spark, sf_dir) -> DataFrame``.

The silver, gold and model queries start from the given parquet tables (through the
bronze adapter) and run their full lineage. The report queries and the table tests read
the gold tables of a warehouse that the batch pipeline has built from the same
tables, as the serving layer does. Building a query can run Spark jobs: the pipeline
behind a warehouse, the staged input of a ranking model, the streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import gold, quality, silver
from ledgerflow.plans import models, reports
from ledgerflow.session import shuffle_width
from ledgerflow.sources import driver as D

AS_OF = D.DRIVER_AS_OF
LOOKUP_CUSTOMER = 7
REPORT_PERIOD = "2000-06"


class Lineage:
    """The lazily built tables of one (session, data folder) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    # bronze
    def bronze_orders(self):
        return D.bronze_orders(self.spark, self.sf_dir)

    def landing_orders(self):
        """The orders to be landed by day, and whether they are dealt out by day already."""
        dealt = D.small_dimensions(self.spark, self.sf_dir)
        return D.bronze_orders(self.spark, self.sf_dir, by_day=dealt), dealt

    def bronze_customers(self):
        return D.bronze_customers(self.spark, self.sf_dir)

    def bronze_products(self):
        return D.bronze_products(self.spark, self.sf_dir)

    # silver
    def orders(self):
        return silver.clean_orders(self.bronze_orders(), ingested_at=False)

    def customers(self):
        return silver.clean_customers(self.bronze_customers(), AS_OF, ingested_at=False)

    def products(self):
        return silver.clean_products(self.bronze_products(), ingested_at=False)

    # gold
    def daily_sales(self):
        return gold.daily_sales(self.orders())

    def product_performance(self):
        return gold.product_performance(self.orders(), self.products())

    def customer_segments(self):
        return gold.customer_segments(
            self.orders(), self.customers(), AS_OF, D.DRIVER_VIP_OVER, D.DRIVER_PREMIUM_OVER
        )

    # models
    def revenue_trends(self):
        return models.revenue_trends(self.daily_sales())

    def top_products(self):
        return models.top_products(self.product_performance())

    def customer_ltv(self):
        return models.customer_ltv(self.customer_segments())


def present(df: DataFrame) -> DataFrame:
    """Comparison-friendly output types: exact decimals become doubles (cast
    once, after all arithmetic), narrow integers become long, and instants
    and calendar days become wall-clock UTC timestamps."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.DateType)):
            # calendar days as midnight wall-clock timestamps: pandas renders
            # a DuckDB DATE as a timestamp and a Spark DATE as a date object
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def utc_calendar(spark: SparkSession) -> None:
    """The pipeline's calendar (order day, month, period) is UTC: the feeds
    carry +00:00 offsets.  Day functions follow the session time zone, so
    the session is pinned to UTC before a query is built."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _q(fn: Callable[[Lineage], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        utc_calendar(spark)
        return present(fn(Lineage(spark, sf_dir)))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


CORE_QUERIES: dict[str, Callable[[Lineage], DataFrame]] = {
    "clean_orders": lambda L: L.orders(),
    "clean_customers": lambda L: L.customers(),
    "clean_products": lambda L: L.products(),
    "dq_orders": lambda L: quality.run_checks(L.orders(), "orders", "silver", quality.orders_checks()),
    "dq_customers": lambda L: quality.run_checks(L.customers(), "customers", "silver", quality.customers_checks()),
    "dq_products": lambda L: quality.run_checks(L.products(), "products", "silver", quality.products_checks()),
    "daily_sales": lambda L: L.daily_sales(),
    "product_performance": lambda L: L.product_performance(),
    "customer_segments": lambda L: L.customer_segments(),
    "revenue_trends": lambda L: L.revenue_trends(),
    "top_products": lambda L: L.top_products(),
    "customer_ltv": lambda L: L.customer_ltv(),
    "to_numeric_try": lambda L: _to_numeric(L),
}


def _to_numeric(L: Lineage) -> DataFrame:
    """FN9 / FN21: coerce text to numbers, unparsable -> NULL (no error), over
    the events table: numeric text, a label and a JSON blob."""
    from ledgerflow.functions import to_numeric

    ev = D.table(L.spark, L.sf_dir, "events")
    return ev.select(
        "event_id",
        to_numeric(F.col("value").cast("string")).alias("value_num"),
        to_numeric("event_type").alias("event_type_num"),
        to_numeric("props").alias("props_num"),
        to_numeric(F.col("user_id").cast("string"), "long").alias("user_id_num"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, fn in CORE_QUERIES.items():
        fn.__name__ = name
        out[name] = _q(fn)
    return out


# --------------------------------------------------------------------------
# Queries over the batch pipeline's own outputs (run log, DQ log, catalog,
# partitioned round trip, upsert).  The pipeline is run once per session and
# data folder into a fresh warehouse under the shared checkpoint folder.
# --------------------------------------------------------------------------
_WAREHOUSES: dict[tuple[str, str], object] = {}


def _feed_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the order feed: one a line item (from Parquet footers)."""
    return D.table(spark, sf_dir, "lineitem").count()


def batch_warehouse(spark: SparkSession, sf_dir: str):
    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        L = Lineage(spark, sf_dir)
        wh = Warehouse(spark, scratch_path(spark, "warehouse"))
        with shuffle_width(spark, _feed_rows(spark, sf_dir)):
            orders, dealt = L.landing_orders()
            jobs.run_all(
                wh, orders, L.bronze_customers(), L.bronze_products(),
                AS_OF, D.DRIVER_VIP_OVER, D.DRIVER_PREMIUM_OVER, True, dealt,
            )
        _WAREHOUSES[key] = wh
    return _WAREHOUSES[key]


def _report_runs(spark, sf_dir):
    wh = batch_warehouse(spark, sf_dir)
    # timings and ids are wall-clock values: left out of the compared output
    return reports.recent_runs(wh.read("meta", "pipeline_runs")).select(
        "pipeline_name", "layer", "status", "rows_read", "rows_written"
    )


def _report_catalog(spark, sf_dir):
    wh = batch_warehouse(spark, sf_dir)
    return reports.catalog(wh.read_latest("meta", "table_catalog")).select("table_name", "layer", "format", "row_count")


def _report_dq(spark, sf_dir):
    wh = batch_warehouse(spark, sf_dir)
    return reports.recent_dq(wh.read("meta", "dq_results")).drop("run_at")


def _report_status_counts(spark, sf_dir):
    return reports.run_status_counts(batch_warehouse(spark, sf_dir).read("meta", "pipeline_runs"))


def _report_dq_pass_rate(spark, sf_dir):
    return reports.dq_pass_rate(batch_warehouse(spark, sf_dir).read("meta", "dq_results"))


def _gold(spark, sf_dir, name):
    return batch_warehouse(spark, sf_dir).read("gold", name, name not in ("product_performance", "top_products"))


def _table_tests(spark, sf_dir):
    """DQ6 / DQ7 over the materialised models."""
    parts = [
        quality.table_tests(_gold(spark, sf_dir, "revenue_trends"), "revenue_trends", ["date", "total_revenue", "total_orders"], ["date"]),
        quality.table_tests(_gold(spark, sf_dir, "top_products"), "top_products", ["product_id", "period", "revenue"]),
        quality.table_tests(_gold(spark, sf_dir, "customer_ltv"), "customer_ltv", ["customer_id", "rfm_score"], ["customer_id"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _capped_ltv(spark, sf_dir):
    """SNK8: the serving-side guard on the CLV score (no NULL, at most 5,000,000)."""
    from ledgerflow.sinks import cap

    return _gold(spark, sf_dir, "customer_segments").select("customer_id", cap("clv_score", 5_000_000).cast("double").alias("clv_capped"))


def _run_outcomes(spark, sf_dir):
    """MD2: a run log with a job that succeeds and one that fails (a feed without its price column)."""
    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path

    L = Lineage(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "outcomes"))
    jobs._silver_job(wh, "customers", L.bronze_customers(), lambda b: silver.clean_customers(b, AS_OF))
    try:
        jobs._silver_job(wh, "products", L.bronze_products().drop("base_price"), silver.clean_products)
    except Exception:  # the failure is what this query is about: it is logged and raised again
        pass
    log = wh.read("meta", "pipeline_runs")
    return log.select("pipeline_name", "status", "rows_read", "rows_written", F.col("error_msg").isNotNull().alias("has_error"))


def _roundtrip_partitioned(spark, sf_dir):
    """SNK1 + SRC1: the silver orders written partitioned by year/month/day, re-written for one
    year with DYNAMIC partition overwrite (other years untouched), then read back by partition
    discovery. It works on a copy of its own."""
    from ledgerflow.session import scratch_path
    from ledgerflow.sinks import write_partitioned
    from ledgerflow.sources.tables import read_partitioned

    root = scratch_path(spark, "roundtrip")
    source = read_partitioned(spark, batch_warehouse(spark, sf_dir).path("silver", "orders"))
    write_partitioned(source, root, ["year", "month", "day"])
    write_partitioned(source.filter(F.col("year") == 2001), root, ["year", "month", "day"], dynamic=True)
    back = read_partitioned(spark, root)
    return back.select(*[c for c in back.columns if c != "_ingested_at"])


def _land(rows: DataFrame, wh, date: str) -> None:
    """Append order files in the landing folder of one date."""
    y, m, d = (int(x) for x in date.split("-"))
    rows.withColumns({"year": F.lit(y), "month": F.lit(m), "day": F.lit(d)}).write.mode("append").partitionBy(
        "year", "month", "day"
    ).parquet(wh.path("bronze", "orders"))


def incremental_warehouse(spark, sf_dir):
    """Silver and gold after a full run on a part of the orders and an incremental run on what landed later.

    The first landing lacks the urgent orders and all of the last month. In their place it
    has copies that later lose against the real order: some on a day of their own (which ends up empty), some without a
    readable date. The second landing comes weeks after most of its event days.
    """
    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir, "incremental")
    if key in _WAREHOUSES:
        return _WAREHOUSES[key]
    L = Lineage(spark, sf_dir)
    bronze = L.bronze_orders()
    late = (F.col("payment_method") == "1-URGENT") | (F.col("created_at") >= "2001-07-01")
    urgent = F.col("payment_method") == "1-URGENT"
    orders, dealt = L.landing_orders()
    # one pass: what is late is changed so that it sorts behind the real order; late orders without a payment method only come later
    first = orders.where(late.isNotNull() & (~late | urgent.isNotNull())).withColumns(
        {
            "product_id": F.when(late, F.col("product_id") + 1_000_000_000).otherwise(F.col("product_id")),
            "created_at": F.when(late & ~urgent, "1990-01-01T00:00:00+00:00").when(late, "soon").otherwise(F.col("created_at")),
        }
    )
    wh = Warehouse(spark, scratch_path(spark, "incremental"))
    with shuffle_width(spark, _feed_rows(spark, sf_dir)):
        jobs.land_bronze(wh, first, L.bronze_customers(), L.bronze_products(), dealt=dealt)
        jobs.bronze_to_silver(wh, *jobs.read_bronze(wh), AS_OF)
        jobs.silver_to_gold(wh, AS_OF, D.DRIVER_VIP_OVER, D.DRIVER_PREMIUM_OVER)
        _land(bronze.where(late), wh, "2001-08-20")
        days = jobs.bronze_to_silver_incremental(wh, "2001-08-10")
        jobs.silver_to_gold_incremental(wh, days, AS_OF, D.DRIVER_VIP_OVER, D.DRIVER_PREMIUM_OVER)
    _WAREHOUSES[key] = wh
    return wh


def _incremental_dq(spark, sf_dir):
    """DQ1 after the incremental run, as it logged it: counts of the rewritten days and stored counts of the others."""
    wh = incremental_warehouse(spark, sf_dir)
    log = wh.read("meta", "dq_results").where("table_name = 'orders'")
    last = log.select(F.max("run_at").alias("run_at"))
    return log.join(last, "run_at").select("table_name", "layer", "check_name", "status", "rows_tested", "rows_failed")


def _rolling_customers(spark, sf_dir):
    """AGG9: distinct customers of 30 days from the stored sketches, beside the exact count from silver.

    ``close`` says whether the estimate is within 5 % (three standard errors of the sketch) and one customer."""
    wh = batch_warehouse(spark, sf_dir)
    sketched = gold.rolling_customers(wh.read("gold", "daily_customers"))
    exact = gold.exact_rolling_customers(wh.read("silver", "orders")).withColumnRenamed("customers", "customers_30d")
    near = F.abs(F.col("customers") - F.col("customers_30d")) <= F.col("customers_30d") * 0.05 + 1
    return sketched.join(exact, "date").select("date", "customers_30d", near.alias("close"))


def _read_drift(spark, sf_dir):
    """SRC7: order files as different writers land them: money as double, an integer discount of
    0, decimals, and files without the payment method."""
    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path

    bronze = Lineage(spark, sf_dir).bronze_orders()
    wh = Warehouse(spark, scratch_path(spark, "drift"))
    money = {c: F.col(c).cast("double") for c in ("unit_price", "discount", "total_amount")}
    parts = [
        bronze.where("created_at < '1997'").withColumns(money),
        bronze.where("created_at >= '1997' and created_at < '1999' and discount = 0").withColumn("discount", F.lit(0)),
        bronze.where("created_at >= '1997' and created_at < '1999' and discount <> 0"),
        bronze.where("created_at >= '1999'").drop("payment_method"),
    ]
    for part in parts:
        _land(part, wh, "2001-08-02")
    return jobs.read_orders(wh)


def _upsert_gold(spark, sf_dir):
    """SNK4: product_performance built from the orders before 2000-12-15 is
    the target (its 2000-12 figures are partial); the full rebuild for the
    periods from 2000-12 on is the update batch: 2000-12 keys are updated,
    2001 keys inserted, older keys untouched.  Only the four measures are
    updated; name and category keep the target's values."""
    from ledgerflow.sinks import upsert

    L = Lineage(spark, sf_dir)
    early_orders = L.orders().filter(F.col("created_at") < F.lit("2000-12-15").cast("timestamp"))
    target = gold.product_performance(early_orders, L.products())
    updates = L.product_performance().filter(F.col("period") >= "2000-12")
    return upsert(target, updates, ["product_id", "period"], ["units_sold", "revenue", "avg_price", "return_rate"])


WAREHOUSE_QUERIES = {
    "report_summary": lambda s, d: reports.summary(_gold(s, d, "daily_sales"), _gold(s, d, "customer_segments"), AS_OF),
    "report_daily": lambda s, d: reports.recent_daily_sales(_gold(s, d, "daily_sales"), AS_OF),
    "report_trends": lambda s, d: reports.recent_trends(_gold(s, d, "revenue_trends")),
    "report_trends_fallback": lambda s, d: reports.trends_fallback(_gold(s, d, "daily_sales")),
    "report_top_products": lambda s, d: reports.top_products_report(_gold(s, d, "top_products")),
    "report_top_products_period": lambda s, d: reports.top_products_report(_gold(s, d, "top_products"), REPORT_PERIOD),
    "report_top_products_fallback": lambda s, d: reports.top_products_fallback(_gold(s, d, "product_performance")),
    "report_segments": lambda s, d: reports.segment_summary(_gold(s, d, "customer_segments")),
    "report_customer_ltv": lambda s, d: reports.customer_ltv_lookup(_gold(s, d, "customer_ltv"), LOOKUP_CUSTOMER),
    "report_category_rollup": lambda s, d: reports.category_rollup(_gold(s, d, "top_products")),
    "report_capped_ltv": _capped_ltv,
    "report_run_outcomes": _run_outcomes,
    "table_tests": _table_tests,
    "incremental_orders": lambda s, d: incremental_warehouse(s, d).read("silver", "orders").drop("_ingested_at"),
    "incremental_daily_sales": lambda s, d: incremental_warehouse(s, d).read("gold", "daily_sales"),
    "incremental_dq": _incremental_dq,
    "report_rolling_customers": _rolling_customers,
    "read_drift": _read_drift,
    "report_runs": _report_runs,
    "report_catalog": _report_catalog,
    "report_dq": _report_dq,
    "report_status_counts": _report_status_counts,
    "report_dq_pass_rate": _report_dq_pass_rate,
    "roundtrip_partitioned": _roundtrip_partitioned,
    "upsert_gold": _upsert_gold,
}


def _warehouse_q(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        utc_calendar(spark)
        return present(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = queries()
    for name, fn in WAREHOUSE_QUERIES.items():
        out[name] = _warehouse_q(fn)
    return out


def _arrive(rows: DataFrame, path: str) -> int:
    """Land one arrival of a feed, a file from each task that makes its rows; returns the number of files.

    A ``coalesce`` before the write would run the joins behind the rows in as few tasks as files, whatever the size.
    """
    from ledgerflow.sources.tables import list_files

    rows.write.parquet(path)
    return list_files(rows.sparkSession, path).count()


def _stream_clean(spark, sf_dir):
    """ST1: bronze orders arrive newest first, in several files and two runs, with a re-delivered
    month and orders years late; each run takes micro-batches of a few files. Silver equals the batch job's."""
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming import stream_clean_orders

    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "stream-silver", "ckpt-st1"))
    bronze = Lineage(spark, sf_dir).bronze_orders()
    files = _arrive(bronze.where("created_at >= '1998'"), f"{landing}/arrival_1")
    stream_clean_orders(spark, landing, out, ckpt, max_files_per_trigger=max(1, -(-files // 2))).awaitTermination()
    files = _arrive(bronze.where("created_at < '1998' or created_at >= '2001-07'"), f"{landing}/arrival_2")
    stream_clean_orders(spark, landing, out, ckpt, max_files_per_trigger=max(1, files)).awaitTermination()
    return spark.read.parquet(out).drop("_ingested_at")


def _stream_daily(spark, sf_dir):
    """ST2: the pipeline's silver orders streamed in several micro-batches; each recomputes the days it
    touched and exchanges them in an epoch-versioned gold table -- the result is the full daily_sales."""
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming import latest_version, stream_daily_sales

    wh = batch_warehouse(spark, sf_dir)
    dst, ckpt = scratch_path(spark, "stream-daily"), scratch_path(spark, "ckpt-st2")
    schema = wh.read("silver", "orders").schema
    stream_daily_sales(spark, wh.path("silver", "orders"), dst, ckpt, schema, max_files_per_trigger=1500).awaitTermination()
    return spark.read.parquet(latest_version(spark, dst))


def _stream_dedupe(spark, sf_dir):
    """ST1 with state: a feed that delivers a part again, once while the state knows it and once as changed copies that lose."""
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming import stream_deduped_orders

    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing-dd", "dedupe-silver", "ckpt-dd"))
    bronze = Lineage(spark, sf_dir).bronze_orders()
    _arrive(bronze, f"{landing}/arrival_1")
    stream_deduped_orders(spark, landing, out, ckpt).awaitTermination()
    again = bronze.where("created_at >= '2001'")
    _arrive(again.unionByName(again.withColumn("product_id", F.col("product_id") + 1_000_000_000)), f"{landing}/arrival_2")
    stream_deduped_orders(spark, landing, out, ckpt).awaitTermination()
    return spark.read.parquet(out).drop("_ingested_at")


def _stream_windows(spark, sf_dir):
    """ST2 with state: the pipeline's silver orders as day windows in several micro-batches, closed in two steps."""
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming import close_days, daily_figures, stream_day_windows

    wh = batch_warehouse(spark, sf_dir)
    windows, closed, ckpt = (scratch_path(spark, n) for n in ("windows", "windows-closed", "ckpt-windows"))
    src, schema = wh.path("silver", "orders"), wh.read("silver", "orders").schema
    stream_day_windows(spark, src, windows, ckpt, schema, max_files_per_trigger=1500).awaitTermination()
    close_days(spark, windows, src, closed, schema, before=20000101)
    close_days(spark, windows, src, closed, schema)
    return daily_figures(spark, windows, src, closed)


def _widened(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``fn`` with shuffles as wide as the feed needs in the jobs and streams that it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with shuffle_width(spark, _feed_rows(spark, sf_dir)):
            return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    return run


WAREHOUSE_QUERIES["stream_dedupe"] = _widened(_stream_dedupe)
WAREHOUSE_QUERIES["stream_windows"] = _widened(_stream_windows)
WAREHOUSE_QUERIES["stream_clean"] = _widened(_stream_clean)
WAREHOUSE_QUERIES["stream_daily"] = _widened(_stream_daily)
