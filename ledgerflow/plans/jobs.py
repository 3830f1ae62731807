"""The batch pipeline: bronze -> silver -> gold -> models, with run log,
data-quality log and catalog.

Each job writes its table and then takes every count and check from the committed
table in one pass over the columns the checks need.  (Counters that ride on the
write itself are counted again when a task is repeated after a lost executor.)
Gold jobs read the silver tables back from parquet, so partition columns
are discovered and filters prune directories.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.operators import gold, quality, silver
from ledgerflow.plans import incremental, models
from ledgerflow.plans.kept import KeptOrders
from ledgerflow.plans.metadata import Warehouse, _now, flush_catalog, log_dq, log_run, register_table
from ledgerflow.session import BROADCAST_ROWS
from ledgerflow.sinks import drop_partitions, latest_version, path_exists, prune_versions, remove_path, replace_table
from ledgerflow.sinks import write_clustered, write_mark, write_partitioned, write_spread, write_table, write_version
from ledgerflow.sources.register import FooterRegister
from ledgerflow.sources.tables import read_drifting


def _job(wh: Warehouse, name: str, layer: str, body: Callable[[], tuple[int, int]]) -> tuple[int, int]:
    """Time a job, log success or (zero rows + error) failure, re-raise."""
    started = _now()
    try:
        rows_read, rows_written = body()
    except Exception as e:
        log_run(wh, name, layer, 0, 0, started, _now(), str(e)[:2000])
        raise
    log_run(wh, name, layer, rows_read, rows_written, started, _now())
    return rows_read, rows_written


def _order_counts(wh: Warehouse) -> str:
    """Where the check counts of the silver orders are kept by event day (versioned)."""
    return wh.path("meta", "order_check_counts")


def touched_orders(wh: Warehouse, days: list[int]) -> DataFrame:
    """The silver orders of some event days; reads only their folders."""
    return wh.read("silver", "orders").where(incremental.day_key().isin(days))


def _order_checks(wh: Warehouse, days: list[int] | None) -> DataFrame:
    """DQ1 of the silver orders from stored counts by event day: those of ``days`` are counted anew, None for all.

    The counts of the other days come from the last version, so an incremental run reads only what it has rewritten.
    Without a version, or if a run has died between silver and its counts (its mark is there), all days are counted.
    """
    root, checks = _order_counts(wh), quality.orders_checks()
    current = latest_version(wh.spark, root)
    if days is None or current is None:
        counts = quality.part_counts(wh.read("silver", "orders"), incremental.day_key(), checks)
    elif days:
        kept = wh.spark.read.parquet(current).where(~F.col("part").isin(days))
        counts = kept.unionByName(quality.part_counts(touched_orders(wh, days), incremental.day_key(), checks))
    else:
        return quality.total_checks(wh.spark.read.parquet(current), "orders", "silver", checks)
    version = 0 if current is None else int(current.rsplit("=", 1)[1]) + 1
    write_version(counts, root, version)
    prune_versions(wh.spark, root)
    return quality.total_checks(wh.spark.read.parquet(latest_version(wh.spark, root)), "orders", "silver", checks)


def _log_silver(wh: Warehouse, table: str, days: list[int] | None = None) -> int:
    """DQ rows, row count and catalog entry of a committed silver table; ``days``: the only ones of the orders that have changed."""
    if table == "orders":
        found = _order_checks(wh, days)
    else:
        found = quality.run_checks(wh.read("silver", table), table, "silver", quality.CHECK_SETS[table]())
    checked = found.collect()  # a row a check
    columns = "table_name string, layer string, check_name string, status string, rows_tested long, rows_failed long"
    log_dq(wh, wh.spark.createDataFrame(checked, columns))
    written = checked[0].rows_tested
    register_table(wh, table, "silver", wh.path("silver", table), written, wh.read("silver", table).schema.json())
    return written


def _silver_job(wh: Warehouse, table: str, bronze: DataFrame, clean: Callable[[DataFrame], DataFrame], partition_cols=()):
    def body():
        location = wh.path("silver", table)
        if partition_cols:
            write_partitioned(clean(bronze), location, partition_cols)
        else:
            write_table(clean(bronze), location)
        return bronze.count(), _log_silver(wh, table)

    return _job(wh, S.RUN_NAMES[table], "silver", body)


def _stored_orders_job(wh: Warehouse, bronze: DataFrame) -> tuple[int, int]:
    """The silver job of orders that lie in files."""

    def body():
        silver.write_stored_orders(bronze, wh.path("silver", "orders"))
        return bronze.count(), _log_silver(wh, "orders")

    return _job(wh, S.RUN_NAMES["orders"], "silver", body)


def bronze_to_silver(wh: Warehouse, bronze_orders: DataFrame, bronze_customers: DataFrame, bronze_products: DataFrame, as_of=None,
                     stored: bool = True) -> None:
    """``stored``: the orders are a scan of files, which is cheap to read several times."""
    remove_path(wh.spark, wh.path("silver", "orders_kept"))  # the next incremental run starts it anew
    if stored:
        _stored_orders_job(wh, bronze_orders)
    else:
        _silver_job(wh, "orders", bronze_orders, silver.clean_orders, ("year", "month", "day"))
    _silver_job(wh, "customers", bronze_customers, lambda b: silver.clean_customers(b, as_of))
    _silver_job(wh, "products", bronze_products, silver.clean_products)


def order_footers(wh: Warehouse) -> FooterRegister:
    """The register of the landed order files' footers."""
    return FooterRegister(wh.spark, wh.path("bronze", "orders"), wh.path("meta", "order_footers"))


def landed_orders(wh: Warehouse, since: str | None = None, before: str | None = None) -> DataFrame:
    """Bronze orders by landing folder: from ``since`` on, or ``before`` a date; files without one are in both.

    Only the files of those folders are read, and only footers that no earlier run has registered."""

    def number(date: str | None) -> int | None:
        return None if date is None else int(date.replace("-", ""))

    return order_footers(wh).read(S.BRONZE_ORDERS, since=number(since), before=number(before))


def bronze_to_silver_incremental(wh: Warehouse, landed_since: str) -> list[int]:
    """Incremental SV1: merge the order files landed on or after ``landed_since``.

    Only the new landing folders are read, and of the kept table only the buckets that may hold their orders. The event days that they
    change are rewritten, and nothing else; the result equals a full rebuild, however late
    a copy lands (see ``incremental``). Returns the rewritten event days as yyyymmdd keys, 0
    standing for rows without a readable date.
    """
    kept, location = wh.path("silver", "orders_kept"), wh.path("silver", "orders")
    days: list[int] = []

    def body():
        if not KeptOrders(wh.spark, kept).exists():
            incremental.rebuild_kept(landed_orders(wh, before=landed_since), kept)
        fresh = landed_orders(wh, since=landed_since)
        mark = f"{_order_counts(wh)}_open"
        whole = path_exists(wh.spark, mark)  # an earlier run has died before its counts were stored
        write_mark(wh.spark, mark)
        days.extend(incremental.merge_orders(fresh, kept, location))
        written = _log_silver(wh, "orders", None if whole else days)
        remove_path(wh.spark, mark)
        return fresh.count(), written

    try:
        _job(wh, S.RUN_NAMES["orders"] + "_incremental", "silver", body)
    finally:
        flush_catalog(wh)
    return days


def silver_to_gold_incremental(wh: Warehouse, days: list[int], as_of=None, vip_over=S.VIP_OVER,
                               premium_over=S.PREMIUM_OVER) -> None:
    """Gold after an incremental silver run that rewrote ``days`` (yyyymmdd, 0 for no date):

    * daily_sales and the customer sketches: the touched days are recomputed from a pruned read and take the place of
      their old rows, also where nothing is left of a day;
    * product_performance: the touched months are recomputed and their ``period``
      folders replaced, those without rows removed;
    * customer_segments depends on ``as_of`` for every customer, so it is rebuilt in full.
    """
    if not days:
        return
    spark = wh.spark
    orders = wh.read("silver", "orders")
    months = sorted({k // 100 for k in days})
    touched = orders.filter(incremental.day_key().isin(days))
    part = orders.filter(F.floor(incremental.day_key() / 100).cast("long").isin(months))

    def daily_body():
        stored = wh.read("gold", "daily_customers")
        kept = stored.filter(~F.coalesce(F.date_format("date", "yyyyMMdd").cast("int"), F.lit(0)).isin(days))
        replace_table(kept.unionByName(gold.daily_customers(touched)), wh.path("gold", "daily_customers"))
        current = wh.read("gold", "daily_sales")
        date = F.coalesce(F.date_format("date", "yyyyMMdd").cast("int"), F.lit(0))
        untouched = current.filter(~date.isin(days))
        replace_table(untouched.unionByName(gold.daily_sales(touched).select(*current.columns)), wh.path("gold", "daily_sales"))
        return touched.filter(F.col("status") == "completed").count(), _register(wh, "daily_sales")

    def perf_body():
        root = wh.path("gold", "product_performance")
        _write_performance(wh, part, dynamic=True)
        left = {r[0] for r in part.select(incremental.day_key().alias("k")).distinct().collect()}  # a number a day
        gone = set(months) - {k // 100 for k in left}
        drop_partitions(spark, root, [{"period": f"{m // 100:04d}-{m % 100:02d}" if m else None} for m in gone])
        return part.count(), _register(wh, "product_performance", False)

    _job(wh, S.RUN_NAMES["daily_sales"] + "_incremental", "gold", daily_body)
    _job(wh, S.RUN_NAMES["product_performance"] + "_incremental", "gold", perf_body)
    _gold_job(
        wh, "customer_segments", orders.count,
        lambda: gold.customer_segments(orders, wh.read("silver", "customers"), as_of, vip_over, premium_over),
    )
    flush_catalog(wh)


def _register(wh: Warehouse, table: str, infer: bool = True) -> int:
    """Count a committed gold table (Parquet footers) and queue its catalog entry."""
    now = wh.read("gold", table, infer)
    rows = now.count()
    register_table(wh, table, "gold", wh.path("gold", table), rows, now.schema.json())
    return rows


def _gold_job(wh: Warehouse, table: str, read_rows: Callable[[], int], build: Callable[[], DataFrame]):
    def body():
        write_table(build(), wh.path("gold", table))
        return read_rows(), _register(wh, table)

    return _job(wh, S.RUN_NAMES[table], "gold", body)


def _write_performance(wh: Warehouse, orders: DataFrame, dynamic: bool = False) -> None:
    """product_performance by period: dealt out for the write before the names of the products are joined, if these can be broadcast."""
    products, root = wh.read("silver", "products"), wh.path("gold", "product_performance")
    if products.count() <= BROADCAST_ROWS:  # from Parquet footers
        write_spread(gold.product_performance(orders, products, by_period=True), root, ["period"], dynamic)
    else:
        write_partitioned(gold.product_performance(orders, products), root, ["period"], dynamic=dynamic)


def silver_to_gold(wh: Warehouse, as_of=None, vip_over=S.VIP_OVER, premium_over=S.PREMIUM_OVER) -> None:
    # one read (one partition listing) of silver orders, shared by the jobs
    orders = wh.read("silver", "orders")
    completed = lambda: orders.filter(F.col("status") == "completed").count()
    _gold_job(wh, "daily_sales", completed, lambda: gold.daily_sales(orders))
    write_table(gold.daily_customers(orders), wh.path("gold", "daily_customers"))

    def performance():
        _write_performance(wh, orders)
        return orders.count(), _register(wh, "product_performance", False)

    _job(wh, S.RUN_NAMES["product_performance"], "gold", performance)
    _gold_job(
        wh, "customer_segments", orders.count,
        lambda: gold.customer_segments(orders, wh.read("silver", "customers"), as_of, vip_over, premium_over),
    )


def build_models(wh: Warehouse) -> None:
    """SNK7: materialise the three gold models (create or replace); customer_ltv is laid out for lookups by customer."""
    for name, build in (
        ("revenue_trends", lambda: models.revenue_trends(wh.read("gold", "daily_sales"))),
        ("top_products", lambda: models.top_products(wh.read("gold", "product_performance", False), stored=True)),
        ("customer_ltv", lambda: models.customer_ltv(wh.read("gold", "customer_segments"), stored=True)),
    ):
        if name == "customer_ltv":
            write_clustered(build(), wh.path("gold", name), "customer_id")
        else:
            write_table(build(), wh.path("gold", name))
        _register(wh, name, name != "top_products")


def land_bronze(wh: Warehouse, bronze_orders: DataFrame, bronze_customers: DataFrame, bronze_products: DataFrame,
                snapshot: str = "current", dealt: bool = False) -> None:
    """Land the three feeds as files, laid out as the ingestion writes them:
    orders under year=/month=/day= folders, customers and products as
    snapshot files. ``dealt``: the orders of a day come from few tasks already, so they are not shuffled for the write."""
    dated = bronze_orders.withColumns(
        {
            "year": F.year(F.try_to_timestamp("created_at")),
            "month": F.month(F.try_to_timestamp("created_at")),
            "day": F.dayofmonth(F.try_to_timestamp("created_at")),
        }
    )
    write = write_spread if dealt else write_partitioned
    write(dated, wh.path("bronze", "orders"), ["year", "month", "day"])
    write_table(bronze_customers, wh.path("bronze", f"customers/snapshot_{snapshot}.parquet"))
    write_table(bronze_products, wh.path("bronze", f"products/snapshot_{snapshot}.parquet"))


def read_orders(wh: Warehouse, keep_landing: bool = False) -> DataFrame:
    """SRC1: all landed order files, whatever numeric types or missing columns their footers have.

    Orders are read at the table root rather than by a year=*/month=*/day=* leaf glob, which
    Spark would expand level by level on the driver. The landing-date partition columns are
    kept under other names (``keep_landing``) so that a filter on them prunes folders; silver derives its own
    year/month/day from event time.
    """
    landing = ["year", "month", "day"] if keep_landing else []
    landed = order_footers(wh).read(S.BRONZE_ORDERS, landing)
    return landed.withColumnsRenamed({c: f"_landed_{c}" for c in landing})


def read_bronze(wh: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC1-SRC3: the order files and all snapshots at once, cast to the bronze schemas."""
    customers = read_drifting(wh.spark, wh.path("bronze", "customers"), S.BRONZE_CUSTOMERS)
    products = read_drifting(wh.spark, wh.path("bronze", "products"), S.BRONZE_PRODUCTS)
    return read_orders(wh), customers, products


def run_all(wh: Warehouse, bronze_orders: DataFrame, bronze_customers: DataFrame, bronze_products: DataFrame,
            as_of=None, vip_over=S.VIP_OVER, premium_over=S.PREMIUM_OVER, land: bool = True, dealt: bool = False) -> Warehouse:
    """The whole batch pipeline.  With ``land=True`` the feeds are first
    landed as files and the silver jobs read them back (the production path); ``dealt`` as in ``land_bronze``."""
    if land:
        land_bronze(wh, bronze_orders, bronze_customers, bronze_products, dealt=dealt)
        bronze_orders, bronze_customers, bronze_products = read_bronze(wh)
    try:
        bronze_to_silver(wh, bronze_orders, bronze_customers, bronze_products, as_of, stored=land)
        flush_catalog(wh)
        silver_to_gold(wh, as_of, vip_over, premium_over)
        build_models(wh)
    finally:
        flush_catalog(wh)  # completed jobs are catalogued even if a later one fails
    return wh


__all__ = ["Warehouse", "land_bronze", "read_bronze", "bronze_to_silver", "silver_to_gold", "build_models", "run_all"]
