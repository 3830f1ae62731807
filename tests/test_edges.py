"""Edge semantics on literal fixtures (FIXTURES.md §4, E1-E23)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import customer, customers_df, order, orders_df, product, products_df
from ledgerflow import schemas as S
from ledgerflow.operators import gold, quality, silver
from ledgerflow.plans import models, reports
from ledgerflow.sinks import upsert

AS_OF = "2024-02-01"


def silver_orders(spark, rows):
    return silver.clean_orders(orders_df(spark, rows), ingested_at=False)


def test_e1_dedupe_runs_before_filters(spark):
    rows = [order("a", total_amount="0.00"), order("a", total_amount="10.00")]
    assert silver_orders(spark, rows).count() == 0


def test_e2_nulls_and_non_positive_dropped(spark):
    rows = [order("a", customer_id=None), order("b", unit_price=None), order("c", quantity=0), order("d")]
    assert [r.order_id for r in silver_orders(spark, rows).collect()] == ["d"]


def test_e3_status_normalised(spark):
    r = silver_orders(spark, [order("a", status=" Refunded ")]).collect()[0]
    assert r.status == "refunded" and r.is_refunded is True


def test_e4_null_status(spark):
    rows = [order("a", status=None), order("b", status="completed")]
    s = silver_orders(spark, rows)
    r = s.filter("order_id = 'a'").collect()[0]
    assert r.status is None and r.is_refunded is None
    dq = {x.check_name: x.rows_failed for x in quality.run_checks(s, "orders", "silver", quality.orders_checks()).collect()}
    assert dq["valid_status"] == 0  # a NULL predicate is not a failure
    assert gold.daily_sales(s).collect()[0].total_orders == 1
    segs = gold.customer_segments(s, silver.clean_customers(customers_df(spark, [customer(1)]), AS_OF), AS_OF)
    assert segs.collect()[0].order_count == 1  # NULL status excluded by `!= 'cancelled'`
    perf = gold.product_performance(s, silver.clean_products(products_df(spark, [product(1)])))
    assert perf.collect()[0].units_sold == 2  # all statuses


def test_e5_bad_timestamp_is_null(spark):
    r = silver_orders(spark, [order("a", created_at="garbage")]).collect()[0]
    assert r.created_at is None and r.year is None


def test_e6_dq_status_thresholds(spark):
    def status(n, failing):
        df = spark.range(n).withColumn("ok", F.col("id") >= failing)
        return quality.run_checks(df, "t", "silver", {"c": F.col("ok")}).collect()[0].status

    assert status(100, 1) == "fail"
    assert status(200, 1) == "warn"
    assert status(0, 0) == "pass"


def test_e7_price_tiers(spark):
    rows = [product(i, p) for i, p in enumerate(["49.99", "50", "200", "500"], 1)]
    tiers = {r.product_id: r.price_tier for r in silver.clean_products(products_df(spark, rows), False).collect()}
    assert tiers == {1: "budget", 2: "mid", 3: "premium", 4: "luxury"}


def _segments(spark, order_rows, customer_ids):
    o = silver_orders(spark, order_rows)
    c = silver.clean_customers(customers_df(spark, [customer(i) for i in customer_ids]), AS_OF, False)
    return {r.customer_id: r for r in gold.customer_segments(o, c, AS_OF).collect()}


def test_e8_e9_customer_snapshot_is_preserved_side(spark):
    segs = _segments(spark, [order("a", customer_id=1), order("b", customer_id=99)], [1, 2])
    assert set(segs) == {1, 2}  # 99 is not in the snapshot: dropped
    r = segs[2]
    assert (r.segment, r.total_spent, r.order_count, r.clv_score, r.last_order_at) == ("new", 0, 0, 0, None)


def test_e10_e11_clv_cap_when_ratio_is_null(spark):
    tomorrow = "2024-02-02T10:00:00+00:00"
    segs = _segments(spark, [order("a", customer_id=1, created_at="garbage"), order("b", customer_id=2, created_at=tomorrow)], [1, 2])
    assert segs[1].clv_score == Decimal("9999999.9999")
    assert segs[2].days_since_last == -1 and segs[2].clv_score == Decimal("9999999.9999")


def test_e12_strict_thresholds(spark):
    rows = [order("a", customer_id=1, total_amount="3000.00"), order("b", customer_id=2, total_amount="1000.00"),
            order("c", customer_id=2, total_amount="0.01", created_at="2024-01-01T00:00:00+00:00")]
    segs = _segments(spark, rows, [1, 2])
    assert segs[1].segment == "premium"
    assert segs[2].segment == "premium"  # 1000.01 > 1000
    segs = _segments(spark, [order("a", customer_id=3, total_amount="1000.00")], [3])
    assert segs[3].segment == "new"  # not > 1000, recent, one order


def _daily(spark, revenues):
    start = dt.date(2024, 1, 1)
    rows = []
    for i, rev in revenues:
        rows.append((start + dt.timedelta(days=i), 1, Decimal(rev), Decimal(rev), 1, "c"))
    schema = "date date, total_orders long, total_revenue decimal(25,2), avg_order decimal(25,2), unique_customers long, top_category string"
    return spark.createDataFrame(rows, schema)


def test_e13_e14_row_offsets_not_calendar(spark):
    days = [(i, "100.00") for i in range(31)]
    days[10] = (40, "100.00")  # one calendar gap: 31 rows, not 31 days
    days[0] = (0, "50.00")
    t = {r.date: r for r in models.revenue_trends(_daily(spark, days)).collect()}
    last = max(t)
    assert t[last].mom_growth_pct == Decimal("100.00")  # 30 ROWS back is the 50.00 day
    zero = [(i, "0.00" if i == 0 else "10.00") for i in range(31)]
    t = {r.date: r for r in models.revenue_trends(_daily(spark, zero)).collect()}
    assert t[max(t)].mom_growth_pct is None


def _perf(spark, rows):
    schema = ("product_id long, product_name string, category string, period string, units_sold long, "
              "revenue decimal(25,2), avg_price decimal(25,2), return_rate decimal(5,4)")
    return spark.createDataFrame(
        [(pid, name, cat, per, u, Decimal(rev), Decimal("1.00"), Decimal("0.1000")) for pid, name, cat, per, u, rev in rows], schema
    )


def test_e15_rank_ties(spark):
    perf = _perf(spark, [(1, "a", "c", "2024-01", 5, "10.00"), (2, "b", "c", "2024-01", 5, "10.00"), (3, "c", "c", "2024-01", 1, "5.00")])
    ranks = {r.product_id: (r.revenue_rank, r.volume_rank) for r in models.top_products(perf).collect()}
    assert ranks == {1: (1, 1), 2: (1, 1), 3: (3, 3)}


def test_e16_unknown_product(spark):
    o = silver_orders(spark, [order("a", product_id=7)])
    perf = gold.product_performance(o, silver.clean_products(products_df(spark, [product(1)]), False))
    r = perf.collect()[0]
    assert r.product_name is None and r.category is None
    fb = reports.top_products_fallback(perf).collect()[0]
    assert (fb.product_name, fb.category) == ("Unknown", "Unknown")


def _ltv_input(spark, rows):
    schema = "customer_id long, segment string, total_spent decimal(25,2), order_count long, last_order_at timestamp, clv_score decimal(16,4)"
    return spark.createDataFrame(rows, schema)


def test_e17_quartile_sizes(spark):
    rows = [(i, "regular", Decimal(100 * i), i, dt.datetime(2024, 1, i), Decimal(1)) for i in range(1, 7)]
    ltv = models.customer_ltv(_ltv_input(spark, rows))
    sizes = sorted(ltv.groupBy("monetary_quartile").count().collect())
    assert [r["count"] for r in sizes] == [2, 2, 1, 1]
    # DESC order: the largest spender is in quartile 1
    assert {r.customer_id: r.monetary_quartile for r in ltv.collect()}[6] == 1


def test_e18_e19_null_recency_last_and_zero_orders(spark):
    rows = [(i, "regular", Decimal(10), 1, dt.datetime(2024, 1, i), Decimal(1)) for i in range(1, 4)]
    rows.append((9, "new", Decimal(0), 0, None, Decimal(0)))
    ltv = {r.customer_id: r for r in models.customer_ltv(_ltv_input(spark, rows)).collect()}
    assert ltv[9].recency_quartile == 4  # NULLS LAST under DESC
    assert ltv[9].avg_order_value is None


def test_e20_empty_summary(spark):
    daily = _daily(spark, [])
    segs = spark.createDataFrame([], "customer_id long, segment string")
    r = reports.summary(daily, segs, AS_OF).collect()[0]
    assert (r.total_revenue, r.total_orders, r.avg_order_value, r.unique_customers) == (0, 0, 0, 0)
    assert (r.vip_customers, r.at_risk_customers) == (0, 0)


def test_e21_upsert(spark):
    schema = "k long, name string, v long"
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], schema)
    updates = spark.createDataFrame([(2, "B", 21), (3, "c", 30), (None, "m", 1)], schema)
    out = sorted(upsert(target, updates, ["k"], ["v"]).collect(), key=lambda r: (r.k is None, r.k or 0, r.name))
    assert [tuple(r) for r in out] == [(1, "a", 10), (2, "b", 21), (3, "c", 30), (None, "m", 1), (None, "n", 0)]


def test_e22_catalog_upsert_keeps_location(spark):
    from ledgerflow.plans.metadata import Warehouse, flush_catalog, register_table
    from ledgerflow.session import scratch_path

    wh = Warehouse(spark, scratch_path(spark, "wh-e22"))
    register_table(wh, "orders", "silver", "/first", 10)
    flush_catalog(wh)
    register_table(wh, "orders", "silver", "/second", 12)
    flush_catalog(wh)
    rows = wh.read_latest("meta", "table_catalog").collect()
    assert len(rows) == 1 and rows[0].location == "/first" and rows[0].row_count == 12


def test_e23_type_drift_read(spark):
    from ledgerflow.session import scratch_path
    from ledgerflow.sources.tables import read_drifting

    root = scratch_path(spark, "drift")
    spark.createDataFrame([(1, 0)], "id long, discount long").write.parquet(f"{root}/a")
    spark.createDataFrame([(2, 0.05)], "id long, discount double").write.parquet(f"{root}/b")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("discount", T.DoubleType())])
    got = sorted(tuple(r) for r in read_drifting(spark, root, target).collect())
    assert got == [(1, 0.0), (2, 0.05)]


def test_clv_is_exact(spark):
    # 1000.01 * 3 / (2 + 1) = 1000.01 exactly; rounding happens once
    rows = [order(f"o{i}", customer_id=1, total_amount=a, created_at="2024-01-30T00:00:00+00:00")
            for i, a in enumerate(["333.33", "333.34", "333.34"])]
    segs = _segments(spark, rows, [1])
    assert segs[1].clv_score == Decimal("1000.0100")


def test_schema_constants():
    assert S.ORDERS_DEDUPE_ORDER[0] == "product_id"


def test_md2_failed_job_is_logged_and_reraised(spark):
    import pytest

    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path

    wh = Warehouse(spark, scratch_path(spark, "wh-md2"))

    def body():
        raise ValueError("boom")

    with pytest.raises(ValueError):
        jobs._job(wh, "bronze_to_silver_orders", "silver", body)
    r = wh.read("meta", "pipeline_runs").collect()[0]
    assert (r.status, r.rows_read, r.rows_written) == ("failed", 0, 0) and "boom" in r.error_msg


def test_snk1_dynamic_overwrite_replaces_only_given_partitions(spark):
    from ledgerflow.session import scratch_path
    from ledgerflow.sinks import write_partitioned

    path = scratch_path(spark, "dyn")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "day int, v string"), path, ["day"])
    write_partitioned(spark.createDataFrame([(2, "B")], "day int, v string"), path, ["day"], dynamic=True)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("day", "v").collect()) == [(1, "a"), (2, "B")]
    write_partitioned(spark.createDataFrame([(3, "c")], "day int, v string"), path, ["day"])  # static: whole table
    assert [tuple(r) for r in spark.read.parquet(path).select("day", "v").collect()] == [(3, "c")]


def test_snk8_cap(spark):
    from ledgerflow.sinks import cap

    df = spark.createDataFrame([(None,), (5.0,), (2e9,)], "x double")
    assert [r[0] for r in df.select(cap("x", 999999999.9999)).collect()] == [0.0, 5.0, 999999999.9999]


def test_hot_duplicate_group_in_batch_dedupe(spark):
    # one order id holds a third of all rows; its copies differ in amount
    hot = [order("hot", total_amount=f"{10 + i % 97}.00") for i in range(3000)]
    rest = [order(f"o{i}") for i in range(6000)]
    df = orders_df(spark, hot + rest).repartition(16)
    out = silver.clean_orders(df, ingested_at=False)
    assert out.count() == 6001
    survivor = out.filter("order_id = 'hot'").collect()
    assert len(survivor) == 1 and survivor[0].total_amount == Decimal("10.00")  # first by the dedupe order
