"""ST1 / ST2 on literal arrivals: both follow what lands, whenever it lands."""

from pyspark.sql import functions as F

from fixtures import order, orders_df
from ledgerflow.operators import silver
from ledgerflow.session import scratch_path
from ledgerflow.streaming import close_days, daily_figures, latest_version, stream_clean_orders, stream_daily_sales, stream_day_windows, stream_deduped_orders


def _rows(df):
    cols = sorted(c for c in df.columns if c != "_ingested_at")
    return sorted(map(str, df.select(*cols).collect()))


def test_late_unique_orders_and_late_copies_are_merged(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("t-landing", "t-silver", "t-ck1"))
    first = [order("a", created_at="2024-02-10T10:00:00+00:00"), order("b", product_id=5, created_at="2024-02-10T11:00:00+00:00")]
    # weeks behind the newest event: a new order, a copy that wins, and one without a readable date
    late = [order("old", created_at="2024-01-01T10:00:00+00:00"), order("b", product_id=2, created_at="2024-01-02T11:00:00+00:00"), order("n", created_at="?")]
    orders_df(spark, first).coalesce(1).write.parquet(f"{landing}/1")
    stream_clean_orders(spark, landing, out, ck).awaitTermination()
    orders_df(spark, late).repartition(3).write.parquet(f"{landing}/2")
    stream_clean_orders(spark, landing, out, ck, max_files_per_trigger=1).awaitTermination()
    got = spark.read.parquet(out)
    assert _rows(got) == _rows(silver.clean_orders(orders_df(spark, first + late), ingested_at=False))
    assert got.where("order_id = 'b'").first().product_id == 2


def test_files_of_other_types_are_read(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("t-l2", "t-s2", "t-ck2"))
    rows = orders_df(spark, [order("a")])
    rows.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "discount", "total_amount")}).write.parquet(f"{landing}/1")
    orders_df(spark, [order("b")]).drop("country").write.parquet(f"{landing}/2")
    stream_clean_orders(spark, landing, out, ck).awaitTermination()
    got = {r.order_id: r for r in spark.read.parquet(out).collect()}
    assert got["a"].total_amount == got["b"].total_amount and got["b"].country is None and got["a"].country is not None


def test_a_hot_duplicate_group(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("t-hot-landing", "t-hot-out", "t-hot-ck"))
    rows = [order("hot")] * 5000 + [order(f"o{i}") for i in range(50)]
    orders_df(spark, rows).repartition(8).write.parquet(f"{landing}/1")
    stream_clean_orders(spark, landing, out, ck).awaitTermination()
    got = spark.read.parquet(out).groupBy("order_id").count().collect()
    assert len(got) == 51 and all(r["count"] == 1 for r in got)


def test_daily_sales_follow_touched_and_emptied_days(spark):
    root, gold_root, ck = (scratch_path(spark, n) for n in ("t-s3", "t-g3", "t-ck3"))
    day1 = [order("a", customer_id=1, created_at="2024-01-10T10:00:00+00:00"), order("b", customer_id=2, created_at="2024-01-11T10:00:00+00:00")]
    silver.clean_orders(orders_df(spark, day1)).write.partitionBy("year", "month", "day").parquet(root)
    schema = spark.read.parquet(root).schema
    stream_daily_sales(spark, root, gold_root, ck, schema).awaitTermination()
    # a late order for 2024-01-10 from a second customer in another category; 2024-01-11 loses its last order
    late = [order("c", customer_id=3, category="z", total_amount="50.00", created_at="2024-01-10T23:00:00+00:00")]
    silver.clean_orders(orders_df(spark, late)).write.mode("append").partitionBy("year", "month", "day").parquet(root)
    from ledgerflow.sinks import drop_partitions

    drop_partitions(spark, root, [{"year": 2024, "month": 1, "day": 11}])
    stream_daily_sales(spark, root, gold_root, ck, schema).awaitTermination()
    rows = spark.read.parquet(latest_version(spark, gold_root)).collect()
    assert [(str(r.date), r.total_orders, str(r.total_revenue), r.unique_customers, r.top_category) for r in rows] == [("2024-01-10", 2, "60.00", 2, "z")]


def _state(query):
    """Rows of state after the query's last micro-batch, and rows its batches dropped as known."""
    ops = [op for p in query.recentProgress for op in p["stateOperators"]]
    return ops[-1]["numRowsTotal"], sum(op["customMetrics"].get("numDroppedDuplicateRows", 0) for op in ops)


def test_state_drops_what_is_delivered_again_and_merges_the_rest(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("t-dd-landing", "t-dd-silver", "t-dd-ck"))
    first = [order("a", product_id=4), order("b"), order("b"), order("n", created_at=None), order(None)]
    orders_df(spark, first).coalesce(1).write.parquet(f"{landing}/1")
    query = stream_deduped_orders(spark, landing, out, ck)
    query.awaitTermination()
    assert _state(query) == (4, 1)
    # the same rows again, a copy that wins and moves the order to a day years back, and a new one
    later = [*first, order("a", product_id=2, created_at="1999-01-01T00:00:00+00:00"), order("c")]
    orders_df(spark, later).repartition(2).write.parquet(f"{landing}/2")
    query = stream_deduped_orders(spark, landing, out, ck)
    query.awaitTermination()
    assert _state(query) == (6, 5)
    assert _rows(spark.read.parquet(out)) == _rows(silver.clean_orders(orders_df(spark, first + later), ingested_at=False))


def test_copies_that_come_after_the_state_has_gone_are_merged(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("t-dh-landing", "t-dh-silver", "t-dh-ck"))
    sent = []
    for i, rows in enumerate([[order("a", product_id=4)], [order("b")], [order("a", product_id=4), order("a", product_id=1)], [order("c")]]):
        orders_df(spark, rows).coalesce(1).write.parquet(f"{landing}/{i}")
        query = stream_deduped_orders(spark, landing, out, ck, horizon="0 seconds")
        query.awaitTermination()
        sent += rows
    assert _state(query)[0] < len({str(r) for r in sent})  # what is older than the horizon has left the state
    assert _rows(spark.read.parquet(out)) == _rows(silver.clean_orders(orders_df(spark, sent), ingested_at=False))


def _figures(df):
    return sorted(map(str, df.select("date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category").collect()))


def test_day_windows_follow_exchanged_late_and_emptied_days(spark):
    from ledgerflow.operators.gold import daily_sales
    from ledgerflow.sinks import drop_partitions

    root, windows, closed, ck = (scratch_path(spark, n) for n in ("t-w-silver", "t-w", "t-w-closed", "t-w-ck"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:

        def land(rows):
            silver.clean_orders(orders_df(spark, rows)).write.mode("overwrite").partitionBy("year", "month", "day").parquet(root)

        def follow(before=None):
            stream_day_windows(spark, root, windows, ck, schema, max_files_per_trigger=2).awaitTermination()
            days = close_days(spark, windows, root, closed, schema, before)
            return days, _figures(daily_figures(spark, windows, root, closed))

        def now():
            return _figures(daily_sales(spark.read.schema(schema).option("basePath", root).parquet(root)))

        land(
            [order("a", customer_id=1), order("b", customer_id=2, category="z", total_amount="30.00"), order("c", customer_id=1, category=None)]
            + [order("d", created_at="2024-01-11T10:00:00+00:00"), order("e", created_at="2024-01-12T10:00:00+00:00"), order("n", created_at="?")]
            + [order("r", created_at="2024-01-13T10:00:00+00:00", status="refunded")]
        )
        schema = spark.read.parquet(root).schema
        days, got = follow(before=20240112)
        assert days == [0, 20240110, 20240111] and got == now()
        assert follow() == ([20240112, 20240113], now())
        assert follow() == ([], now())  # nothing new: nothing is read
        # one day is exchanged as a whole, one long ago is new, one loses its last completed order, one its folder
        land(
            [order("a", customer_id=1), order("x", customer_id=3, category="y", total_amount="99.00"), order("old", created_at="1999-05-05T00:00:00+00:00")]
            + [order("d", created_at="2024-01-11T10:00:00+00:00", status="cancelled")]
        )
        drop_partitions(spark, root, [{"year": 2024, "month": 1, "day": 12}])
        days, got = follow()
        assert days == [19990505, 20240110, 20240111] and got == now() and len(got) == 3
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_sketches_of_state_add_up(spark):
    from ledgerflow.streaming.windows import day_figures, partials

    rows = spark.range(60_000).selectExpr(
        "timestamp_seconds(id % 3 * 86400) as arrived", "date'2024-01-01' as date", "string(id % 7) as category", "'g' as generation", "'completed' as status",
        "cast(1.25 as decimal(14,2)) as total_amount", "id % 20000 as customer_id", "timestamp_seconds(id) as written",
    )
    got = day_figures(partials(rows)).first()
    assert (got.total_orders, str(got.total_revenue), str(got.avg_order), got.top_category) == (60_000, "75000.00", "1.25", "0")
    assert abs(got.unique_customers - 20_000) < 1_000


def test_a_stream_with_state_writes_few_files(spark):
    import glob

    landing, out, ck = (scratch_path(spark, n) for n in ("t-few-landing", "t-few-silver", "t-few-ck"))
    rows = [order(f"o{i}", created_at=f"2024-{i % 6 + 1:02d}-{i % 28 + 1:02d}T10:00:00+00:00") for i in range(4000)]
    orders_df(spark, rows).repartition(4).write.parquet(f"{landing}/1")
    stream_deduped_orders(spark, landing, out, ck).awaitTermination()
    days = len(glob.glob(f"{out}/*/*/*"))
    # not a file a day from each task, which is what a session without adaptive execution writes
    assert days == 84 and len(glob.glob(f"{out}/*/*/*/*.parquet")) < 2 * days
    assert _rows(spark.read.parquet(out)) == _rows(silver.clean_orders(orders_df(spark, rows), ingested_at=False))


def test_arrivals_are_written_by_the_tasks_that_make_their_rows(spark, monkeypatch):
    import glob

    from ledgerflow.plans import registry

    # half of them in the last month, which is delivered twice
    rows = [order(f"o{i}", created_at=f"{'2001-07' if i % 2 else '1999-03'}-{i % 28 + 1:02d}T10:00:00+00:00") for i in range(600)]
    bronze = orders_df(spark, rows).repartition(6)
    monkeypatch.setattr(registry.Lineage, "bronze_orders", lambda self: bronze)
    roots = {}

    def named(session, name):
        roots[name] = scratch_path(session, name)
        return roots[name]

    monkeypatch.setattr("ledgerflow.session.scratch_path", named)
    want = _rows(silver.clean_orders(bronze, ingested_at=False))
    for query, landing in ((registry._stream_clean, "landing"), (registry._stream_dedupe, "landing-dd")):
        assert _rows(query(spark, "")) == want
        # 6 tasks a file each, where a coalesce left 2 tasks for everything behind the write
        assert len(glob.glob(f"{roots[landing]}/arrival_1/*.parquet")) == 6
