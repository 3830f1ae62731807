"""Incremental silver orders: only touched event days are rewritten, and the
result equals a full rebuild."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import order, orders_df
from ledgerflow.operators import silver
from ledgerflow.plans import incremental, jobs, registry
from ledgerflow.plans.metadata import Warehouse
from ledgerflow.session import scratch_path

CUT = "2001-07-01"


def _rows(df):
    return sorted(tuple(r) for r in df.drop("_ingested_at").collect())


def test_incremental_equals_full_rebuild(spark):
    L = registry.Lineage(spark, SF_SMALL)
    bronze = L.bronze_orders()
    wh = Warehouse(spark, scratch_path(spark, "incr-wh"))
    # first run: only the feed landed before the cut
    early = bronze.filter(F.col("created_at") < CUT)
    jobs.land_bronze(wh, early, L.bronze_customers(), L.bronze_products())
    jobs.bronze_to_silver(wh, *jobs.read_bronze(wh))
    before = wh.read("silver", "orders").filter(F.col("created_at") < "2001-06-01")
    kept = _rows(before)
    # later arrivals land in their own (new) day folders
    late = bronze.filter(F.col("created_at") >= CUT)
    jobs.write_partitioned(
        late.withColumns({
            "year": F.year(F.try_to_timestamp("created_at")),
            "month": F.month(F.try_to_timestamp("created_at")),
            "day": F.dayofmonth(F.try_to_timestamp("created_at")),
        }),
        wh.path("bronze", "orders"), ["year", "month", "day"], mode="append",
    )
    touched = jobs.bronze_to_silver_incremental(wh, CUT)
    assert touched and min(touched) >= 20010701
    got = wh.read("silver", "orders")
    assert _rows(got) == _rows(L.orders().withColumn("_ingested_at", F.lit(None)))
    assert _rows(got.filter(F.col("created_at") < "2001-06-01")) == kept  # untouched days unchanged
    runs = [r.pipeline_name for r in wh.read("meta", "pipeline_runs").collect()]
    assert "bronze_to_silver_orders_incremental" in runs
    cat = {(r.table_name, r.layer): r.row_count for r in wh.read_latest("meta", "table_catalog").collect()}
    assert cat[("orders", "silver")] == L.orders().count()


def test_incremental_gold_equals_full_rebuild(spark):
    from ledgerflow.sources import driver as D

    L = registry.Lineage(spark, SF_SMALL)
    bronze = L.bronze_orders()
    wh = Warehouse(spark, scratch_path(spark, "incr-gold-wh"))
    early = bronze.filter(F.col("created_at") < CUT)
    jobs.land_bronze(wh, early, L.bronze_customers(), L.bronze_products())
    jobs.bronze_to_silver(wh, *jobs.read_bronze(wh))
    jobs.silver_to_gold(wh, D.DRIVER_AS_OF)
    late = bronze.filter(F.col("created_at") >= CUT)
    jobs.write_partitioned(
        late.withColumns({
            "year": F.year(F.try_to_timestamp("created_at")),
            "month": F.month(F.try_to_timestamp("created_at")),
            "day": F.dayofmonth(F.try_to_timestamp("created_at")),
        }),
        wh.path("bronze", "orders"), ["year", "month", "day"], mode="append",
    )
    days = jobs.bronze_to_silver_incremental(wh, CUT)
    jobs.silver_to_gold_incremental(wh, days, D.DRIVER_AS_OF)
    assert _rows(wh.read("gold", "daily_sales")) == _rows(L.daily_sales())
    perf = wh.read("gold", "product_performance", False).select(*L.product_performance().columns)
    assert _rows(perf) == _rows(L.product_performance())


def _land(wh, rows, date):
    registry._land(rows, wh, date)


def _silver_after(spark, first, second, since="2024-03-01"):
    """(incremental silver, full rebuild, rewritten days) for orders landed in two steps."""
    wh = Warehouse(spark, scratch_path(spark, "incr-edge"))
    _land(wh, orders_df(spark, first), "2024-01-31")
    jobs._silver_job(wh, "orders", jobs.read_orders(wh), silver.clean_orders, ("year", "month", "day"))
    _land(wh, orders_df(spark, second), "2024-03-02")
    days = jobs.bronze_to_silver_incremental(wh, since)
    cols = [c for c in wh.read("silver", "orders").columns if c != "_ingested_at"]
    full = silver.clean_orders(jobs.read_orders(wh), ingested_at=False).select(*cols)
    return wh, _rows(wh.read("silver", "orders").select(*cols)), _rows(full), days


def test_orders_that_land_weeks_late_stay(spark):
    first = [order("a", created_at="2024-01-10T10:00:00+00:00"), order("late", created_at="2024-01-05T10:00:00+00:00")]
    second = [order("z", created_at="2024-01-10T11:00:00+00:00"), order("c", created_at="2024-01-05T12:00:00+00:00")]
    wh, got, full, days = _silver_after(spark, first, second)
    assert got == full and len(got) == 4 and days == [20240105, 20240110]
    # the same files again change nothing
    assert jobs.bronze_to_silver_incremental(wh, "2024-03-01") == []


def test_unreadable_dates_and_emptied_days(spark):
    first = [order("k", created_at="2024-01-10T10:00:00+00:00"), order("e", product_id=9, created_at="2024-01-11T10:00:00+00:00")]
    # "e" gets a copy that sorts first and is invalid: its day is empty afterwards; "n" has no date
    second = [order("e", product_id=1, quantity=0, created_at="2024-01-11T10:00:00+00:00"), order("n", created_at="some day")]
    wh, got, full, days = _silver_after(spark, first, second)
    assert got == full and sorted(r[0] for r in got) == ["k", "n"] and days == [0, 20240111]


def test_a_copy_that_moves_an_order_to_another_day(spark):
    first = [order("m", product_id=9, created_at="2024-01-10T10:00:00+00:00"), order("o", created_at="2024-01-10T10:00:00+00:00")]
    second = [order("m", product_id=1, created_at="2024-02-01T10:00:00+00:00")]
    wh, got, full, days = _silver_after(spark, first, second)
    assert got == full and days == [20240110, 20240201]


def test_only_invalid_orders_is_a_successful_run(spark):
    wh = Warehouse(spark, scratch_path(spark, "all-invalid"))
    bad = orders_df(spark, [order("a", quantity=0), order("b", quantity=-1)])
    jobs._silver_job(wh, "orders", bad, silver.clean_orders)
    run = wh.read("meta", "pipeline_runs").collect()
    assert [(r.status, r.rows_read, r.rows_written) for r in run] == [("success", 2, 0)]
    assert wh.read("meta", "dq_results").count() == 5


def test_a_failed_merge_is_repeated_without_loss(spark, monkeypatch):
    first = [order("a", product_id=9, created_at="2024-01-10T10:00:00+00:00")]
    second = [order("a", product_id=1, created_at="2024-01-12T10:00:00+00:00")]
    wh = Warehouse(spark, scratch_path(spark, "incr-retry"))
    _land(wh, orders_df(spark, first), "2024-01-31")
    jobs._silver_job(wh, "orders", jobs.read_orders(wh), silver.clean_orders, ("year", "month", "day"))
    _land(wh, orders_df(spark, second), "2024-03-02")
    whole = incremental._replace_days
    calls = []

    def fail_second(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        whole(*args)

    monkeypatch.setattr(incremental, "_replace_days", fail_second)
    try:
        jobs.bronze_to_silver_incremental(wh, "2024-03-01")
    except RuntimeError:
        pass
    monkeypatch.setattr(incremental, "_replace_days", whole)
    jobs.bronze_to_silver_incremental(wh, "2024-03-01")
    got = wh.read("silver", "orders").collect()
    assert [(r.order_id, r.product_id, r.day) for r in got] == [("a", 1, 12)]


def _bytes_read(df, folder):
    """Bytes of the files that the scans under ``folder`` opened, from the metrics of a plan that has run."""
    total = 0

    def walk(node):
        nonlocal total
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Scan") and folder in node.toString():
            total += node.metrics().apply("filesSize").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return total


def _size(path):
    import os

    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_batch_opens_only_buckets_that_may_hold_its_orders(spark):
    from ledgerflow.plans.kept import KeptOrders, choose

    root = scratch_path(spark, "kept")
    rows = orders_df(spark, [order("x")]).drop("order_id", "created_at")
    many = spark.range(200_000).crossJoin(rows).withColumn("order_id", F.concat(F.lit("o"), "id")).withColumn(
        "created_at", F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(F.pmod("id", F.lit(300)).cast("int"))
    )
    kept = KeptOrders(spark, root)
    kept.write_base(choose(many))
    # 0.1 % of the orders land: two are late copies
    batch = spark.createDataFrame([(f"new{i}",) for i in range(198)] + [("o5",), ("o77777",)], "order_id string")
    maybe = kept.may_hold(batch)
    index_bytes = _bytes_read(maybe, "index")
    assert {"o5", "o77777"} <= {r.order_id for r in maybe.collect()} and maybe.count() < 12
    stages = {}

    def stage(df, name):
        stages[name] = incremental._stage(df, name)
        return stages[name]

    found = kept.lookup(batch, stage)
    opened = _bytes_read(found, "/rows")
    assert sorted(r.order_id for r in found.collect()) == ["o5", "o77777"]
    whole = _size(f"{root}/base=0/rows")
    assert opened < 0.1 * whole, (opened, whole)
    print("kept table", whole, "opened", opened, "index", index_bytes)


def test_deltas_become_part_of_the_base(spark, monkeypatch):
    from ledgerflow.plans import kept as K

    monkeypatch.setattr(K, "DELTA_ROWS", 3)
    root = scratch_path(spark, "kept-deltas")
    ts = lambda day: F.to_timestamp(F.lit(f"2024-01-{day:02d}"))
    copy = lambda i, p, day: orders_df(spark, [order(i, product_id=p)]).withColumn("created_at", ts(day))
    table = K.KeptOrders(spark, root)
    assert not table.exists() and table.read().count() == 0
    for n, (i, p) in enumerate([("a", 5), ("b", 5), ("a", 4), ("c", 1), ("d", 1), ("a", 3)]):
        table.append(K.choose(copy(i, p, n + 1)))
    assert table._base() is not None and len(table._deltas(table._base())) <= 3
    assert sorted((r.order_id, r.product_id) for r in table.read().collect()) == [("a", 3), ("b", 5), ("c", 1), ("d", 1)]
    ids = spark.createDataFrame([("a",), ("c",), ("zz",)], "order_id string")
    assert sorted((r.order_id, r.product_id) for r in table.lookup(ids, incremental._stage).collect()) == [("a", 3), ("c", 1)]


def test_a_half_written_kept_table_does_not_count(spark, monkeypatch):
    first = [order("a", created_at="2024-01-10T10:00:00+00:00"), order("b", created_at="2024-01-11T10:00:00+00:00")]
    second = [order("c", created_at="2024-01-10T12:00:00+00:00")]
    wh = Warehouse(spark, scratch_path(spark, "incr-half"))
    _land(wh, orders_df(spark, first), "2024-01-31")
    jobs._silver_job(wh, "orders", jobs.read_orders(wh), silver.clean_orders, ("year", "month", "day"))
    _land(wh, orders_df(spark, second), "2024-03-02")
    kept = wh.path("silver", "orders_kept")
    # what a run leaves that dies before its commit
    spark.range(1).write.parquet(f"{kept}/base=0/rows/_temporary/0")
    spark.range(1).write.parquet(f"{kept}/delta=4/_temporary/0")
    jobs.bronze_to_silver_incremental(wh, "2024-03-01")
    assert sorted(r.order_id for r in wh.read("silver", "orders").collect()) == ["a", "b", "c"]


def test_only_footers_of_new_files_are_opened(spark, monkeypatch):
    from ledgerflow.sources import register

    wh = Warehouse(spark, scratch_path(spark, "register"))
    opened = []
    whole = register.footer_schemas

    def counting(files):
        opened.append(files.count())
        return whole(files)

    monkeypatch.setattr(register, "footer_schemas", counting)
    _land(wh, orders_df(spark, [order("a"), order("b")]).coalesce(1), "2024-01-31")
    _land(wh, orders_df(spark, [order("c")]).coalesce(1), "2024-02-01")
    assert jobs.read_orders(wh).count() == 3
    _land(wh, orders_df(spark, [order("d")]).coalesce(1).withColumn("discount", F.lit(0)), "2024-03-02")
    fresh = jobs.landed_orders(wh, since="2024-03-01")
    assert [r.order_id for r in fresh.collect()] == ["d"]
    assert opened == [2, 1]
    assert jobs.landed_orders(wh, before="2024-02-01").count() == 2
    assert jobs.read_orders(wh).count() == 4 and opened == [2, 1, 0, 0]
    kinds = jobs.order_footers(wh).entries()
    assert kinds.count() == 3 and kinds.select("footer").distinct().count() == 2


def _dq(wh):
    log = wh.read("meta", "dq_results").where("table_name = 'orders'")
    last = log.agg({"run_at": "max"}).first()[0]
    rows = log.where(log.run_at == last).collect()
    return sorted((r.check_name, r.status, r.rows_tested, r.rows_failed) for r in rows)


def test_check_counts_are_kept_by_day(spark):
    from fixtures import customer, customers_df, order, orders_df, product, products_df
    from ledgerflow.operators import quality
    from ledgerflow.plans import jobs, registry
    from ledgerflow.plans.metadata import Warehouse
    from ledgerflow.session import scratch_path
    from ledgerflow.sinks import path_exists, write_mark

    def scan():
        found = quality.run_checks(wh.read("silver", "orders"), "orders", "silver", quality.orders_checks()).collect()
        return sorted((r.check_name, r.status, r.rows_tested, r.rows_failed) for r in found)

    wh = Warehouse(spark, scratch_path(spark, "dq-days"))
    rows = [order(f"a{i}", quantity=500 if i % 2 else 1, created_at=f"2024-01-{10 + i}T00:00:00+00:00") for i in range(6)]
    jobs.land_bronze(wh, orders_df(spark, [*rows, order("n", status="odd", created_at="?")]), customers_df(spark, [customer(1)]), products_df(spark, [product(1)]))
    jobs.bronze_to_silver(wh, *jobs.read_bronze(wh))
    assert _dq(wh) == scan()
    # a copy that moves a bad row to another day, and one that repairs the row without a date
    late = [order("a1", product_id=0, quantity=500, created_at="2024-01-20T00:00:00+00:00"), order("n", product_id=0, created_at="2024-01-10T00:00:00+00:00")]
    registry._land(orders_df(spark, late), wh, "2024-02-01")
    days = jobs.bronze_to_silver_incremental(wh, "2024-02-01")
    assert days == [0, 20240110, 20240111, 20240120] and _dq(wh) == scan()
    plan = jobs.touched_orders(wh, days)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*year.*20240110", plan)  # only the folders of those days are opened
    # a run that lands nothing takes the stored counts; a mark left by a dead run has everything counted anew
    assert jobs.bronze_to_silver_incremental(wh, "2024-03-01") == [] and _dq(wh) == scan()
    counts = jobs._order_counts(wh)
    wrong = spark.createDataFrame([(20240110, 99, 9, 9, 9, 9, 9)], "part int, rows_tested long, _f0 long, _f1 long, _f2 long, _f3 long, _f4 long")
    jobs.write_version(wrong, counts, 90)
    write_mark(spark, f"{counts}_open")
    jobs.bronze_to_silver_incremental(wh, "2024-03-01")
    assert _dq(wh) == scan() and not path_exists(spark, f"{counts}_open")


def test_customer_sketches_union_over_windows(spark):
    from fixtures import order, orders_df
    from ledgerflow.operators import gold, silver

    rows = [order(f"o{i}", customer_id=i % 7, created_at=f"2024-0{1 + i % 3}-{10 + i % 15}T00:00:00+00:00") for i in range(60)]
    rows += [order("n", created_at=None), order("x", customer_id=99, status="cancelled")]
    orders = silver.clean_orders(orders_df(spark, rows), ingested_at=False)
    got = {str(r.date): r.customers for r in gold.rolling_customers(gold.daily_customers(orders), 30).collect()}
    import datetime as dt

    done = {(dt.date.fromisoformat(r[12][:10]), r[1]) for r in rows if r[12] and r[7 + 3] == "completed"}
    want = {str(d): len({c for e, c in done if d - dt.timedelta(29) <= e <= d}) for d, _ in done}
    assert got == want
    none = silver.clean_orders(orders_df(spark, []), ingested_at=False)
    assert gold.rolling_customers(gold.daily_customers(none)).count() == 0


def test_a_merge_leaves_no_intermediate_tables(spark):
    import os

    from ledgerflow.session import checkpoint_root

    top = f"{checkpoint_root(spark).removeprefix('file://')}/tables"
    kept, out = scratch_path(spark, "t-clean-kept"), scratch_path(spark, "t-clean-silver")
    first, later = [order("a"), order("b")], [order("b", product_id=0), order("c", created_at="2024-02-01T00:00:00+00:00")]
    before = set(os.listdir(top))
    names = ("landed", "kept-maybe", "kept-before", "changed", "days")
    for n, rows in enumerate((first, later, later)):  # into nothing, with changes, without a change
        days = incremental.merge_orders(orders_df(spark, rows), kept, out)
        assert days == [[20240110], [20240110, 20240201], []][n]
        assert not [x for x in set(os.listdir(top)) - before if x.startswith(names)]
    want = silver.clean_orders(orders_df(spark, first + later), ingested_at=False)
    assert _rows(spark.read.parquet(out).select(*want.columns)) == _rows(want)
