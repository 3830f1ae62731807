"""Shuffles that follow the size of the table, and one shuffle for a dedupe and the partitioned write after it."""

import re
import time

import pytest
from pyspark.sql import functions as F

from fixtures import order, orders_df
from ledgerflow import session
from ledgerflow.operators import dedupe, silver
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writers

DAY = ["year", "month", "day"]
KEY = "spark.sql.shuffle.partitions"


def test_a_shuffle_is_as_wide_as_the_rows_need(spark):
    before = spark.conf.get(KEY)
    with pytest.raises(RuntimeError), session.shuffle_width(spark, 100 * session.ROWS_PER_TASK + 1):
        assert int(spark.conf.get(KEY)) == max(101, int(before))
        raise RuntimeError
    assert spark.conf.get(KEY) == before
    with session.shuffle_width(spark, 1):  # a larger configured width stays
        assert spark.conf.get(KEY) == before


def test_the_warehouse_is_built_with_that_width(spark, monkeypatch):
    from ledgerflow.plans import jobs, registry

    seen = []
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(registry, "_WAREHOUSES", {})
    monkeypatch.setattr(jobs, "run_all", lambda *a: seen.append(int(spark.conf.get(KEY))))
    registry.batch_warehouse(spark, "/root/testdata/sf0.001")
    assert seen[0] * 10 >= registry._feed_rows(spark, "/root/testdata/sf0.001") and seen[0] > 8


def _orders():
    at = [f"2024-01-{d:02d}T10:00:00+00:00" for d in range(1, 6)] + ["soon", None]
    rows = [order(f"o{i % 60}", product_id=i % 7, created_at=at[i % 60 % 7], quantity=i % 5) for i in range(200)]
    rows += [order(f"o{i}", product_id=i % 3, created_at=at[(i + 1) % 7]) for i in range(0, 60, 9)]  # copies on another day
    return rows + [order(None), order(None, created_at=None), order("o1", customer_id=None)]


@pytest.mark.parametrize(("task", "strays"), [(250_000, 1_000_000), (3, 1_000_000), (3, 0)])
def test_stored_orders_are_the_clean_orders(spark, monkeypatch, task, strays):
    monkeypatch.setattr(writers, "ROWS_PER_TASK", task)
    monkeypatch.setattr(dedupe, "MAX_STRAYS", strays)
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "stored")
    orders_df(spark, _orders()).repartition(4).write.parquet(landed)
    bronze = spark.read.parquet(landed)
    silver.write_stored_orders(bronze, out)
    want = silver.clean_orders(bronze, ingested_at=False)
    got = spark.read.parquet(out)
    assert set(got.columns) == {*want.columns, "_ingested_at"}
    key = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert key(got) == key(want) and len(key(want)) > 40


def test_dedupe_and_write_share_one_shuffle_that_splits_a_large_day(spark, monkeypatch):
    monkeypatch.setattr(writers, "ROWS_PER_TASK", 10)
    path = scratch_path(spark, "one-day")
    orders_df(spark, [order(f"o{i % 90}", product_id=i) for i in range(100)]).write.parquet(path)
    rows = silver.event_day(spark.read.parquet(path).withColumn("created_at", F.to_timestamp("created_at")))
    dealt = writers.spread(rows, DAY, "order_id")
    assert dealt.select("_block").distinct().count() > 5
    first = dedupe.keep_first(dealt, [*DAY, "_block", "order_id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert first.count() == 90


def test_the_kept_base_takes_any_copies_and_shuffles_rows_once(spark):
    from ledgerflow.plans.incremental import rebuild_kept
    from ledgerflow.plans.kept import KeptOrders, choose
    from ledgerflow.functions import parse_ts

    landed, root = scratch_path(spark, "landed-kept"), scratch_path(spark, "kept-base")
    orders_df(spark, _orders()).write.parquet(landed)
    bronze = spark.read.parquet(landed)
    rebuild_kept(bronze, root)
    want = choose(bronze.withColumn("created_at", parse_ts("created_at")))
    assert sorted(map(str, KeptOrders(spark, root).read().collect())) == sorted(map(str, want.collect()))
    base = spark.read.parquet(f"{root}/base=0/rows")
    assert base.count() == want.count()  # one copy an order id, not only when read


def _below(df, node):
    """The lines of the optimized plan under its first ``node``, which must be there."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:+\-]*", x).group()) for x in lines]
    top = next(i for i, x in enumerate(lines) if node in x)
    end = next((i for i in range(top + 1, len(lines)) if depth[i] <= depth[top]), len(lines))
    return "\n".join(lines[top:end])


def test_the_shuffle_files_of_a_job_go_at_its_end(spark, tmp_path):
    def held():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}

    jobs = []  # what is referred to is not collected as garbage
    with session.shuffle_width(spark, 1):
        before = held()
        for i in range(2):
            jobs.append(spark.range(1000).groupBy((F.col("id") % 7 + i).alias("k")).count())
            jobs[-1].hint("rebalance", "k").write.partitionBy("k").parquet(f"{tmp_path}/{i}")
        for _ in range(50):
            if not held() - before:
                break
            time.sleep(0.1)
        assert not held() - before


def test_a_large_advised_partition_is_made_smaller(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with session.settings(spark, {key: "1g"}):
        with session.shuffle_width(spark, 1):
            assert spark.conf.get(key) == f"{session.TASK_BYTES}b"
        assert spark.conf.get(key) == "1g"
    with session.settings(spark, {key: "1k"}), session.shuffle_width(spark, 1):
        assert spark.conf.get(key) == "1024b"


def test_orders_are_dealt_by_day_before_the_texts_are_joined(spark, monkeypatch):
    from ledgerflow.sources import driver

    sf = "/root/testdata/sf0.001"
    plain, dealt = driver.bronze_orders(spark, sf), driver.bronze_orders(spark, sf, by_day=True)
    below = _below(dealt, "RebalancePartitions")
    assert "l_orderkey" in below and "p_name" not in below and "n_name" not in below
    monkeypatch.setattr(driver, "BROADCAST_ROWS", 0)
    shuffled = driver.bronze_orders(spark, sf)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(dealt) == key(plain) == key(shuffled) and plain.columns == dealt.columns == shuffled.columns


def test_rolling_customers_are_exact_without_a_row_for_each_day_of_the_window(spark):
    from ledgerflow.operators import gold

    at = lambda d: f"2024-{d}T10:00:00+00:00"
    rows = [order(f"o{i}", customer_id=c, created_at=at(d)) for i, (c, d) in enumerate(
        [(1, "01-01"), (1, "01-01"), (1, "01-03"), (1, "02-20"), (2, "01-30"), (2, "01-31"), (3, "01-31"), (3, "03-15"), (4, "03-01")])]
    rows += [order("x", customer_id=9, status="cancelled"), order("y", customer_id=8, created_at=None), order("z", customer_id=1, created_at=at("12-31"))]
    orders = silver.clean_orders(orders_df(spark, rows), ingested_at=False)
    done = orders.where("status = 'completed'").select(F.to_date("created_at").alias("d"), "customer_id").distinct()
    for days in (1, 3, 30):
        every = done.select(F.explode(F.sequence("d", F.date_add("d", days - 1))).alias("date"), "customer_id")
        want = every.groupBy("date").agg(F.count_distinct("customer_id").alias("n")).join(done.select(F.col("d").alias("date")).distinct(), "date")
        got = gold.exact_rolling_customers(orders, days)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = gold.exact_rolling_customers(orders)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan


def test_product_performance_takes_names_after_its_shuffle(spark):
    from fixtures import product, products_df
    from ledgerflow.operators import gold

    orders = silver.clean_orders(orders_df(spark, _orders()), ingested_at=False)
    products = products_df(spark, [product(i) for i in (1, 2, 3, 3)])
    plain, dealt = (gold.product_performance(orders, products, by_period=b) for b in (False, True))
    assert "units_sold" in _below(dealt, "RebalancePartitions") and "base_price" not in _below(dealt, "RebalancePartitions")
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect())) and plain.columns == dealt.columns
