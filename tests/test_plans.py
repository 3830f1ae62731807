"""Plan-shape and invariant checks (scale properties, not just values)."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.operators import quality
from ledgerflow.operators.ranking import By, _inside, _order_keys, narrowed, ntile_columns, ntile_global, rank_within
from ledgerflow.plans import registry
from ledgerflow.sinks import write_clustered


def _final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_dedupe_trims_hot_keys_before_shuffle(spark):
    L = registry.Lineage(spark, SF_SMALL)
    plan = L.orders()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _single_partition_inputs(node, found):
    """What feeds each exchange to a single partition, anywhere in a plan (through adaptive stages and subqueries)."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return _single_partition_inputs(node.executedPlan(), found)
    if name.endswith("QueryStage"):
        return _single_partition_inputs(node.plan(), found)
    children = [node.children().apply(i) for i in range(node.children().size())]
    if name == "ReusedExchange":
        children = [node.child()]
    if name == "Exchange" and "SinglePartition" in node.outputPartitioning().toString():
        found.append(children[0])
    subqueries = node.subqueries()
    for c in children + [subqueries.apply(i) for i in range(subqueries.size())]:
        if c.nodeName() in ("Subquery", "ReusedSubquery"):
            c = c.child()
        _single_partition_inputs(c, found)
    return found


def _makes_few_rows(node):
    """Whether a plan node is an aggregate, or only renames, filters or sorts the rows of one."""
    name = node.nodeName()
    if name.endswith("Aggregate"):
        return True
    passes = ("Project", "Filter", "Sort", "WholeStageCodegen", "InputAdapter", "AQEShuffleRead", "AdaptiveSparkPlan", "Exchange", "Window", "Subquery")
    if name.endswith("QueryStage"):
        return _makes_few_rows(node.plan())
    return name.startswith(passes) and _makes_few_rows(node.executedPlan() if name == "AdaptiveSparkPlan" else node.children().apply(0))


def test_ltv_has_no_single_partition_over_customers(spark):
    df = registry.Lineage(spark, SF_SMALL).customer_ltv()
    df.collect()
    found = _single_partition_inputs(df._jdf.queryExecution().executedPlan(), [])
    # a single partition only ever holds the counts of the slices, or a subquery's one row of cuts
    assert found and all(_makes_few_rows(node) for node in found), [node.toString()[:500] for node in found]
    bad = df.withColumn("r", F.row_number().over(Window.orderBy("customer_id")))
    bad.collect()
    assert not all(_makes_few_rows(n) for n in _single_partition_inputs(bad._jdf.queryExecution().executedPlan(), []))


def test_quartiles_of_one_hot_day(spark):
    """Every row on one day, a third of them at one instant, some null: no window over the day, same result as the built-in."""
    rows = 60_000
    instant = F.expr("timestamp_micros(946684800000000 + pmod(xxhash64(id), 3000000000))")
    at = F.when(F.col("id") % 3 == 0, F.lit("2000-01-01 12:00:00").cast("timestamp")).when(F.col("id") % 7 != 1, instant)
    paid, score = F.expr("cast(pmod(xxhash64(id, 1), 9000) / 100 as decimal(18,2))"), F.expr("pmod(xxhash64(id, 2), 1000) / 7")
    path = spark.conf.get("spark.checkpoint.dir") + "/hot_day"
    spark.range(rows).select("id", at.alias("at"), paid.alias("paid"), score.alias("score")).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    orders = [(By("at", True, False), "q_at"), (By("paid"), "q_paid"), (By("score", False), "q_score")]
    got = ntile_columns(df, 4, orders, "id").select("id", "q_at", "q_paid", "q_score")
    by = {"q_at": F.col("at").desc_nulls_last(), "q_paid": F.col("paid").desc_nulls_first(), "q_score": F.col("score").asc_nulls_first()}
    want = df.select("id", *[F.ntile(4).over(Window.orderBy(o, "id")).alias(c) for c, o in by.items()])
    assert got.exceptAll(want).count() == 0 and got.count() == rows
    keyed = _order_keys(df, [orders[0][0]], "id")
    left = {n: [r.n for r in _inside(keyed, narrowed(keyed, 4, n)).groupBy("lo").agg(F.count_distinct("k").alias("n")).collect()] for n in (0, 1)}
    assert max(left[0]) > rows / 3 and max(left[1]) < rows / 500  # values that one task looks at


def _scanned(df):
    """(rows found, rows that the Parquet scan decoded)."""
    found = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().apply(0)
    return found, node.metrics().apply("numOutputRows").value()


def test_lookup_in_a_clustered_table_reads_one_row_group(spark):
    path, rows = spark.conf.get("spark.checkpoint.dir") + "/clustered", 120_000
    ids = spark.range(0, 2 * rows, 2).select(F.col("id").alias("customer_id"), F.md5(F.col("id").cast("string")).alias("x"))
    nobody = ids.limit(1).withColumn("customer_id", F.lit(None).cast("long"))
    write_clustered(ids.orderBy(F.rand(1)).unionByName(nobody), path, "customer_id", row_group_mb=1)
    table = spark.read.parquet(path)
    assert table.count() == rows + 1
    for key in (0, 1234, rows, 2 * rows - 2):
        found, decoded = _scanned(table.where(F.col("customer_id") == key))
        assert found == 1 and decoded <= 30_000  # one of at least five row groups
    # not there, though inside the range of a row group: its Bloom filter says so, and nothing is decoded
    assert [_scanned(table.where(F.col("customer_id") == key)) for key in (1235, 3 * rows)] == [(0, 0), (0, 0)]
    assert table.where("customer_id is null").count() == 1


def test_ntile_matches_builtin_with_ties(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([1, 2, 2, 3, 3, 3, None])) for i in range(997)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    ref = df.withColumn("q", F.ntile(4).over(Window.orderBy(F.col("v").desc_nulls_first(), F.col("id"))))
    ours = ntile_global(df, 4, By("v"), "id", "q")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.collect()))


def test_dq_is_one_pass(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    checks = {"a": F.col("x") > 0, "b": F.col("x") < 6, "c": F.col("id").isNotNull()}
    plan = _final_plan(quality.run_checks(df, "t", "silver", checks))
    assert plan.count("Range (") == 1


def test_status_filter_pushed_to_silver_scan(spark):
    from ledgerflow.operators import gold
    from ledgerflow.session import scratch_path

    path = scratch_path(spark, "pushdown")
    registry.Lineage(spark, SF_SMALL).orders().write.parquet(path)
    plan = _final_plan(gold.daily_sales(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed)]" in plan


def test_invariants(spark):
    L = registry.Lineage(spark, SF_SMALL)
    orders = L.orders()
    completed = orders.filter("status = 'completed'").count()
    assert L.daily_sales().agg(F.sum("total_orders")).first()[0] == completed
    perf_total = L.product_performance().agg(F.sum("revenue")).first()[0]
    assert perf_total == orders.agg(F.sum("total_amount")).first()[0]
    assert L.customer_segments().count() == L.customers().count()
    ltv = L.customer_ltv()
    assert ltv.count() == L.customers().count()
    assert ltv.agg(F.min("rfm_score"), F.max("rfm_score")).first() >= (3, 3)
    assert isinstance(perf_total, Decimal)


def test_rank_within_matches_builtin_rank(spark):
    rnd = random.Random(11)
    # a large tie group, NULL groups and NULL values, numbers of every size, days, and a hot slice
    rows = [
        (i, rnd.choice(["a", "b", None]), rnd.choice([5] * 30 + [1, 2, None, -7]), rnd.uniform(-1e6, 1e6), dt.datetime(2024, 1, rnd.randint(1, 28), i % 24))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "id long, p string, v long, x double, t timestamp").repartition(5)
    df = df.withColumn("m", F.col("x").cast("decimal(14,2)"))
    for column in ("v", "x", "t", "m"):
        for pcols in (["p"], []):
            for desc in (True, False):
                order = F.col(column).desc_nulls_first() if desc else F.col(column).asc_nulls_last()
                ours = rank_within(df, pcols, By(column, desc, desc), "r")
                ref = df.withColumn("r", F.rank().over(Window.partitionBy(*pcols).orderBy(order)))
                assert sorted(map(str, ours.collect())) == sorted(map(str, ref.collect()))


def test_reports_read_gold_tables_with_pushed_filters(spark):
    qs = registry.all_queries()
    for name, wanted in (("report_customer_ltv", "EqualTo(customer_id,7)"), ("report_daily", "GreaterThanOrEqual(date"), ("report_top_products_period", "period")):
        plan = qs[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert wanted in plan and "lineitem" not in plan and "/gold/" in plan, name


def test_approx_distinct_is_opt_in_and_close(spark):
    from ledgerflow.operators import gold

    orders = registry.Lineage(spark, SF_SMALL).orders()
    exact = {r.date: r.unique_customers for r in gold.daily_sales(orders).collect()}
    approx = {r.date: r.unique_customers for r in gold.daily_sales(orders, approx_distinct=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(2, 0.1 * exact[d]) for d in exact)
    plan = gold.daily_sales(orders, approx_distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert "approx_count_distinct" in plan
