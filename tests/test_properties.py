"""Property tests: operators against simple models on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators.ranking import By, ntile_global, rank_within
from ledgerflow.sinks import upsert

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.lists(st.integers(0, 30), unique=True, max_size=25)


@SETTINGS
@given(target_keys=keys, update_keys=keys, seed=st.integers(0, 1000))
def test_upsert_matches_model(spark, target_keys, update_keys, seed):
    target = [(k, f"t{k}", k * 10) for k in target_keys]
    updates = [(k, f"u{k}", k * 10 + seed) for k in update_keys]
    schema = "k long, name string, v long"
    got = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(updates, schema), ["k"], ["v"])
    model = {k: (k, n, v) for k, n, v in target}
    for k, n, v in updates:
        model[k] = (k, model[k][1], v) if k in model else (k, n, v)
    assert sorted(map(tuple, got.collect())) == sorted(model.values())


values = st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=0, max_size=60)


@SETTINGS
@given(vals=values, groups=st.integers(1, 3), buckets=st.integers(1, 5))
def test_ntile_and_rank_match_builtins(spark, vals, groups, buckets):
    rows = [(i, i % groups, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id long, g long, v long").repartition(3)
    order = F.col("v").desc_nulls_first()
    ref_n = df.withColumn("q", F.ntile(buckets).over(Window.orderBy(order, F.col("id"))))
    ours_n = ntile_global(df, buckets, By("v"), "id", "q")
    assert sorted(map(tuple, ours_n.collect())) == sorted(map(tuple, ref_n.collect()))
    ref_r = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(order)))
    ours_r = rank_within(df, ["g"], By("v"), "r")
    assert sorted(map(tuple, ours_r.collect())) == sorted(map(tuple, ref_r.collect()))
