"""ST2 with state: day windows over the silver orders, kept as mergeable partial sums.

``stream_day_windows`` follows the files of the silver table. The state store holds, for each
calendar day and category, counts, sums and a distinct sketch of the customers; what a
micro-batch changed is upserted by key into a small table of partials. No row of silver is read twice
for them.

* The silver table exchanges whole days. All files of one exchange share the id of the job that wrote them, so the
  partials are kept by (day, *generation*), and the newest generation of a day counts. A rewritten day
  therefore replaces its old figures, and nothing has to be subtracted.
* The watermark runs over the time of arrival, not over event time: however old an order is, it is
  never late. State that has not grown for ``horizon`` is dropped; files of the same generation that come
  later open new state, whose partials add to the stored ones.
* Counts, sums and top categories are exact at any time. Distinct customers are the sketch's estimate until
  ``close_days`` counts them from a read of just the days that have a new generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.plans.incremental import day_key
from ledgerflow.session import scratch_path
from ledgerflow.sinks import latest_version, list_days, prune_versions, write_version

#: What identifies a partial.
KEY = ["arrived", "date", "category", "generation"]


def written_by(file_name: str = "file") -> Column:
    """The job that wrote a Spark part file: the id in its name."""
    return F.regexp_extract(file_name, r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)


def date_key(date: str = "date") -> Column:
    """yyyymmdd of a date as a number; 0 for none (as ``day_key`` of the folders)."""
    return F.coalesce(F.date_format(date, "yyyyMMdd").cast("int"), F.lit(0))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def _newest(parts: DataFrame) -> DataFrame:
    """The partials of each day's newest generation."""
    newest = F.max(F.struct("written", "generation")).over(Window.partitionBy("date"))
    return parts.withColumn("newest", newest).where("generation = newest.generation").drop("newest")


def partials(rows: DataFrame) -> DataFrame:
    """Counts, sums and customer sketches of completed orders by ``KEY``; ``rows`` may be a stream."""
    done = F.col("status") == "completed"
    amount = F.when(done, F.col("total_amount"))
    return rows.groupBy(F.window("arrived", "1 day").alias("arrived"), "date", "category", "generation").agg(
        F.count_if(done).alias("orders"),
        F.sum(amount).alias("sold"),
        F.count(amount).alias("priced"),
        F.hll_sketch_agg(F.when(done, F.col("customer_id"))).alias("customers"),
        F.max("written").alias("written"),
    )


def stream_day_windows(
    spark: SparkSession,
    silver_src: str,
    dst: str,
    checkpoint: str,
    silver_schema: T.StructType,
    horizon: str = "7 days",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Follow the silver orders with the table of partials under ``dst`` (``availableNow``, versioned by epoch)."""
    reader = spark.readStream.schema(silver_schema).option("basePath", silver_src)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(silver_src).select(
        F.to_date("created_at").alias("date"), "category", "customer_id", "total_amount", "status",
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("written"),
    )
    rows = rows.withColumn("generation", written_by()).drop("file").withColumn("arrived", F.current_timestamp())
    changed = partials(rows.withWatermark("arrived", horizon)).withColumn("arrived", F.col("arrived.start"))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        path = scratch_path(session, "window-changes")
        batch.write.parquet(path)  # the state is computed once
        fresh = session.read.schema(batch.schema).parquet(path)
        current = latest_version(session, dst, before=epoch_id, prefix="epoch=")
        if current is not None:
            old = session.read.parquet(current)
            fresh = old.join(fresh, _same(old, fresh, KEY), "left_anti").unionByName(fresh)
        write_version(_newest(fresh), dst, epoch_id, prefix="epoch=")
        prune_versions(session, dst, prefix="epoch=")

    query = changed.writeStream.outputMode("update").foreachBatch(merge)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_partials(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest committed partials (None before the first micro-batch)."""
    path = latest_version(spark, root, prefix="epoch=")
    return None if path is None else _newest(spark.read.parquet(path))


def day_figures(parts: DataFrame) -> DataFrame:
    """daily_sales from the partials alone; ``unique_customers`` is the sketches' estimate. Orders without a date have no top category, as there."""
    sold = parts.groupBy("date", "category").agg(
        F.sum("orders").alias("orders"), F.sum("sold").cast("decimal(24,2)").alias("sold"), F.sum("priced").alias("priced"),
        F.hll_union_agg("customers").alias("customers"),
    )
    place = F.struct((-F.col("sold")).alias("minus"), F.col("category").isNull().alias("nameless"), F.col("category").alias("name"))
    total = F.sum("sold").cast("decimal(24,2)")
    return (
        sold.where("orders > 0")
        .groupBy("date")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.round(total, 2).alias("total_revenue"),
            F.round(total / F.sum("priced").cast("decimal(20,0)"), 2).alias("avg_order"),
            F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"),
            F.when(F.col("date").isNotNull(), F.min(place).getField("name")).alias("top_category"),
        )
    )


def close_days(spark: SparkSession, windows: str, silver_src: str, closed: str, silver_schema: T.StructType, before: int | None = None) -> list[int]:
    """Count the customers of the days exactly whose newest generation has not been counted; returns those days.

    ``before`` (yyyymmdd) leaves that day and later ones open. Only the folders of the returned days are read, and of
    them two columns; one number a day comes to the driver. The table under ``closed`` is versioned.
    """
    parts = read_partials(spark, windows)
    if parts is None:
        return []
    now = parts.select("date", "generation").distinct().withColumn("k", date_key())
    current = latest_version(spark, closed)
    done = None if current is None else spark.read.parquet(current)
    stale = now if done is None else now.join(done, ["k", "generation"], "left_anti")
    if before is not None:
        stale = stale.where(F.col("k") < before)
    there = set(list_days(spark, silver_src))
    days = sorted(r.k for r in stale.select("k").collect() if r.k in there)
    if not days:
        return []
    rows = spark.read.schema(silver_schema).option("basePath", silver_src).parquet(silver_src).where(day_key().isin(days))
    counted = rows.where("status = 'completed'").groupBy(day_key().alias("k")).agg(F.count_distinct("customer_id").alias("exact"))
    fresh = now.where(F.col("k").isin(days)).select("k", "generation").join(counted, "k", "left")
    if done is not None:
        fresh = done.where(~F.col("k").isin(days)).unionByName(fresh)
    write_version(fresh, closed, 0 if current is None else int(current.rsplit("=", 1)[1]) + 1)
    prune_versions(spark, closed)
    return days


def daily_figures(spark: SparkSession, windows: str, silver_src: str, closed: str) -> DataFrame:
    """daily_sales as of now: exact for closed days, the estimate of distinct customers for the others.

    A day whose folder has left the silver table is left out (a listing of the day folders, no scan).
    """
    parts = read_partials(spark, windows)
    live = day_figures(parts).withColumn("k", date_key()).where(F.col("k").isin(list_days(spark, silver_src)))
    current = latest_version(spark, closed)
    if current is None:
        return live.drop("k")
    newest = parts.select(date_key().alias("k"), "generation").distinct()
    exact = spark.read.parquet(current).join(newest, ["k", "generation"]).select("k", "exact")
    out = live.join(exact, "k", "left").withColumn("unique_customers", F.coalesce("exact", "unique_customers"))
    return out.select("date", "total_orders", "total_revenue", "avg_order", "unique_customers", "top_category")
