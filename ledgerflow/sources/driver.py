"""Domain adapter: the driver's TPC-H-style tables presented as the bronze
orders / customers / products feeds the pipeline consumes.

Everything is a lazy DataFrame over the given parquet files, so the work of
every downstream query grows with the tables.  Customers and products are broadcast
if they have at most ``BROADCAST_ROWS`` rows (by Parquet footers), so the line items are not shuffled
for them; the other joins are left to the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.session import BROADCAST_ROWS

# ---------------------------------------------------------------------------
# ---------------------------------------------------------------------------
# line return flag -> raw bronze status (deliberately un-normalised)
STATUS_BY_FLAG = {"R": " Refunded", "A": "CANCELLED ", "N": "completed"}
# market segment -> bronze customer segment; others pass through as-is
SEGMENT_BY_MKT = {"AUTOMOBILE": "standard", "BUILDING": "premium", "FURNITURE": "vip"}
# product base price = (retail price - 900) * 8
PRICE_OFFSET = 900
PRICE_SCALE = 8
EMAIL_DOMAIN = "@example.com"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
# the date that stands in for "today" on the driver data (day after the last order)
DRIVER_AS_OF = "2001-08-02"
# segment thresholds scaled to the driver's price level
DRIVER_VIP_OVER = 1_000_000
DRIVER_PREMIUM_OVER = 600_000
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_map(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default if default is not None else col)


def _customer_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")


def small_dimensions(spark: SparkSession, sf_dir: str) -> bool:
    """Whether customers and products can be broadcast."""
    return all(table(spark, sf_dir, name).count() <= BROADCAST_ROWS for name in ("customer", "part"))


def bronze_orders(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """One bronze order row per line item (order_id = orderkey-linenumber).

    ``by_day`` (with small dimensions only): the rows of an order day come from as few tasks as their number allows, so they can be
    written by day without another shuffle. They are dealt out before the texts of customers and products are joined.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    cust = _customer_country(spark, sf_dir).select("c_custkey", "n_name")

    if small_dimensions(spark, sf_dir):
        fact = li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
        if by_day:
            fact = fact.withColumn("_day", F.to_date("o_orderdate")).hint("rebalance", "_day")
        fact = fact.join(F.broadcast(cust), fact.o_custkey == cust.c_custkey, "left")
        fact = fact.join(F.broadcast(part), fact.l_partkey == part.p_partkey, "left")
    else:
        head = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        fact = li.join(head, li.l_orderkey == head.o_orderkey, "left").join(part, li.l_partkey == part.p_partkey, "left")

    ext = F.col("l_extendedprice").cast(S.MONEY)
    qty = F.col("l_quantity").cast("long")
    disc = F.col("l_discount").cast(S.DISCOUNT)
    return fact.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.try_divide(ext, qty.cast("decimal(20,0)")).cast(S.MONEY).alias("unit_price"),
        qty.alias("quantity"),
        disc.alias("discount"),
        F.round(ext * (F.lit(1) - disc), 2).cast(S.MONEY).alias("total_amount"),
        F.col("n_name").alias("country"),
        _when_map(F.col("l_returnflag"), STATUS_BY_FLAG).alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.date_format("o_orderdate", ISO_FORMAT).alias("created_at"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer snapshot; joined_at = first order date (NULL if none)."""
    cust = _customer_country(spark, sf_dir)
    first = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    joined = cust.join(first, cust.c_custkey == first.o_custkey, "left")
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.col("n_name").alias("country"),
        _when_map(F.col("c_mktsegment"), SEGMENT_BY_MKT).alias("segment"),
        F.date_format("first_order", ISO_FORMAT).alias("joined_at"),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        ((F.col("p_retailprice").cast(S.MONEY) - F.lit(PRICE_OFFSET)) * F.lit(PRICE_SCALE)).cast(S.MONEY).alias("base_price"),
        F.lit(0).cast("long").alias("stock"),
        (F.col("p_size").cast("double") / F.lit(10.0)).alias("rating"),
        F.lit(0).cast("long").alias("review_count"),
    )
