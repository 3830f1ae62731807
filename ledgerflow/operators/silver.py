"""SV1-SV3: bronze -> silver cleaning, in the order the pipeline applies it.

Order matters: dedupe runs *before* the null drop and the positive-value
filters, so a duplicate whose kept copy is invalid removes the key entirely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.functions import as_of_date, normalize, parse_ts, price_tier
from ledgerflow.operators.dedupe import keep_first, split_strays
from ledgerflow.sinks import spread, write_partitioned, write_spread

DAY = ["year", "month", "day"]


def clean_orders(bronze: DataFrame, ingested_at: bool = True) -> DataFrame:
    """SV1.  ``revenue_net`` applies the discount to an amount that is already
    net of it (the source's behaviour, kept on purpose)."""
    df = bronze.withColumn("created_at", parse_ts("created_at"))
    df = keep_first(df, ["order_id"], S.ORDERS_DEDUPE_ORDER)
    return finish_orders(df, ingested_at)


def event_day(df: DataFrame) -> DataFrame:
    """The event day of every row, as the partition columns of silver."""
    return df.withColumns({"year": F.year("created_at"), "month": F.month("created_at"), "day": F.dayofmonth("created_at")})


def write_stored_orders(bronze: DataFrame, path: str) -> None:
    """SV1 of orders that lie in files, written by event day: ``clean_orders`` with one shuffle of whole rows instead of two.

    The copies of an order mostly have one event day, so one shuffle by day and block of order ids serves the
    dedupe and the partitioned write. Order ids with copies on several days are deduped by id; should there be too many of them,
    all are.
    """
    rows = event_day(bronze.withColumn("created_at", parse_ts("created_at")))
    day = F.coalesce(F.col("year") * 10000 + F.col("month") * 100 + F.col("day"), F.lit(0))
    parts = split_strays(rows, "order_id", day)
    if parts is None:
        return write_partitioned(clean_orders(bronze), path, DAY)
    home, astray = parts
    dealt = spread(home, DAY, "order_id")
    order = [c for c in bronze.columns if c != "order_id"]
    first = keep_first(dealt, [*DAY, "_block", "order_id"], [*S.ORDERS_DEDUPE_ORDER, *order]).drop("_block")
    out = finish_orders(first)
    if astray is not None:
        moved = finish_orders(keep_first(astray.drop(*DAY), ["order_id"], S.ORDERS_DEDUPE_ORDER))
        out = out.unionByName(moved.hint("rebalance", *DAY))
    write_spread(out, path, DAY)


def finish_orders(deduped: DataFrame, ingested_at: bool = True) -> DataFrame:
    """The SV1 steps after the dedupe (shared with the streaming job); an event day that ``deduped`` has is kept."""
    df = deduped.dropna(how="any", subset=["order_id", "customer_id", "product_id"])
    df = df.filter((F.col("unit_price") > 0) & (F.col("quantity") > 0) & (F.col("total_amount") > 0))
    df = df.withColumn("status", normalize("status"))
    df = df.withColumns(
        {
            "revenue_net": F.round(F.col("total_amount") * (F.lit(1) - F.col("discount")), 2).cast(S.MONEY),
            "is_refunded": F.col("status") == F.lit("refunded"),
        }
    )
    df = event_day(df) if "year" not in deduped.columns else df.select(*[c for c in df.columns if c not in DAY], *DAY)
    if ingested_at:
        df = df.withColumn("_ingested_at", F.current_timestamp())
    return df


def clean_customers(bronze: DataFrame, as_of=None, ingested_at: bool = True) -> DataFrame:
    """SV2."""
    df = bronze.withColumn("joined_at", parse_ts("joined_at"))
    df = keep_first(df, ["customer_id"])
    df = df.dropna(how="any", subset=["customer_id", "email"])
    df = df.withColumns({"email": normalize("email"), "segment": normalize("segment")})
    df = df.withColumn("days_since_joined", F.datediff(as_of_date(as_of), F.to_date("joined_at")))
    if ingested_at:
        df = df.withColumn("_ingested_at", F.current_timestamp())
    return df


def clean_products(bronze: DataFrame, ingested_at: bool = True) -> DataFrame:
    """SV3."""
    df = keep_first(bronze, ["product_id"])
    df = df.dropna(how="any", subset=["product_id", "name"])
    df = df.filter(F.col("base_price") > 0)
    df = df.withColumn("price_tier", price_tier("base_price"))
    if ingested_at:
        df = df.withColumn("_ingested_at", F.current_timestamp())
    return df
