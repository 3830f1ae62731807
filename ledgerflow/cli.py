"""Job entry point for spark-submit.

    spark-submit ledgerflow/cli.py --warehouse <root> --stage all --as-of 2001-08-02
    spark-submit ledgerflow/cli.py --warehouse <root> --stage land --from-tables <dir>
    spark-submit ledgerflow/cli.py --warehouse <root> --stream clean --checkpoint <dir>

Stages: ``land`` (demo feeds from driver-style tables), ``silver``
(bronze files -> silver), ``silver-incremental`` (only the event days touched
by files landed since ``--since``, dynamic partition overwrite), ``incremental``
(that, then the touched gold days / months, segments and models), ``gold`` (silver -> gold aggregates), ``models``
(gold -> revenue_trends / top_products / customer_ltv), ``all`` (silver, gold,
models).  Streams: ``clean`` (ST1 over the landed order files into silver)
and ``daily`` (ST2 exact mode, silver -> gold daily_sales_stream).  Each
stream runs once over what is available (``availableNow``) and exits.  The
session (cluster, shuffle width, checkpoint folder) comes from spark-submit.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerflow import schemas as S  # noqa: E402


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerflow")
    p.add_argument("--warehouse", required=True, help="root folder of bronze/silver/gold/meta")
    p.add_argument("--stage", choices=["land", "silver", "silver-incremental", "incremental", "gold", "models", "all"])
    p.add_argument("--since", help="landing date from which files are new (stage silver-incremental)")
    p.add_argument("--stream", choices=["clean", "daily"])
    p.add_argument("--from-tables", help="driver-style table folder (stage land)")
    p.add_argument("--as-of", default=None, help="reference date (default: today)")
    p.add_argument("--vip-over", type=float, default=S.VIP_OVER)
    p.add_argument("--premium-over", type=float, default=S.PREMIUM_OVER)
    p.add_argument("--checkpoint", help="streaming checkpoint folder")
    args = p.parse_args(argv)
    if not args.stage and not args.stream:
        p.error("one of --stage or --stream is required")
    if args.stage == "land" and not args.from_tables:
        p.error("--stage land needs --from-tables")
    if args.stage in ("silver-incremental", "incremental") and not args.since:
        p.error(f"--stage {args.stage} needs --since")
    if args.stream and not args.checkpoint:
        p.error("--stream needs --checkpoint")
    return args


def main(argv=None, spark: SparkSession | None = None) -> None:
    from ledgerflow.plans import jobs
    from ledgerflow.plans.metadata import Warehouse, flush_catalog
    from ledgerflow.sources import driver
    from ledgerflow.streaming import stream_clean_orders, stream_daily_sales

    args = parse(argv)
    spark = spark or SparkSession.builder.appName("ledgerflow").getOrCreate()
    wh = Warehouse(spark, args.warehouse)
    if args.stage == "land":
        jobs.land_bronze(
            wh,
            driver.bronze_orders(spark, args.from_tables),
            driver.bronze_customers(spark, args.from_tables),
            driver.bronze_products(spark, args.from_tables),
        )
    elif args.stage:
        try:
            if args.stage in ("silver", "all"):
                jobs.bronze_to_silver(wh, *jobs.read_bronze(wh), args.as_of)
            if args.stage in ("silver-incremental", "incremental"):
                days = jobs.bronze_to_silver_incremental(wh, args.since)
                if args.stage == "incremental":
                    jobs.silver_to_gold_incremental(wh, days, args.as_of, args.vip_over, args.premium_over)
                    jobs.build_models(wh)
            if args.stage in ("gold", "all"):
                jobs.silver_to_gold(wh, args.as_of, args.vip_over, args.premium_over)
            if args.stage in ("models", "all"):
                jobs.build_models(wh)
        finally:
            flush_catalog(wh)
    if args.stream == "clean":
        stream_clean_orders(spark, wh.path("bronze", "orders"), wh.path("silver", "orders_stream"),
                            args.checkpoint).awaitTermination()
    elif args.stream == "daily":
        schema = wh.read("silver", "orders").schema
        stream_daily_sales(spark, wh.path("silver", "orders"), wh.path("gold", "daily_sales_stream"),
                           args.checkpoint, schema).awaitTermination()


if __name__ == "__main__":
    main()
