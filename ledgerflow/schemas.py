"""Table schemas and the fixed values the pipeline semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the pipeline being reproduced, kept together here)
# ---------------------------------------------------------------------------
ORDER_STATUSES = ["completed", "refunded", "cancelled"]
CUSTOMER_SEGMENTS = ["standard", "premium", "vip"]
# price tiers: upper bounds (exclusive) in order, last tier catches the rest
PRICE_TIERS = [(50, "budget"), (200, "mid"), (500, "premium")]
PRICE_TIER_TOP = "luxury"
# customer segment rules, first match wins
VIP_OVER = 3000
PREMIUM_OVER = 1000
AT_RISK_DAYS_OVER = 180
NEW_MAX_ORDERS = 1
CLV_CAP = "9999999.9999"
# data-quality status rule: 0 failed -> pass, failed < 1 % of rows -> warn, else fail
DQ_WARN_PERCENT = 1
# data-quality checks: inclusive bounds
QUANTITY_BOUNDS = (1, 100)
DISCOUNT_BOUNDS = (0, 1)
RATING_BOUNDS = (0, 5)
# run names of the six batch jobs
RUN_NAMES = {
    "orders": "bronze_to_silver_orders",
    "customers": "bronze_to_silver_customers",
    "products": "bronze_to_silver_products",
    "daily_sales": "silver_to_gold_daily_sales",
    "product_performance": "silver_to_gold_product_perf",
    "customer_segments": "silver_to_gold_customer_seg",
}
# read-side default caps of the report queries
RECENT_DAYS = 30
TRENDS_LIMIT = 90
TOP_PRODUCTS_LIMIT = 10
RUNS_LIMIT = 50
DQ_LIMIT = 100
DASHBOARD_TOP_N = 15
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(14, 2)
DISCOUNT = T.DecimalType(4, 2)

BRONZE_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", MONEY),
        T.StructField("quantity", T.LongType()),
        T.StructField("discount", DISCOUNT),
        T.StructField("total_amount", MONEY),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

BRONZE_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("joined_at", T.StringType()),
    ]
)

BRONZE_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("base_price", MONEY),
        T.StructField("stock", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
    ]
)

# dedupe tie-break: after the key, rows are ordered by these columns ascending
ORDERS_DEDUPE_ORDER = ["product_id", "unit_price", "quantity", "discount", "total_amount", "status"]

PIPELINE_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

TABLE_CATALOG = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("schema_json", T.StringType()),
    ]
)

DQ_RESULTS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_tested", T.LongType()),
        T.StructField("rows_failed", T.LongType()),
        T.StructField("details", T.StringType()),
        T.StructField("run_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
