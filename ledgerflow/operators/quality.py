"""DQ1-DQ7: data-quality checks.

All checks of a table are evaluated in ONE pass (a single global aggregate
with one ``count_if`` per check, partial-aggregated per task) instead of one
job per check.  A predicate that evaluates to NULL is not a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import schemas as S

Checks = Mapping[str, Column]


# --- DQ3-DQ5: the three silver check sets (name -> predicate that must hold); the names are fixed values ---
def orders_checks() -> dict[str, Column]:
    return {
        "no_null_order_id": F.col("order_id").isNotNull(),
        "positive_amount": F.col("total_amount") > 0,
        "valid_status": F.col("status").isin(S.ORDER_STATUSES),
        "valid_quantity": F.col("quantity").between(*S.QUANTITY_BOUNDS),
        "non_negative_discount": F.col("discount").between(*S.DISCOUNT_BOUNDS),
    }


def customers_checks() -> dict[str, Column]:
    return {
        "no_null_customer_id": F.col("customer_id").isNotNull(),
        "valid_email": F.col("email").contains("@"),
        "valid_segment": F.col("segment").isin(S.CUSTOMER_SEGMENTS),
    }


def products_checks() -> dict[str, Column]:
    return {
        "no_null_product_id": F.col("product_id").isNotNull(),
        "positive_price": F.col("base_price") > 0,
        "valid_rating": F.col("rating").between(*S.RATING_BOUNDS),
    }


CHECK_SETS: dict[str, Callable[[], dict[str, Column]]] = {
    "orders": orders_checks,
    "customers": customers_checks,
    "products": products_checks,
}


def dq_status(rows_failed: Column, rows_tested: Column) -> Column:
    """DQ2: 0 -> pass; failed < 1 % of tested (strict) -> warn; else fail.
    Integer arithmetic, so no float rounding at the boundary."""
    return (
        F.when(rows_failed == 0, F.lit("pass"))
        .when(rows_failed * 100 < rows_tested * S.DQ_WARN_PERCENT, F.lit("warn"))
        .otherwise(F.lit("fail"))
    )


def _failure_counts(checks: Checks) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows_tested")] + [
        F.count_if(~cond).alias(f"_f{i}") for i, cond in enumerate(checks.values())
    ]


def run_checks(df: DataFrame, table_name: str, layer: str, checks: Checks) -> DataFrame:
    """DQ1 as a DataFrame: one row per check with rows_tested, rows_failed, status."""
    return _report(df.agg(*_failure_counts(checks)), table_name, layer, checks)


def part_counts(df: DataFrame, part: Column, checks: Checks) -> DataFrame:
    """Rows tested and failed by part of a table (column ``part``): counts that add up to those of ``run_checks``."""
    return df.groupBy(part.alias("part")).agg(*_failure_counts(checks))


def total_checks(counts: DataFrame, table_name: str, layer: str, checks: Checks) -> DataFrame:
    """DQ1 from the counts of all parts."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows_tested", *[f"_f{i}" for i in range(len(checks))])]
    return _report(counts.agg(*sums), table_name, layer, checks)


def _report(counts: DataFrame, table_name: str, layer: str, checks: Checks) -> DataFrame:
    names = list(checks)
    pairs = ", ".join(f"'{n}', _f{i}" for i, n in enumerate(names))
    rows = counts.selectExpr("rows_tested", f"stack({len(names)}, {pairs}) AS (check_name, rows_failed)")
    return rows.select(
        F.lit(table_name).alias("table_name"),
        F.lit(layer).alias("layer"),
        "check_name",
        dq_status(F.col("rows_failed"), F.col("rows_tested")).alias("status"),
        "rows_tested",
        "rows_failed",
    )


# --- DQ6 / DQ7: declarative table tests ---
def table_tests(df: DataFrame, model: str, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """One row per (column, test): failures = NULL rows (not_null) or keys that
    occur more than once (unique).  not_null tests share one pass; each unique
    test is a partial-aggregated group count."""
    parts = []
    if not_null:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(not_null)])
        pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(not_null))
        parts.append(
            counts.selectExpr(f"stack({len(not_null)}, {pairs}) AS (column_name, failures)")
            .withColumn("test", F.lit("not_null"))
        )
    for c in unique:
        dup = (
            df.filter(F.col(c).isNotNull())
            .groupBy(c)
            .count()
            .filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("failures"))
        )
        parts.append(dup.select(F.lit(c).alias("column_name"), "failures", F.lit("unique").alias("test")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        F.lit(model).alias("model"),
        "column_name",
        "test",
        F.col("failures").cast("long").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )
