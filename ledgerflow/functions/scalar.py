"""Column-level helpers.  All built from ``pyspark.sql.functions`` so they stay
inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import schemas as S


def normalize(col: str | Column) -> Column:
    """lower(trim(x)); trims spaces only, NULL stays NULL."""
    return F.lower(F.trim(F.col(col) if isinstance(col, str) else col))


def parse_ts(col: str | Column) -> Column:
    """ISO-8601 string (with or without offset) to timestamp; malformed -> NULL.

    Spark 4 runs ANSI mode, where ``to_timestamp`` raises on bad input; the
    pipeline's contract is a NULL timestamp, so the ``try_`` form is used.
    """
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """The reference date used wherever the jobs said ``current_date``."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))


def exact_avg(col: str | Column, scale: int) -> Column:
    """round_half_up(sum / count, scale) computed in decimal arithmetic.

    ``avg`` over a decimal rounds to scale+4 first; dividing the exact sum by
    the count and rounding once avoids double rounding.  The input must be
    a decimal (or integral) column.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.sum(c) / F.count(c).cast("decimal(20,0)"), scale)


def exact_ratio(num: Column, den: Column, scale: int) -> Column:
    """round_half_up(num / den, scale) in decimal arithmetic; den = 0 -> NULL."""
    return F.round(F.try_divide(num.cast("decimal(20,0)"), den.cast("decimal(20,0)")), scale)


def period_of(year: str | Column, month: str | Column) -> Column:
    """'yyyy-MM' from integer year/month columns (formats once per group, not per row)."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    # format_string renders NULL as the text 'null'; a missing date stays NULL
    return F.when(y.isNotNull() & m.isNotNull(), F.format_string("%04d-%02d", y, m))


def price_tier(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for bound, name in S.PRICE_TIERS:
        expr = F.when(c < bound, name) if expr is None else expr.when(c < bound, name)
    return expr.otherwise(S.PRICE_TIER_TOP)


def to_numeric(col: str | Column, dtype: str = "double") -> Column:
    """Coerce to a number; anything unparsable becomes NULL (no error)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(dtype)
