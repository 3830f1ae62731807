from ledgerflow.functions.scalar import (  # noqa: F401
    as_of_date,
    exact_avg,
    exact_ratio,
    normalize,
    parse_ts,
    period_of,
    price_tier,
    to_numeric,
)
