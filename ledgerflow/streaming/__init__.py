from ledgerflow.streaming.orders import latest_version, stream_clean_orders, stream_daily_sales, stream_deduped_orders  # noqa: F401
from ledgerflow.streaming.windows import close_days, daily_figures, stream_day_windows  # noqa: F401
