from barloom.functions.bands import band, latency_band, pct_band, record_count_band
from barloom.functions.derived import (
    bar_range_pct,
    event_time,
    is_market_hours,
    price_change,
    price_change_pct,
)
from barloom.functions.exact import exact_mean

__all__ = [
    "band",
    "bar_range_pct",
    "event_time",
    "exact_mean",
    "is_market_hours",
    "latency_band",
    "pct_band",
    "price_change",
    "price_change_pct",
    "record_count_band",
]
