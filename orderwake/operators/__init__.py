from .dedupe import duplicate_rows, first_per_key, latest_image
from .joins import BROADCAST_BYTES, HotKeys, hot_keys, lookup_in_place, lookup_join, row_bytes
from .order_stats import quantiles
from .ranges import counted_in_ranges
from .running import numeric_buckets, running_totals

__all__ = [
    "BROADCAST_BYTES",
    "HotKeys",
    "counted_in_ranges",
    "duplicate_rows",
    "first_per_key",
    "hot_keys",
    "latest_image",
    "lookup_in_place",
    "lookup_join",
    "numeric_buckets",
    "quantiles",
    "row_bytes",
    "running_totals",
]
