"""Column-level building blocks (all JVM-side built-ins except the one χ² tail helper)."""

from veritab.functions.columns import (  # noqa: F401
    clip_lower,
    format_percent,
    hash_below,
    hash_hex,
    hash_threshold_hex,
    indicator,
    is_missing,
    right_closed_bands,
    safe_ratio,
    smoothed_ratio,
    strip,
)
from veritab.functions.search import count_less_than, pad_sorted  # noqa: F401
