"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from podium.functions.calendar import (
    as_of_default,
    date_text_long,
    date_text_short,
    month_text,
    period_col,
    period_label,
    period_range,
    saturday_check,
    weekday_label,
    weekday_order,
)
from podium.functions.timefmt import (
    format_secs,
    format_secs_unpadded,
    minutes,
    parse_time,
    repair_time,
)

__all__ = [
    "as_of_default",
    "date_text_long",
    "date_text_short",
    "format_secs",
    "format_secs_unpadded",
    "minutes",
    "month_text",
    "parse_time",
    "period_col",
    "period_label",
    "period_range",
    "repair_time",
    "saturday_check",
    "weekday_label",
    "weekday_order",
]
