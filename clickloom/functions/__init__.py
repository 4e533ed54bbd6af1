"""Column functions. All of them are compositions of Spark built-ins."""

from clickloom.functions.aggregates import group_concat_distinct
from clickloom.functions.register import register_functions
from clickloom.functions.scalars import (
    after,
    before,
    concat_long_string,
    date_hour,
    format_date,
    format_date_key,
    format_time,
    format_time_minute,
    is_empty,
    is_not_empty,
    json_field,
    minus_seconds,
    pad2,
    parse_date_key,
    parse_time,
    ratio,
    today,
    trim_comma,
    yesterday,
)

__all__ = [
    "after",
    "before",
    "concat_long_string",
    "date_hour",
    "format_date",
    "format_date_key",
    "format_time",
    "format_time_minute",
    "group_concat_distinct",
    "is_empty",
    "is_not_empty",
    "json_field",
    "minus_seconds",
    "pad2",
    "parse_date_key",
    "parse_time",
    "ratio",
    "register_functions",
    "today",
    "trim_comma",
    "yesterday",
]
