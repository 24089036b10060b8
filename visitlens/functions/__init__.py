"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from .dates import (after, before, date_hour, format_date, format_time, instant_as_wall_clock,
                    minus_seconds, parse_time, today, wall_clock_as_instant, whole_seconds_between,
                    yesterday)
from .numbers import half_up_share
from .params import TaskParams, param_first, parse_params
from .strings import is_empty, is_not_empty, kv_get, kv_record, kv_set, pad_two, trim_comma
from .text import document_lines, explode_tokens, java_split, text_lines

__all__ = [
    "after", "before", "date_hour", "format_date", "format_time", "instant_as_wall_clock",
    "minus_seconds", "parse_time", "today", "wall_clock_as_instant", "whole_seconds_between",
    "yesterday", "half_up_share", "TaskParams", "param_first", "parse_params", "is_empty",
    "is_not_empty", "kv_get", "kv_record", "kv_set", "pad_two", "trim_comma", "document_lines",
    "explode_tokens", "java_split", "text_lines",
]
