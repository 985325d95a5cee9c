"""Scalar column functions; all are built-in Spark expressions, no UDFs."""

from shopflow.functions.dates import (  # noqa: F401
    date_hour, epoch_millis_to_ts, epoch_seconds, format_date, format_date_key,
    format_time, format_time_minute, minute_parts, parse_date_key, parse_time,
    seconds_between, time_after, time_before, today, yesterday,
)
from shopflow.functions.misc import area_level, json_field, product_status, round_half_up  # noqa: F401
from shopflow.functions.strings import (  # noqa: F401
    concat_long_string, flow_pairs, is_empty, is_not_empty, java_split_space,
    kv_get, kv_set, pad_two, trim_comma,
)
from shopflow.functions.sql import register_sql_functions  # noqa: F401
