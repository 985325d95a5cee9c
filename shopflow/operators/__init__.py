"""Reusable DataFrame operators."""

from shopflow.operators.aggregates import count_by, distinct_values, group_concat_distinct, with_task_id  # noqa: F401
from shopflow.operators.filters import (  # noqa: F401
    any_of_filter, apply_session_filter, between_filter, conjunction, date_range,
    equal_filter, sentinel_to_null, session_filter,
)
from shopflow.operators.joins import (  # noqa: F401
    broadcast_if_small, estimated_bytes, exclude_keys, fits_broadcast, lookup_with_default,
)
from shopflow.operators.pairs import consecutive_pairs  # noqa: F401
from shopflow.operators.tables import insert_new, replace_groups, upsert_add, upsert_replace  # noqa: F401
from shopflow.operators.topk import top_n  # noqa: F401
