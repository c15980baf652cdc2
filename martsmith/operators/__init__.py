"""DataFrame -> DataFrame operators: joins, dedup, conform, load planning, surrogate ids."""

from martsmith.operators.conform import conform
from martsmith.operators.dedup import arrival_order, distinct_rows, first_wins
from martsmith.operators.joins import (
    checked_broadcast,
    skew_safe_left_join,
    typed_key,
)
from martsmith.operators.loadplan import (
    guarded_refresh_content,
    plan_insert_ignore,
)
from martsmith.operators.surrogate import assign_surrogate_ids, max_id

__all__ = [
    "arrival_order",
    "assign_surrogate_ids",
    "checked_broadcast",
    "conform",
    "distinct_rows",
    "first_wins",
    "guarded_refresh_content",
    "max_id",
    "skew_safe_left_join",
    "plan_insert_ignore",
    "typed_key",
]
