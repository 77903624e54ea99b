from tidemark.operators.accumulators import Moments, aggregate
from tidemark.operators.caps import click_cap
from tidemark.operators.deadline import lifecycle_status, missing_follow_up
from tidemark.operators.distinct import (
    running_distinct,
    running_distinct_updates,
    window_approx_distinct,
    window_distinct,
)
from tidemark.operators.reconcile import reconcile
from tidemark.operators.reports import ranking_report
from tidemark.operators.sequence import (
    consecutive_pairs,
    fail_burst,
    followed_by,
    strict_sequence,
)
from tidemark.operators.sketches import roll_up, sketched_counts, window_sketches
from tidemark.operators.topn import top_n
from tidemark.operators.windows import window_count, window_count_updates, with_event_time

__all__ = [
    "Moments",
    "aggregate",
    "click_cap",
    "consecutive_pairs",
    "fail_burst",
    "followed_by",
    "lifecycle_status",
    "missing_follow_up",
    "ranking_report",
    "reconcile",
    "roll_up",
    "running_distinct",
    "running_distinct_updates",
    "sketched_counts",
    "strict_sequence",
    "top_n",
    "window_approx_distinct",
    "window_count",
    "window_count_updates",
    "window_distinct",
    "window_sketches",
    "with_event_time",
]
