from tidemark.functions.times import (
    as_duration,
    day_start,
    epoch_us,
    floor_us,
    from_epoch_us,
    next_midnight,
    to_us,
)

__all__ = [
    "as_duration",
    "day_start",
    "epoch_us",
    "floor_us",
    "from_epoch_us",
    "next_midnight",
    "to_us",
]
