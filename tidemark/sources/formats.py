"""Layouts of the delimited event logs.

A format lists its fields in file order.  The field named ``ts`` holds epoch
time in ``unit`` and becomes a timestamp.  Fields in ``optional`` may be empty;
any other empty or unreadable field makes the line a reject.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RecordFormat:
    name: str
    fields: tuple[tuple[str, str], ...]
    sep: str = ","
    unit: str = "seconds"
    optional: frozenset[str] = frozenset()


BEHAVIOR = RecordFormat(
    "behavior",
    (
        ("user_id", "bigint"),
        ("item_id", "bigint"),
        ("category_id", "int"),
        ("behavior", "string"),
        ("ts", "bigint"),
    ),
)

AD_CLICK = RecordFormat(
    "ad_click",
    (
        ("user_id", "bigint"),
        ("ad_id", "bigint"),
        ("province", "string"),
        ("city", "string"),
        ("ts", "bigint"),
    ),
)

LOGIN = RecordFormat(
    "login",
    (("user_id", "bigint"), ("ip", "string"), ("state", "string"), ("ts", "bigint")),
)

ORDER = RecordFormat(
    "order",
    (("order_id", "bigint"), ("state", "string"), ("pay_id", "string"), ("ts", "bigint")),
    optional=frozenset({"pay_id"}),
)

RECEIPT = RecordFormat(
    "receipt",
    (("pay_id", "string"), ("pay_type", "string"), ("ts", "bigint")),
)

MARKET = RecordFormat(
    "market",
    (("user_id", "bigint"), ("channel", "string"), ("ts", "bigint"), ("behavior", "string")),
    unit="millis",
)

KEY_TIME = RecordFormat("key_time", (("k", "string"), ("ts", "bigint")), sep=" ")
