from tidemark.sources.formats import (
    AD_CLICK,
    BEHAVIOR,
    KEY_TIME,
    LOGIN,
    MARKET,
    ORDER,
    RECEIPT,
    RecordFormat,
)
from tidemark.sources.readers import (
    accepted,
    parse_access_log,
    parse_lines,
    parse_mixed,
    read_access_log,
    read_events,
    read_lines,
    read_parsed,
    rejected,
)

__all__ = [
    "AD_CLICK",
    "BEHAVIOR",
    "KEY_TIME",
    "LOGIN",
    "MARKET",
    "ORDER",
    "RECEIPT",
    "RecordFormat",
    "accepted",
    "parse_access_log",
    "parse_lines",
    "parse_mixed",
    "read_access_log",
    "read_events",
    "read_lines",
    "read_parsed",
    "rejected",
]
