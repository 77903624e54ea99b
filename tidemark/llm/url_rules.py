"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every URL it matches must hold.
Tokens are counted over all URLs, each rule is filed under the one seen least, and a URL runs
only the rules filed under its own tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules travel to every task; more than this many are refused.
MOST_RULES = 200_000

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``host + path``; ``tokens`` are words of letters and digits
    that stand alone in every match.  The matching rule of the highest ``rank`` decides."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: tuple[int, int]
    shown: bool = True


def host_rule(rule: str, verdict: str) -> Rule:
    """``host/path``: the host with all subdomains and every path that starts so.  Among such
    rules the longest wins, and any of them wins over a plain pattern."""
    host, slash, rest = rule.partition("/")
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(slash + rest)}"
    whole = re.findall(TOKEN, host.lower())
    inside = re.findall(TOKEN + r"(?=[^a-z0-9])", rest.lower())  # the last word may go on
    return Rule(rule, verdict, pattern, tuple(whole + inside), (1, len(rule)))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """A word, or words joined by ``-``, standing alone in the host."""
    pattern = rf"^[^/?#]*(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])"
    return Rule(word, verdict, pattern, tuple(re.findall(TOKEN, word)), (0, len(word)), shown=False)


#: The method's own verdicts, where no host rule fits: words of hosts that are not content.
HOST_WORDS = ("casino", "pills", "bets", "spam", "ads", "track", "porn", "xxx", "viagra", "payday")
DEFAULT_RULES = tuple(word_rule(word) for word in HOST_WORDS)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def token_counts(places: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """In how many URLs each token of the rules stands: at most one number per token."""
    wanted = sorted({token for rule in rules for token in rule.tokens})
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0)))
    names = places.sparkSession.createDataFrame([(token,) for token in wanted], "token string")
    counts = places.select(F.explode(found).alias("token")).groupBy("token").count()
    return {row["token"]: row["count"] for row in counts.join(names, "token", "left_semi").collect()}


def index_rules(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without any token stand under ``""``."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        rarest = min(rule.tokens, key=lambda token: (counts.get(token, 0), token), default="")
        index.setdefault(rarest, []).append(rule)
    return index


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null unless a host rule decided) and ``verdict``.

    A null URL or one without ``://`` has an empty host and path, fits no rule and gets
    ``default``.  Every row is judged by itself: repeated rows, ties and null ids change nothing,
    and other columns are not read.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    host, path = host_and_path(F.col(url_col))
    places = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    index = index_rules(rules, token_counts(places, rules))

    def judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = re.compile(TOKEN)
        patterns = {rule: re.compile(rule.pattern) for filed in index.values() for rule in filed}
        for part in parts:
            rows = []
            for place in part["host"] + part["path"]:
                tokens = {"", *token.findall(place.lower())}
                fetched = (rule for word in tokens for rule in index.get(word, ()))
                fitting = (rule for rule in fetched if patterns[rule].search(place))
                best = max(fitting, key=lambda rule: (rule.rank, rule.name), default=None)
                rows.append((best.name if best and best.shown else None, best.verdict if best else default))
            yield part.assign(rule=[r for r, _ in rows], verdict=[v for _, v in rows])

    schema = f"page_id {places.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return places.mapInPandas(judged, schema)
