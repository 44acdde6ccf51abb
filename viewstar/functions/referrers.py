"""Domain and traffic type of a referrer URL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The pattern of the domain, and the words that name a traffic type.
# The first word found wins.
DOMAIN_PATTERN = r"https?://([^/]+)"
TRAFFIC_WORDS = (
    ("google", "Search Engine"),
    ("facebook", "Social Media"),
    ("direct", "Direct"),
)
OTHER_TRAFFIC = "Other"


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def referrer_domain(url) -> Column:
    """Host part as written (user and port stay); empty text where there is none."""
    return F.regexp_extract(_column(url), DOMAIN_PATTERN, 1)


def referrer_type(url) -> Column:
    """Traffic type by the words anywhere in the URL, case-sensitive."""
    cases = reduce(
        lambda chain, rule: chain.when(_column(url).contains(rule[0]), rule[1]),
        TRAFFIC_WORDS, F,
    )
    return cases.otherwise(OTHER_TRAFFIC)
