"""Stored dimensions by buckets of their natural keys, so that a small run opens few of them.

A run writes its new members to as many buckets as they need, a power of two, by the hash of the
natural key. A later run works out which buckets its own members can be in and leaves the folders
of all others unopened; runs that wrote different numbers of buckets stand side by side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

#: Members that a bucket holds on average, at most, and the most buckets a run makes.
MEMBERS = 50_000
MOST = 4096

#: The partition columns: how many buckets the run made, and which one this is.
COUNT, BUCKET = "buckets", "bucket"
FIELDS = f"{COUNT} int, {BUCKET} int"


def bucket_count(members: int, each: int = MEMBERS) -> int:
    """The buckets for so many members, ``each`` of them to a bucket."""
    wanted = -(-members // each)
    return min(MOST, 1 << max(0, wanted - 1).bit_length())


def bucket_of(natural: str | Column, count: int) -> Column:
    """The bucket of a natural key among ``count``; that of a divisor of ``count`` follows from it."""
    natural = F.col(natural) if isinstance(natural, str) else natural
    return F.pmod(F.xxhash64(natural), F.lit(count)).cast("int")


def in_buckets(members: DataFrame, natural: str, count: int) -> DataFrame:
    return members.withColumn(COUNT, F.lit(count)).withColumn(BUCKET, bucket_of(natural, count))


def touched(members: DataFrame, kind: str, member: str) -> dict[str, set[int]]:
    """Per kind the buckets, of ``MOST``, that members are in: at most ``MOST`` numbers each."""
    found: dict[str, set[int]] = {}
    for row in members.select(kind, bucket_of(member, MOST).alias(BUCKET)).distinct().collect():
        found.setdefault(row[kind], set()).add(row[BUCKET])
    return found


def only(stored: DataFrame, numbers: Iterable[int]) -> DataFrame:
    """Rows of a stored dimension in some of ``MOST`` buckets; the others are not opened.

    Where most buckets are wanted all are read; whoever joins drops what it does not look for.
    """
    numbers = set(numbers)
    if len(numbers) > MOST // 2:
        return stored
    counts = [1 << n for n in range(MOST.bit_length())]
    wanted = F.lit(False)
    for count in counts:
        some = {number % count for number in numbers}
        part = F.col(COUNT) == count
        wanted = wanted | (part if len(some) == count else part & F.col(BUCKET).isin(sorted(some)))
    return stored.filter(wanted)
