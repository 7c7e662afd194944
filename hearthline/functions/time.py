"""Times: a parameter everywhere, without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.params import DEFAULT, Params


def moment(at: str | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(str(at)).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def whole_days(start: Column, end: Column) -> Column:
    return F.floor(seconds_between(start, end) / 86400)


def seconds_later(at: Column, seconds: int) -> Column:
    return at + F.expr(f"interval '{seconds}' second")


def next_check_at(first_seen: Column, at: Column, params: Params = DEFAULT) -> Column:
    """When a listing confirmed at ``at`` is due again, by its age in whole days; an unknown age is 0."""
    age, (young, middle, old), (a, b) = F.coalesce(whole_days(first_seen, at), F.lit(0)), params.recheck_seconds, params.cohort_days
    return F.when(age < a, seconds_later(at, young)).when(age < b, seconds_later(at, middle)).otherwise(seconds_later(at, old))
