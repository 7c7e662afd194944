"""Operating limits, as one value that callers may replace."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    stop_after_known: int = 10
    stop_after_failures: int = 5
    pages_per_feed: int = 5
    checks_per_run: int = 1000
    check_batch: int = 50
    hours_between_checks: int = 22
    sold_min_days: int = 30
    place_chars: int = 60
    place_ratio: float = 0.85
    week_min_listings: int = 2
    #: seconds until the next check for listings under 14 days, under 60 days and older
    recheck_seconds: tuple[int, int, int] = (164_160, 587_520, 1_192_320)
    cohort_days: tuple[int, int] = (14, 60)


DEFAULT = Params()
