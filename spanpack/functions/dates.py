"""Date arithmetic for eras, all in DATE / integer days.

Keeping everything as ``DateType`` with ``date_add`` / ``datediff`` avoids the
timestamp promotion that interval arithmetic causes, so results never depend
on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in whole days as BIGINT."""
    return F.datediff(_c(end), _c(start)).cast("long")


def condition_end_date(start: str | Column, end: str | Column, default_days: int = 1) -> Column:
    """Given end date, else ``start + default_days``."""
    return F.coalesce(_c(end), F.date_add(_c(start), default_days))


def drug_end_date(
    start: str | Column,
    end: str | Column,
    days_supply: str | Column,
    default_days: int = 1,
) -> Column:
    """First non-null of: given end; ``start + days_supply`` when supply is
    non-zero (NULL or 0 supply falls through); ``start + default_days``.

    A given end is trusted as is, even when it equals or precedes the start.
    ``days_supply`` may be any numeric type; it counts whole days (INT).
    """
    supply = _c(days_supply).cast("int")
    from_supply = F.when(supply != 0, F.date_add(_c(start), supply))
    return F.coalesce(_c(end), from_supply, F.date_add(_c(start), default_days))


def drug_end_source(end: str | Column, days_supply: str | Column) -> Column:
    """Which branch of :func:`drug_end_date` produced the end date."""
    return (
        F.when(_c(end).isNotNull(), F.lit("given"))
        .when(_c(days_supply).cast("int") != 0, F.lit("supply"))
        .otherwise(F.lit("default"))
    )


def opens_new_run(start: str | Column, prev_max_end: Column, grace_days: int) -> Column:
    """True when a record starts a new run: nothing before it, or it starts more
    than ``grace_days`` after the latest end seen so far (a gap of exactly
    ``grace_days`` still joins)."""
    return prev_max_end.isNull() | (_c(start) > F.date_add(prev_max_end, grace_days))


def covered_days(start: str | Column, end: str | Column, prev_max_end: Column) -> Column:
    """Days of ``[start, end)`` not already covered by earlier records of the
    same key, given the running maximum end of those records. Summed over a
    run this is the length of the union of its intervals."""
    s = _c(start)
    from_day = F.greatest(s, F.coalesce(prev_max_end, s))
    return F.greatest(F.lit(0).cast("long"), days_between(from_day, end))


def gap_days_stockpile(era_start: str | Column, era_end: str | Column, sum_days: str | Column) -> Column:
    """Era length minus the summed exposure lengths (negative when supplies overlap)."""
    return days_between(era_start, era_end) - _c(sum_days).cast("long")


def gap_days_covered(era_start: str | Column, era_end: str | Column, covered: str | Column) -> Column:
    """Era length minus the days actually covered by at least one exposure."""
    return days_between(era_start, era_end) - _c(covered).cast("long")
