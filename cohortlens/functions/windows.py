"""Day windows around an index date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(index_date: ColumnOrName, event_date: ColumnOrName) -> Column:
    """``index_date - event_date`` in days (positive when the event is earlier)."""
    return F.datediff(_c(index_date), _c(event_date))


def near(index_date: ColumnOrName, event_date: ColumnOrName, before: int, after: int) -> Column:
    """Event within ``[index - before, index + after]`` days, both ends included.

    Null on either side gives null, which a filter treats as false.
    """
    return days_between(index_date, event_date).between(-after, before)


def within_span(event_date: ColumnOrName, index: DataFrame, index_date: str, before: int, after: int) -> Column:
    """Exact prefilter: the event lies in ``[min(index_date) - before, max(index_date) + after]``.

    Any event inside some person's window lies in this span, so the filter
    never drops a match; it drops the history far from every index date
    before the first shuffle.  The bounds are one scalar subquery over the
    (narrow) index table, run once at execution; nothing reaches the driver.
    No index date at all gives null bounds, which keep no row.
    """
    bounds = index.select(
        F.struct(
            F.date_sub(F.min(index_date), before).alias("lo"),
            F.date_add(F.max(index_date), after).alias("hi"),
        )
    ).scalar()
    return _c(event_date).between(bounds.getField("lo"), bounds.getField("hi"))


def within_bounds(event_date: ColumnOrName, index: DataFrame, index_date: str, before: int, after: int) -> Column:
    """The filter of ``within_span`` as two comparisons with a scalar subquery each: of a stored column,
    Spark pushes them down to the scan, which then skips row groups outside the span."""
    # first and last by order, not min and max: Spark would merge two aggregates into one struct, and push down neither
    known = index.where(F.col(index_date).isNotNull())
    lo = known.orderBy(index_date).limit(1).select(F.date_sub(index_date, before)).scalar()
    hi = known.orderBy(F.desc(index_date)).limit(1).select(F.date_add(index_date, after)).scalar()
    return (_c(event_date) >= lo) & (_c(event_date) <= hi)
