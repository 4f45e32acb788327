"""Generic event operators: events in a day window around a per-key date, first event per key.

``events_in_window`` is a range join written as an equi join on the key with
a day-range residual (Spark has no range join); a prefilter by the span of all
index dates and a bitmap of their keys drops most other events before the
shuffle.  For keys with many index rows and many events, days are cut into
buckets of the window's width and the bucket becomes a second equi key, so an
event meets the index rows near it only.  ``first_event`` keeps
one whole row per key with ``min_by`` over a struct, a partial + final
aggregation with a total order, so ties do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS, may_be_near, may_hold, summary
from cohortlens.functions.windows import near
from cohortlens.operators.joins import split_hot_keys


def events_in_window(
    index: DataFrame,
    events: DataFrame,
    *,
    index_date: str,
    event_date: str,
    before: int,
    after: int,
    key: str = "person_id",
    also: Column | None = None,
    prefilter: bool = True,
    key_bits: int = KEY_BITS,
    many: bool = False,
) -> DataFrame:
    """Events joined to their key's index row, kept when the event date lies in
    ``[index_date - before, index_date + after]`` (and ``also`` holds, if given).

    Output: the columns of ``events`` and of ``index`` (the key once).  Null
    dates never match.  ``prefilter`` drops events outside the span of all
    index dates, and those whose key is not among theirs (a bitmap of
    ``key_bits``), before the join: one scalar subquery over ``index``.

    ``many``: keys may have many index rows and many events.  An event has one
    bucket of days, an index row the two that its window reaches into, so each
    pair meets once at most, and the join makes at most the pairs within two
    windows' width instead of all pairs of a key.

    Both sides are shuffled by the key unless the planner finds the index side
    small; AQE splits a hot key.
    """
    if before + after < 0:
        raise ValueError("the window is empty: before + after is negative")
    if prefilter:
        held = summary(index.where(F.col(index_date).isNotNull()), key=key, date=index_date, bits=key_bits)
        events = events.where(may_be_near(held, event_date, before, after) & may_hold(held, key, key_bits))
    cond = near(index_date, event_date, before, after)
    if also is not None:
        cond = cond & also
    if not many:
        return split_hot_keys(events).join(index, key, "inner").where(cond)
    first, last = (day_bucket(F.date_add(index_date, n), before + after + 1) for n in (-before, after))
    index = index.withColumn("__bucket", F.explode(F.array_distinct(F.array(first, last))))
    events = split_hot_keys(events).withColumn("__bucket", day_bucket(F.col(event_date), before + after + 1))
    return events.join(index, [key, "__bucket"], "inner").where(cond).drop("__bucket")


def day_bucket(date: Column, width: int) -> Column:
    """Which run of ``width`` days a date lies in."""
    return F.floor(F.unix_date(date) / F.lit(width))


def first_event(df: DataFrame, key: str | Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per ``key``: the ``payload`` columns of the row first by ``order``.

    ``order`` should make a total order (add an id column last); ascending,
    nulls first.  Rows whose order struct is null do not occur (a struct of
    columns is never null), so every key with a row gets one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__first")).select(
        *keys, *[F.col(f"__first.{c}").alias(c) for c in payload]
    )
