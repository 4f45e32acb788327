"""Layouts of large inputs that let a scan skip most of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The day that a visit row is matched by: the start of its stay, or its own.
EVENT_DAY = "event_day"


def by_day(visits: DataFrame, files: int | None = None) -> DataFrame:
    """``visits`` with their ``event_day``, in ranges of days and sorted by day within a range.

    Written so, the row groups of a file span few days, and the statistics of
    Parquet let the match with index dates skip those outside their span.  A
    day with very many rows is one range; ``files`` is how many ranges to make
    (default: the session's number of shuffle partitions).
    """
    rows = visits.withColumn(EVENT_DAY, F.coalesce("macrovisit_start_date", "visit_start_date"))
    ranged = rows.repartitionByRange(files, EVENT_DAY) if files else rows.repartitionByRange(EVENT_DAY)
    return ranged.sortWithinPartitions(EVENT_DAY)
