"""Later stays (T7): every stay that starts after a person's anchor date.

The anchor is the start of the person's first index stay, or the index date
for a person without one.  The two cases are disjoint, so one equi join on
``person_id`` with ``anchor < stay start`` covers both in a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS, may_hold, summary
from cohortlens.operators.joins import split_hot_keys
from cohortlens.operators.visits import FIRST_STAY_END, FIRST_STAY_START, INDEX

ANCHOR_COLUMNS = ["person_id", INDEX, FIRST_STAY_START, FIRST_STAY_END]


def stays_after(
    fact: DataFrame, visits: DataFrame, *, prefilter: bool = False, persons: DataFrame | None = None, key_bits: int = KEY_BITS
) -> DataFrame:
    """One row per person and later stay.

    Columns: ``person_id``, the index date, the first stay's start and end,
    and the later stay's ``macrovisit_id``, start and end.  A stay id seen
    with several start dates keeps its earliest start after the anchor and
    the end from that row (ties: smaller end, nulls first).

    Visit rows meet the anchors in one shuffle by ``person_id``; the per-stay
    reduction runs in the same stage (a ``min`` does not depend on duplicate
    visit rows of one stay).  With ``prefilter`` (for a written ``fact``), stays
    starting before every anchor, and stays of other persons, are dropped in
    the scan stage first (one scalar subquery, see ``functions.keys``).  For a
    lazy ``fact``, ``persons`` may name its persons (a cheap table): then rows
    of others are dropped by that.
    """
    anchors = fact.select(*ANCHOR_COLUMNS).withColumn(
        "__anchor", F.coalesce(F.col(FIRST_STAY_START), F.col(INDEX))
    )
    if prefilter:
        held = summary(anchors, date="__anchor", bits=key_bits)
        visits = visits.where((F.col("macrovisit_start_date") > held.getField("lo")) & may_hold(held, "person_id", key_bits))
    elif persons is not None:
        visits = visits.where(may_hold(summary(persons, bits=key_bits), "person_id", key_bits))
    stays = visits.where(F.col("macrovisit_id").isNotNull()).select(
        "person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"
    )
    later = split_hot_keys(stays).join(anchors, "person_id", "inner").where(F.col("__anchor") < F.col("macrovisit_start_date"))
    order = F.struct("macrovisit_start_date", "macrovisit_end_date")
    return (
        later.groupBy(*ANCHOR_COLUMNS, "macrovisit_id")
        .agg(F.min(order).alias("s"))
        .select(
            *ANCHOR_COLUMNS,
            "macrovisit_id",
            F.col("s.macrovisit_start_date").alias("macrovisit_start_date"),
            F.col("s.macrovisit_end_date").alias("macrovisit_end_date"),
        )
    )
