"""Visits near an index date (T6b-T6f) and look-ups on visits (T10-T13).

A *stay* is a visit row with a stay start date; an *ER-only* visit has no
stay start and an ER concept.  Both are matched to the index dates of each
person within a day window, then reduced to the first one per person.

Plan shape: visit rows outside the span of all index dates, and rows of persons
outside the cohort, are dropped in the scan stage (one scalar subquery over
the cohort gives the span and a bitmap of its ids, see ``functions.keys``);
the rest are shuffled once, by ``person_id``, to meet the index dates (AQE
broadcasts the index side when it is small and splits a person key that
holds a large share of rows), filtered by the window, and made distinct or
reduced per person in the same stage, since the join output is already
hash-partitioned by ``person_id``.  ``first_index_visits`` does stays and
ER visits in that one pass.  (Making visit rows distinct before the join
costs a shuffle of its own; measured, the single shuffle is faster, and
the per-person ``min_by``/``min`` do not depend on duplicates.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS, may_be_near, may_hold, summary
from cohortlens.functions.windows import near, within_bounds, within_span
from cohortlens.operators.concepts import er_concepts
from cohortlens.operators.events import events_in_window, first_event
from cohortlens.operators.joins import split_hot_keys
from cohortlens.sources.layout import EVENT_DAY

# The column names of the output contract.
LAB, DIAGNOSIS, INDEX = "first_pos_pcr_antigen_date", "first_pos_diagnosis_date", "first_poslab_or_diagnosis_date"
STAY_START, STAY_END = "covid_hospitalization_start_date", "covid_hospitalization_end_date"
ER_DATE = "covid_ER_only_start_date"
FIRST_STAY_START = "first_COVID_hospitalization_start_date"
FIRST_STAY_END = "first_COVID_hospitalization_end_date"
FIRST_ER = "first_covid_er_only_start_date"


def index_dates(cohort: DataFrame) -> DataFrame:
    """Per person: lab date, diagnosis date and index date (the earlier of the two)."""
    return cohort.select("person_id", LAB, DIAGNOSIS, INDEX)


def window_match(event_date: str, *, require_both: bool, before: int, after: int):
    """Predicate on joined rows: the event is near the index date (``either``) or near
    the lab date with the diagnosis near the lab date as well (``both``)."""
    if require_both:
        return near(LAB, event_date, before, after) & near(LAB, DIAGNOSIS, before, after)
    return near(INDEX, event_date, before, after)


def cohort_summary(cohort: DataFrame, date: str = INDEX, key_bits: int = KEY_BITS):
    """The persons with that date, and the span of it, as one value (``functions.keys.summary``)."""
    return summary(index_dates(cohort).where(F.col(date).isNotNull()), date=date, bits=key_bits)


def in_cohort_reach(event_date, cohort, *, require_both: bool, before: int, after: int, key_bits: int | None = KEY_BITS):
    """Prefilter for a window match: the event's date lies in the span of all index dates, and its
    person is in the cohort as far as a bitmap of ``key_bits`` tells (None: dates only)."""
    date = LAB if require_both else INDEX
    if not key_bits:
        return within_span(event_date, index_dates(cohort), date, before, after)
    held = cohort_summary(cohort, date, key_bits)
    return may_be_near(held, event_date, before, after) & may_hold(held, "person_id", key_bits)


def skipping_days(visits: DataFrame, cohort: DataFrame, *, require_both: bool, before: int, after: int) -> DataFrame:
    """Visits laid out by day (``sources.layout.by_day``) without the days outside the span, skipped in the scan; others as they are."""
    if EVENT_DAY not in visits.columns:
        return visits
    return visits.where(within_bounds(EVENT_DAY, index_dates(cohort), LAB if require_both else INDEX, before, after))


def _index_window(event_date: str, *, require_both: bool, before: int, after: int) -> dict:
    """Arguments of ``events_in_window`` for the ``either`` or ``both`` rule."""
    if require_both:
        return dict(index_date=LAB, event_date=event_date, before=before, after=after,
                    also=near(LAB, DIAGNOSIS, before, after))
    return dict(index_date=INDEX, event_date=event_date, before=before, after=after)


def hospital_stays_near(
    cohort: DataFrame,
    visits: DataFrame,
    *,
    require_both: bool = False,
    before: int = 1,
    after: int = 16,
    key_bits: int | None = KEY_BITS,
) -> DataFrame:
    """Stays starting within the window: ``person_id, macrovisit_id`` and stay start and end."""
    span = in_cohort_reach("macrovisit_start_date", cohort, require_both=require_both, before=before, after=after, key_bits=key_bits)
    visits = skipping_days(visits, cohort, require_both=require_both, before=before, after=after)
    stays = visits.where(span & F.col("macrovisit_start_date").isNotNull()).select(
        "person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date"
    )
    window = _index_window("macrovisit_start_date", require_both=require_both, before=before, after=after)
    matched = events_in_window(index_dates(cohort), stays, prefilter=False, **window)
    return matched.select(
        "person_id",
        "macrovisit_id",
        F.col("macrovisit_start_date").alias(STAY_START),
        F.col("macrovisit_end_date").alias(STAY_END),
    ).distinct()


def er_visit_rows(visits: DataFrame, members: DataFrame, sets: DataFrame, er_ids: DataFrame | None = None) -> DataFrame:
    """(person, date) of every ER-only visit row: no stay start, a current ER concept.

    ``er_ids``: the resolved list (``er_concepts``), if it has been written as a stage.
    """
    listed = er_concepts(members, sets) if er_ids is None else er_ids
    return (
        visits.where(F.col("macrovisit_start_date").isNull())
        .join(listed.withColumnRenamed("concept_id", "visit_concept_id"), "visit_concept_id", "left_semi")
        .select("person_id", "visit_start_date")
    )


def er_visits_near(
    cohort: DataFrame,
    visits: DataFrame,
    members: DataFrame,
    sets: DataFrame,
    *,
    require_both: bool = False,
    before: int = 1,
    after: int = 16,
    key_bits: int | None = KEY_BITS,
) -> DataFrame:
    """ER-only visit dates within the window: ``person_id, covid_ER_only_start_date``."""
    span = in_cohort_reach("visit_start_date", cohort, require_both=require_both, before=before, after=after, key_bits=key_bits)
    visits = skipping_days(visits, cohort, require_both=require_both, before=before, after=after)
    dates = er_visit_rows(visits.where(span), members, sets)
    window = _index_window("visit_start_date", require_both=require_both, before=before, after=after)
    matched = events_in_window(index_dates(cohort), dates, prefilter=False, **window)
    return matched.select("person_id", F.col("visit_start_date").alias(ER_DATE)).distinct()


def first_stay(stays: DataFrame) -> DataFrame:
    """The earliest stay per person, whole: its id, start and end come from one row.

    Ties on the start are broken by the end (nulls first), then the stay id,
    so the result does not depend on partitioning.  ``min_by`` over a struct is
    aggregated partially before any shuffle.
    """
    firsts = first_event(
        stays, "person_id", order=[STAY_START, STAY_END, "macrovisit_id"], payload=["macrovisit_id", STAY_START, STAY_END]
    )
    return firsts.select(
        "person_id",
        "macrovisit_id",
        F.col(STAY_START).alias(FIRST_STAY_START),
        F.col(STAY_END).alias(FIRST_STAY_END),
    )


def first_er(er_dates: DataFrame) -> DataFrame:
    """The earliest ER-only date per person."""
    return er_dates.groupBy("person_id").agg(F.min(ER_DATE).alias(FIRST_ER))


def first_visits(first_stays: DataFrame, first_ers: DataFrame | None) -> DataFrame:
    """First stay and first ER date per person; a person with only one of them is kept."""
    if first_ers is None:
        return first_stays
    return first_stays.join(first_ers, "person_id", "full_outer")


def index_events(visits: DataFrame, members: DataFrame, sets: DataFrame, er_ids: DataFrame | None = None) -> DataFrame:
    """Stays and ER-only visits from one scan of ``visits``, one row per visit row.

    Columns: ``person_id``, ``is_stay``, ``macrovisit_id`` and ``end`` (null
    for ER rows), ``day`` (stay start, or ER visit date).  The ER concept ids
    are joined as a marker column, so stay rows are kept whatever their
    concept; ``er_ids`` is the resolved list, if it has been written.
    """
    listed = er_concepts(members, sets) if er_ids is None else er_ids
    marks = listed.select(F.col("concept_id").alias("visit_concept_id"), F.lit(True).alias("__er"))
    marked = split_hot_keys(visits).join(marks, "visit_concept_id", "left")
    is_stay = F.col("macrovisit_start_date").isNotNull()
    return (
        marked.where(is_stay | F.col("__er").isNotNull())
        .select(
            "person_id",
            is_stay.alias("is_stay"),
            F.when(is_stay, F.col("macrovisit_id")).alias("macrovisit_id"),
            F.coalesce("macrovisit_start_date", "visit_start_date").alias("day"),
            F.when(is_stay, F.col("macrovisit_end_date")).alias("end"),
        )
    )


def first_index_visits(
    cohort: DataFrame,
    visits: DataFrame,
    members: DataFrame,
    sets: DataFrame,
    *,
    with_er: bool = True,
    require_both: bool = False,
    before: int = 1,
    after: int = 16,
    er_ids: DataFrame | None = None,
    key_bits: int | None = KEY_BITS,
) -> DataFrame:
    """Per person of ``cohort``: first stay (id, start, end) and, with ``with_er``, first ER date.

    Only ``person_id`` and the three index dates of ``cohort`` are read.  With
    ``with_er`` both kinds come from one pass: one scan of ``visits``, one
    join to the index dates, one aggregation per person (no full outer join
    of two per-person tables); a person with only one kind is kept.
    """
    window = dict(require_both=require_both, before=before, after=after)
    if not with_er:
        return first_stay(hospital_stays_near(cohort, visits, **window, key_bits=key_bits))
    span = in_cohort_reach(F.coalesce("macrovisit_start_date", "visit_start_date"), cohort, **window, key_bits=key_bits)
    near_events = events_in_window(
        index_dates(cohort),
        index_events(skipping_days(visits, cohort, **window).where(span), members, sets, er_ids),
        prefilter=False,
        **_index_window("day", **window),
    )
    stay = F.col("is_stay")
    best = F.min_by(
        F.when(stay, F.struct(F.col("macrovisit_id"), F.col("day").alias(STAY_START), F.col("end").alias(STAY_END))),
        F.when(stay, F.struct("day", "end", "macrovisit_id")),
    )
    return near_events.groupBy("person_id").agg(
        best.alias("s"), F.min(F.when(~stay, F.col("day"))).alias(FIRST_ER)
    ).select(
        "person_id",
        F.col("s.macrovisit_id").alias("macrovisit_id"),
        F.col(f"s.{STAY_START}").alias(FIRST_STAY_START),
        F.col(f"s.{STAY_END}").alias(FIRST_STAY_END),
        FIRST_ER,
    )


def index_visits(
    cohort: DataFrame,
    visits: DataFrame,
    members: DataFrame,
    sets: DataFrame,
    *,
    with_er: bool = True,
    require_both: bool = False,
    before: int = 1,
    after: int = 16,
    index_cohort: DataFrame | None = None,
    key_bits: int | None = KEY_BITS,
) -> DataFrame:
    """The cohort with its first stay (id, start, end) and, with ``with_er``, its first ER date.

    ``index_cohort`` (default: ``cohort``) supplies the person ids and index
    dates; pass a narrow table with the same persons and dates to keep a wide
    cohort's lineage out of the visit matching.
    """
    firsts = first_index_visits(
        cohort if index_cohort is None else index_cohort,
        visits,
        members,
        sets,
        with_er=with_er,
        require_both=require_both,
        before=before,
        after=after,
        key_bits=key_bits,
    )
    return cohort.join(firsts, "person_id", "left")


# ---- look-ups and checks on visits -------------------------------------------------

# The columns of the look-ups.
VISIT_COLUMNS = [
    "person_id", "macrovisit_id", "visit_occurrence_id", "visit_concept_id", "visit_concept_name",
    "visit_start_date", "visit_end_date", "macrovisit_start_date", "macrovisit_end_date",
]


def visit_code_counts(visits: DataFrame, code: int = 9201) -> DataFrame:
    """Per stay: number of visit rows with concept ``code`` (``multi_inpatient_codes``)."""
    return (
        visits.where(F.col("macrovisit_id").isNotNull() & (F.col("visit_concept_id") == code))
        .groupBy("macrovisit_id")
        .agg(F.count("visit_concept_id").alias("multi_inpatient_codes"))
    )


def stay_date_variants(visits: DataFrame) -> DataFrame:
    """Per stay: number of distinct start dates (1 when the stay table is consistent)."""
    return (
        visits.where(F.col("macrovisit_id").isNotNull())
        .groupBy("macrovisit_id")
        .agg(F.count_distinct("macrovisit_start_date").alias("distinct_start_dates"))
    )


def visits_of_stay(visits: DataFrame, stay_id: str) -> DataFrame:
    """Visit rows of one stay, ordered by visit code."""
    return visits.select(*VISIT_COLUMNS).where(F.col("macrovisit_id") == stay_id).orderBy("visit_concept_id")


def stay_timeline(visits: DataFrame, person_id) -> DataFrame:
    """Visit rows of one person that belong to a stay, ordered by stay start."""
    return (
        visits.select(*VISIT_COLUMNS)
        .where(F.col("macrovisit_id").isNotNull() & (F.col("person_id") == person_id))
        .orderBy("macrovisit_start_date")
    )


def busiest(df: DataFrame, key: str) -> DataFrame:
    """The ``key`` value with the most rows, smallest value on a tie (a top-1 report)."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(1).select(key)
