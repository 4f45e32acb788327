"""DataFrame operators: joins, aggregates and windows on person-keyed tables."""

from cohortlens.operators.checks import unique
from cohortlens.operators.concepts import comorbidity_concepts, current_members, er_concepts
from cohortlens.operators.demographics import clean_demographics
from cohortlens.operators.enrich import enrich, sample_cohort, sample_rows, with_death
from cohortlens.operators.events import events_in_window, first_event
from cohortlens.operators.flags import event_flags, flag_names, person_flags, with_person_flags
from cohortlens.operators.joins import left_lookup, split_hot_keys
from cohortlens.operators.stays import stays_after
from cohortlens.operators.visits import (
    er_visits_near,
    first_er,
    first_index_visits,
    first_stay,
    first_visits,
    hospital_stays_near,
    index_visits,
    stay_date_variants,
    stay_timeline,
    visit_code_counts,
    visits_of_stay,
)

__all__ = [
    "clean_demographics",
    "comorbidity_concepts",
    "current_members",
    "enrich",
    "er_concepts",
    "er_visits_near",
    "event_flags",
    "events_in_window",
    "first_er",
    "first_event",
    "first_index_visits",
    "first_stay",
    "first_visits",
    "flag_names",
    "hospital_stays_near",
    "index_visits",
    "left_lookup",
    "person_flags",
    "sample_cohort",
    "sample_rows",
    "split_hot_keys",
    "stay_date_variants",
    "stay_timeline",
    "stays_after",
    "unique",
    "visit_code_counts",
    "visits_of_stay",
    "with_death",
    "with_person_flags",
]
