"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the whole test tables in ``sf_dir`` through the bindings and runs
one operator (or composition) of the library on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.demographics import age_in_years, birth_date, race_ethnicity, standard_gender, zip5
from cohortlens.operators.concepts import er_concepts
from cohortlens.operators.enrich import INDEX_DATE, enrich, sample_cohort, sample_rows, with_death
from cohortlens.operators.events import events_in_window
from cohortlens.operators.flags import event_flags, flag_names, person_flags
from cohortlens.operators.visits import (
    busiest,
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
from cohortlens.plans.fact import FactOptions, clean_cohort, cohort_with_flags, index_cohort, later_stays, person_fact
from cohortlens.sources.bindings import INPATIENT, bound_tables, index_rows, read_test_tables
from cohortlens.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

# er_visits_both matches nothing on the test tables with the default window,
# so its query widens the window to keep the check non-empty.
WIDE = dict(before=90, after=180)


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return bound_tables(spark, sf_dir)


def _birth(df: DataFrame) -> DataFrame:
    return df.withColumn("date_of_birth", birth_date("year_of_birth", "month_of_birth", "day_of_birth"))


def q_sample_cohort(spark, sf_dir):
    return sample_cohort(_t(spark, sf_dir).cohort)


def q_sample_cohort_half(spark, sf_dir):
    return sample_cohort(_t(spark, sf_dir).cohort, 0.5)


def q_sample_rows_half(spark, sf_dir):
    return sample_rows(_t(spark, sf_dir).conditions, 0.5)


def q_enrich_locations(spark, sf_dir):
    t = _t(spark, sf_dir)
    return enrich(sample_cohort(t.cohort), t.persons, t.location, t.manifest)


def q_clean_demographics(spark, sf_dir):
    return clean_cohort(_t(spark, sf_dir))


def q_birth_date(spark, sf_dir):
    return _birth(_t(spark, sf_dir).persons).select(
        "person_id", "year_of_birth", "month_of_birth", "day_of_birth", "date_of_birth"
    )


def q_age_at_index(spark, sf_dir):
    t = _t(spark, sf_dir)
    joined = _birth(t.cohort.join(t.persons, "person_id", "left"))
    return joined.select(
        "person_id",
        "first_poslab_or_diagnosis_date",
        "date_of_birth",
        age_in_years("first_poslab_or_diagnosis_date", "date_of_birth").alias("age_at_covid"),
    )


def q_standard_gender(spark, sf_dir):
    p = _t(spark, sf_dir).persons
    return p.select("person_id", "gender_concept_name", standard_gender("gender_concept_name").alias("gender"))


def q_race_ethnicity(spark, sf_dir):
    p = _t(spark, sf_dir).persons
    return p.select(
        "person_id",
        "race_concept_name",
        "ethnicity_concept_name",
        race_ethnicity("race_concept_name", "ethnicity_concept_name").alias("race_ethnicity"),
    )


def q_zip5(spark, sf_dir):
    loc = _t(spark, sf_dir).location
    return loc.select("location_id", "zip", zip5("zip").alias("zip_code"))


def _flags_by_date(t: Tables):
    names = flag_names(t.sets)
    return event_flags(index_cohort(t), t.conditions, t.members, t.sets, names), names


def q_comorbidity_by_visit(spark, sf_dir):
    return _flags_by_date(_t(spark, sf_dir))[0]


def q_comorbidity_until_index(spark, sf_dir):
    t = _t(spark, sf_dir)
    return event_flags(index_cohort(t), t.conditions, t.members, t.sets, until=INDEX_DATE)


def q_comorbidity_by_person(spark, sf_dir):
    by_date, names = _flags_by_date(_t(spark, sf_dir))
    return person_flags(by_date, names)


def q_person_with_comorbidities(spark, sf_dir):
    t = _t(spark, sf_dir)
    return cohort_with_flags(t, clean_cohort(t), persons=index_cohort(t))


def q_er_concepts(spark, sf_dir):
    t = _t(spark, sf_dir)
    return er_concepts(t.members, t.sets)


def _er(spark, sf_dir, **window):
    t = _t(spark, sf_dir)
    return er_visits_near(index_cohort(t), t.visits, t.members, t.sets, **window)


def q_er_visits_either(spark, sf_dir):
    return _er(spark, sf_dir)


def q_er_visits_both(spark, sf_dir):
    return _er(spark, sf_dir, require_both=True, **WIDE)


def _hosp(spark, sf_dir, **window):
    t = _t(spark, sf_dir)
    return hospital_stays_near(index_cohort(t), t.visits, **window)


def q_hosp_either(spark, sf_dir):
    return _hosp(spark, sf_dir)


def q_hosp_both(spark, sf_dir):
    return _hosp(spark, sf_dir, require_both=True)


def q_first_hosp(spark, sf_dir):
    return first_stay(_hosp(spark, sf_dir))


def q_first_er(spark, sf_dir):
    return first_er(_er(spark, sf_dir))


def q_first_visits(spark, sf_dir):
    t = _t(spark, sf_dir)
    return first_index_visits(index_cohort(t), t.visits, t.members, t.sets)


def q_first_visits_full_outer(spark, sf_dir):
    t = _t(spark, sf_dir)
    base = index_cohort(t)
    return first_visits(
        first_stay(hospital_stays_near(base, t.visits)),
        first_er(er_visits_near(base, t.visits, t.members, t.sets)),
    )


def q_first_visits_hosp_only(spark, sf_dir):
    t = _t(spark, sf_dir)
    base = index_cohort(t)
    out = index_visits(base, t.visits, t.members, t.sets, with_er=False)
    return out.select(
        "person_id", "macrovisit_id", "first_COVID_hospitalization_start_date", "first_COVID_hospitalization_end_date"
    )


def q_covid_visits(spark, sf_dir):
    t = _t(spark, sf_dir)
    base = index_cohort(t)
    return index_visits(cohort_with_flags(t, clean_cohort(t), persons=base), t.visits, t.members, t.sets, index_cohort=base)


def q_person_fact(spark, sf_dir):
    return person_fact(_t(spark, sf_dir), FactOptions())


def q_person_death(spark, sf_dir):
    t = _t(spark, sf_dir)
    return with_death(person_fact(t), t.death)


def q_person_death_earliest(spark, sf_dir):
    t = _t(spark, sf_dir)
    return with_death(index_cohort(t), t.death, earliest=True)


def q_visits_near_any_index(spark, sf_dir):
    index = index_rows(read_test_tables(spark, sf_dir)["orders"])
    visits = _t(spark, sf_dir).visits.select("person_id", "visit_occurrence_id", "visit_start_date")
    return events_in_window(index, visits, index_date="index_date", event_date="visit_start_date", before=1, after=16, many=True)


def q_stays_after_index(spark, sf_dir):
    return later_stays(_t(spark, sf_dir))


def q_inpatient_codes_per_stay(spark, sf_dir):
    return visit_code_counts(_t(spark, sf_dir).visits, INPATIENT)


def q_distinct_dates_per_stay(spark, sf_dir):
    return stay_date_variants(_t(spark, sf_dir).visits)


def q_visits_of_stay(spark, sf_dir):
    v = _t(spark, sf_dir).visits
    return visits_of_stay(v, busiest(v, "macrovisit_id").first()[0])


def q_stay_timeline(spark, sf_dir):
    v = _t(spark, sf_dir).visits
    return stay_timeline(v, busiest(v.where(F.col("macrovisit_id").isNotNull()), "person_id").first()[0])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
