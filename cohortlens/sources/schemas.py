"""Declared schemas of the nine clinical inputs.

Columns are read by name and cast to these types (timestamps become dates);
a declared column that an input lacks is an error.  Inputs in ``OPEN`` pass
their other columns on.
"""

from pyspark.sql import types as T

_L, _I, _S, _D, _B = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


COHORT = _struct(
    ("person_id", _L),
    ("first_pos_pcr_antigen_date", _D),
    ("first_pos_diagnosis_date", _D),
    ("first_poslab_or_diagnosis_date", _D),
    ("first_antigen_or_poslab_or_diagnosis_date", _D),
)

PERSONS = _struct(
    ("person_id", _L),
    ("year_of_birth", _I),
    ("month_of_birth", _I),
    ("day_of_birth", _I),
    ("ethnicity_concept_name", _S),
    ("race_concept_name", _S),
    ("gender_concept_name", _S),
    ("location_id", _L),
    ("data_partner_id", _L),
)

LOCATION = _struct(
    ("location_id", _L),
    ("city", _S),
    ("state", _S),
    ("zip", _S),
    ("county", _S),
)

MANIFEST = _struct(
    ("data_partner_id", _L),
    ("run_date", _D),
    ("cdm_name", _S),
    ("cdm_version", _S),
    ("shift_date_yn", _S),
    ("max_num_shift_days", _I),
)

VISITS = _struct(
    ("person_id", _L),
    ("visit_occurrence_id", _L),
    ("visit_concept_id", _I),
    ("visit_concept_name", _S),
    ("visit_start_date", _D),
    ("visit_end_date", _D),
    ("macrovisit_id", _S),
    ("macrovisit_start_date", _D),
    ("macrovisit_end_date", _D),
)

MEMBERS = _struct(
    ("concept_id", _L),
    ("concept_set_name", _S),
    ("is_most_recent_version", _B),
)

SETS = _struct(
    ("concept_set_name", _S),
    ("column_name", _S),
    ("domain", _S),
    ("comorbidity", _I),
    ("er_only_visit", _I),
)

CONDITIONS = _struct(
    ("person_id", _L),
    ("condition_start_date", _D),
    ("condition_concept_id", _L),
)

DEATH = _struct(
    ("person_id", _L),
    ("data_partner_id", _L),
    ("death_date", _D),
)

BY_NAME = {
    "cohort": COHORT,
    "persons": PERSONS,
    "location": LOCATION,
    "manifest": MANIFEST,
    "visits": VISITS,
    "members": MEMBERS,
    "sets": SETS,
    "conditions": CONDITIONS,
    "death": DEATH,
}

# Inputs whose further columns reach the outputs.
OPEN = frozenset({"cohort", "death"})

# Columns that an input may have besides: its layout (``sources.layout``).
OPTIONAL = {"visits": _struct(("event_day", _D))}
