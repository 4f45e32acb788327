"""Column functions: pure expressions, kept inside whole-stage codegen."""

from cohortlens.functions.demographics import (
    age_in_years,
    birth_date,
    race_ethnicity,
    standard_gender,
    zip5,
)
from cohortlens.functions.windows import days_between, near

__all__ = [
    "age_in_years",
    "birth_date",
    "days_between",
    "near",
    "race_ethnicity",
    "standard_gender",
    "zip5",
]
