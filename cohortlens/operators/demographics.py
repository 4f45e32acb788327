"""Demographic cleaning of an enriched cohort (T3)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.functions.demographics import age_in_years, birth_date, race_ethnicity, standard_gender, zip5


def clean_demographics(df: DataFrame) -> DataFrame:
    """Add ``date_of_birth``, ``age_at_covid``, ``gender``, ``race_ethnicity``, ``zip_code``.

    One narrow projection: no shuffle, raw columns kept.
    """
    with_birth = df.withColumn("date_of_birth", birth_date("year_of_birth", "month_of_birth", "day_of_birth"))
    return with_birth.withColumns(
        {
            "age_at_covid": age_in_years("first_poslab_or_diagnosis_date", "date_of_birth"),
            "gender": standard_gender("gender_concept_name"),
            "race_ethnicity": race_ethnicity("race_concept_name", "ethnicity_concept_name"),
            "zip_code": zip5("zip"),
        }
    )
