"""T3a-T3e on hand-made rows, including ANSI mode on and off."""

import datetime as dt

import pytest

from cohortlens.functions.demographics import (
    RACE_ETHNICITY_RULES,
    age_in_years,
    birth_date,
    race_ethnicity,
    standard_gender,
    zip5,
)

BIRTH_CASES = [
    # year, month, day, expected
    (1980, 5, 17, dt.date(1980, 5, 17)),
    (1980, 3, 4, dt.date(1980, 3, 4)),  # single-digit parts
    (None, 5, 17, None),  # missing year -> "1-5-17" is no date
    (1980, None, 17, dt.date(1980, 1, 17)),
    (1980, 5, None, dt.date(1980, 5, 1)),
    (None, None, None, None),
    (1981, 2, 30, None),  # Feb 30
    (1981, 13, 1, None),  # month 13
    (1980, 2, 29, dt.date(1980, 2, 29)),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_birth_date(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([c[:3] for c in BIRTH_CASES], "y int, m int, d int")
        got = [r[0] for r in df.select(birth_date("y", "m", "d")).collect()]
        assert got == [c[3] for c in BIRTH_CASES]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


AGE_CASES = [
    # at, born, expected
    ("2020-05-16", "1980-05-17", 39),  # day before the birthday
    ("2020-05-17", "1980-05-17", 40),  # on the birthday
    ("2021-02-28", "1980-02-29", 41),  # both month ends: counts as the birthday
    ("2020-02-28", "1980-02-29", 39),  # leap year: Feb 28 is not the month end
    ("2020-02-29", "1980-02-29", 40),
    ("1979-12-31", "1980-01-01", -1),  # before birth
    ("2020-01-01", None, None),
]


def test_age_in_years(spark):
    rows = [(dt.date.fromisoformat(a), b and dt.date.fromisoformat(b)) for a, b, _ in AGE_CASES]
    df = spark.createDataFrame(rows, "at date, born date")
    out = df.select(age_in_years("at", "born").alias("age"))
    assert dict(out.dtypes)["age"] == "bigint"
    assert [r[0] for r in out.collect()] == [c[2] for c in AGE_CASES]


def test_standard_gender(spark):
    values = ["male", "MALE", "Male", " male ", "female", "FEMALE", "No matching concept", None]
    df = spark.createDataFrame([(v,) for v in values], "g string")
    got = [r[0] for r in df.select(standard_gender("g")).collect()]
    assert got == ["MALE", "MALE", "MALE", "UNKNOWN", "FEMALE", "FEMALE", "UNKNOWN", "UNKNOWN"]


RACE_CASES = [
    # race, ethnicity, expected
    ("White", "Hispanic or Latino", "Hispanic or Latino Any Race"),
    ("Hispanic White", None, "Hispanic or Latino Any Race"),
    ("Black", None, "Black or African American Non-Hispanic"),
    ("African American", None, "Black or African American Non-Hispanic"),
    ("African", None, "UNKNOWN"),
    ("White", "Not Hispanic or Latino", "White Non-Hispanic"),
    ("white", None, "UNKNOWN"),  # case-sensitive
    ("Asian or Pacific Islander", None, "Unknown"),
    ("Asian", None, "Asian Non-Hispanic"),
    ("Sri Lankan", None, "Asian Non-Hispanic"),
    ("Indonesian", None, "Asian Non-Hispanic"),
    ("Native Hawaiian or Other Pacific Islander", None, "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("Melanesian", None, "Native Hawaiian or Other Pacific Islander Non-Hispanic"),
    ("Other Race", None, "Other Non-Hispanic"),
    ("Multiple races", None, "Other Non-Hispanic"),
    ("More than one population", None, "Other Non-Hispanic"),
    ("Barbadian", None, "UNKNOWN"),
    ("Black Asian", None, "Black or African American Non-Hispanic"),  # two rules: the first wins
    (None, "Hispanic or Latino", "Hispanic or Latino Any Race"),
    (None, None, "UNKNOWN"),
]


def test_race_ethnicity_cases(spark):
    df = spark.createDataFrame([c[:2] for c in RACE_CASES], "race string, eth string")
    got = [r[0] for r in df.select(race_ethnicity("race", "eth")).collect()]
    assert got == [c[2] for c in RACE_CASES]


def test_race_ethnicity_every_rule_reachable(spark):
    """Each rule's own text maps to its label unless an earlier rule catches it."""
    rows = [(text if source == "race" else None, text if source == "ethnicity" else None) for source, _, text, _ in RACE_ETHNICITY_RULES]
    df = spark.createDataFrame(rows, "race string, eth string")
    got = [r[0] for r in df.select(race_ethnicity("race", "eth")).collect()]
    for (source, kind, text, label), value in zip(RACE_ETHNICITY_RULES, got):
        earlier = [
            r for r in RACE_ETHNICITY_RULES[: RACE_ETHNICITY_RULES.index((source, kind, text, label))]
            if r[0] == "race" and source == "race" and (r[2] in text if r[1] == "contains" else r[2] == text)
        ]
        assert value == (earlier[0][3] if earlier else label)


def test_zip5(spark):
    values = [" 20001 ", "30001-1234", "123456789", "4001", "50A01", "", None, "12345", "  1234  "]
    df = spark.createDataFrame([(v,) for v in values], "z string")
    got = [r[0] for r in df.select(zip5("z")).collect()]
    assert got == ["20001", "30001", "12345", None, None, None, None, "12345", None]


def test_clean_is_one_narrow_projection(spark):
    from cohortlens.operators.demographics import clean_demographics

    df = spark.createDataFrame(
        [(1, 1980, 5, 17, "male", "White", None, " 20001 ", dt.date(2020, 5, 17))],
        "person_id long, year_of_birth int, month_of_birth int, day_of_birth int, gender_concept_name string, "
        "race_concept_name string, ethnicity_concept_name string, zip string, first_poslab_or_diagnosis_date date",
    )
    out = clean_demographics(df)
    row = out.collect()[0]
    assert (row.date_of_birth, row.age_at_covid, row.gender, row.race_ethnicity, row.zip_code) == (
        dt.date(1980, 5, 17), 40, "MALE", "White Non-Hispanic", "20001",
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan
    assert out.columns[: len(df.columns)] == df.columns
