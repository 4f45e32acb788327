"""Properties: Column functions against plain-Python statements of the same rules,
and invariants of the person fact on the bound test tables."""

import calendar
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.functions.demographics import RACE_ETHNICITY_RULES, age_in_years, race_ethnicity, zip5
from cohortlens.plans.fact import person_fact
from cohortlens.operators.stays import stays_after
from cohortlens.sources.bindings import bound_tables

SETTINGS = settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

TOKENS = sorted({r[2] for r in RACE_ETHNICITY_RULES} | {"white", "African", "Barbadian", " ", "x"})


def py_race(race, eth):
    for source, kind, text, label in RACE_ETHNICITY_RULES:
        value = race if source == "race" else eth
        if value is not None and (value == text if kind == "equals" else text in value):
            return label
    return "UNKNOWN"


def py_zip(z):
    if z is None:
        return None
    z = z.strip(" ")
    five = z[:5] if len(z) >= 5 else None
    return five if five is not None and re.search("[0-9]{5}", five) else None


def py_age(at, born):
    months = 12 * (at.year - born.year) + (at.month - born.month)
    month_end = lambda x: x.day == calendar.monthrange(x.year, x.month)[1]
    if at.day != born.day and not (month_end(at) and month_end(born)) and at.day < born.day:
        months -= 1
    return months // 12


races = st.one_of(st.none(), st.lists(st.sampled_from(TOKENS), min_size=1, max_size=3).map(" ".join))
eths = st.one_of(st.none(), st.sampled_from(["Hispanic or Latino", "Not Hispanic or Latino", "Hispanic"]))
zips = st.one_of(st.none(), st.text(alphabet="0123456789 -A", max_size=11))
dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2030, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(races, eths), min_size=1, max_size=200))
def test_race_ethnicity_matches_rules(spark, rows):
    df = spark.createDataFrame(rows, "race string, eth string")
    got = [r[0] for r in df.select(race_ethnicity("race", "eth")).collect()]
    assert got == [py_race(r, e) for r, e in rows]


@SETTINGS
@given(st.lists(zips, min_size=1, max_size=200))
def test_zip5_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "z string")
    got = [r[0] for r in df.select(zip5("z")).collect()]
    assert got == [py_zip(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=300))
def test_age_matches_completed_years(spark, pairs):
    df = spark.createDataFrame(pairs, "at date, born date")
    got = [r[0] for r in df.select(age_in_years("at", "born")).collect()]
    assert got == [py_age(a, b) for a, b in pairs]


SF = "/root/testdata/sf0.001"


def test_fact_invariants(spark):
    t = bound_tables(spark, SF)
    fact = person_fact(t)
    cohort_rows = t.cohort.where(F.col("first_poslab_or_diagnosis_date").isNotNull()).count()
    assert fact.count() == cohort_rows == fact.select("person_id").distinct().count()
    for flag in ("large_flag", "noevent_flag", "promo_flag", "small_flag"):
        assert fact.where(~F.col(flag).isin(0, 1) | F.col(flag).isNull()).count() == 0
    assert fact.where("noevent_flag = 1").count() == 0
    lag = F.datediff("first_COVID_hospitalization_start_date", "first_poslab_or_diagnosis_date")
    assert fact.where(lag.isNotNull() & ~lag.between(-1, 16)).count() == 0
    er_lag = F.datediff("first_covid_er_only_start_date", "first_poslab_or_diagnosis_date")
    assert fact.where(er_lag.isNotNull() & ~er_lag.between(-1, 16)).count() == 0
    later = stays_after(fact, t.visits)
    anchor = F.coalesce("first_COVID_hospitalization_start_date", "first_poslab_or_diagnosis_date")
    assert later.where(~(anchor < F.col("macrovisit_start_date"))).count() == 0


def test_fact_unchanged_by_input_order(spark):
    t = bound_tables(spark, SF)
    shuffled = t.replace(
        visits=t.visits.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5)),
        conditions=t.conditions.repartition(5, F.rand(4)),
        cohort=t.cohort.repartition(3, F.rand(6)),
    )
    a, b = person_fact(t), person_fact(shuffled)
    cols = sorted(a.columns)
    rows = lambda df: sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    assert rows(a) == rows(b)
