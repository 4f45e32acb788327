"""T4/T5: concept flags per date and per person."""

from cohortlens.operators.flags import coded_events, event_flags, flag_names, person_words, with_flags, with_person_flags
from tests.util import as_set, d, frame

SETS = [
    dict(concept_set_name="A1", column_name="fa", domain="condition_occurrence", comorbidity=1, er_only_visit=0),
    dict(concept_set_name="A2", column_name="fa", domain="condition_occurrence", comorbidity=1, er_only_visit=0),
    dict(concept_set_name="B", column_name="fb", domain="condition_occurrence,drug_exposure", comorbidity=1),
    dict(concept_set_name="E", column_name="fe", domain="condition_occurrence", comorbidity=1),  # no events
    dict(concept_set_name="N", column_name=None, domain="condition_occurrence", comorbidity=1),
    dict(concept_set_name="D", column_name="fd", domain="drug_exposure", comorbidity=1),
    dict(concept_set_name="Z", column_name="fz", domain="condition_occurrence", comorbidity=0),
]
MEMBERS = [
    (10, "A1", True), (10, "A2", True),  # one concept in two sets of one flag
    (11, "A1", False),  # retired
    (20, "B", True), (30, "D", True), (40, "Z", True), (50, "N", True), (60, "E", False),
]


def _tables(spark):
    sets = frame(spark, "sets", SETS)
    members = frame(spark, "members", [dict(concept_id=c, concept_set_name=n, is_most_recent_version=v) for c, n, v in MEMBERS])
    cohort = frame(spark, "cohort", [dict(person_id=p, first_poslab_or_diagnosis_date=d("2020-06-01")) for p in (1, 2, 3)])
    conditions = frame(spark, "conditions", [
        dict(person_id=1, condition_start_date=d("2019-01-01"), condition_concept_id=10),
        dict(person_id=1, condition_start_date=d("2019-01-01"), condition_concept_id=20),
        dict(person_id=1, condition_start_date=d("2021-01-01"), condition_concept_id=20),  # after index: counts
        dict(person_id=1, condition_start_date=None, condition_concept_id=10),  # no date: dropped
        dict(person_id=2, condition_start_date=d("2019-01-01"), condition_concept_id=11),  # retired
        dict(person_id=2, condition_start_date=d("2019-01-01"), condition_concept_id=30),  # drug domain only
        dict(person_id=2, condition_start_date=d("2019-01-01"), condition_concept_id=40),  # not a comorbidity
        dict(person_id=9, condition_start_date=d("2019-01-01"), condition_concept_id=10),  # outside the cohort
    ])
    return cohort, conditions, members, sets


def test_flag_names_fixed(spark):
    _, _, _, sets = _tables(spark)
    assert flag_names(sets) == ["fa", "fb", "fe"]


def test_event_flags(spark):
    cohort, conditions, members, sets = _tables(spark)
    out = event_flags(cohort, conditions, members, sets)
    assert out.columns == ["person_id", "comorbidity_start_date", "fa", "fb", "fe"]
    assert dict(out.dtypes)["fa"] == "int"
    assert as_set(out) == {
        (1, d("2019-01-01"), 1, 1, 0),
        (1, d("2021-01-01"), 0, 1, 0),
    }


def test_person_flags_fill_zero(spark):
    cohort, conditions, members, sets = _tables(spark)
    names = flag_names(sets)
    out = with_person_flags(cohort, event_flags(cohort, conditions, members, sets, names), names)
    assert out.count() == 3
    assert as_set(out, "person_id", "fa", "fb", "fe") == {(1, 1, 1, 0), (2, 0, 0, 0), (3, 0, 0, 0)}
    assert out.where("fa is null or fb is null or fe is null").count() == 0


def test_explicit_names_restrict(spark):
    cohort, conditions, members, sets = _tables(spark)
    out = event_flags(cohort, conditions, members, sets, ["fb"])
    assert as_set(out) == {(1, d("2019-01-01"), 1), (1, d("2021-01-01"), 1)}


def test_string_version_flag(spark):
    cohort, conditions, members, sets = _tables(spark)
    as_text = members.withColumn("is_most_recent_version", members.is_most_recent_version.cast("string"))
    a = event_flags(cohort, conditions, as_text, sets)
    b = event_flags(cohort, conditions, members, sets)
    assert as_set(a) == as_set(b)


def test_until_bounds_conditions_by_cohort_date(spark):
    cohort, conditions, members, sets = _tables(spark)
    out = event_flags(cohort, conditions, members, sets, until="first_poslab_or_diagnosis_date")
    assert as_set(out) == {(1, d("2019-01-01"), 1, 1, 0)}  # the 2021 condition is after the index date
    from pyspark.sql import functions as F

    no_date = cohort.withColumn("first_poslab_or_diagnosis_date", F.lit(None).cast("date"))
    assert event_flags(no_date, conditions, members, sets, until="first_poslab_or_diagnosis_date").count() == 0


def test_written_concept_list_gives_the_same_flags(spark, scratch):
    from cohortlens.operators.concepts import comorbidity_concepts

    cohort, conditions, members, sets = _tables(spark)
    comorbidity_concepts(members, sets).write.parquet(f"{scratch}/concepts")
    written = spark.read.parquet(f"{scratch}/concepts")
    assert as_set(event_flags(cohort, conditions, members, sets, concepts=written)) == as_set(event_flags(cohort, conditions, members, sets))


def test_flag_bound_is_an_argument(spark):
    import pytest

    sets = _tables(spark)[3]
    with pytest.raises(ValueError, match="max_flags"):
        flag_names(sets, 2)
    assert len(flag_names(sets, 3)) == 3


def test_two_thousand_flags_in_generated_code(spark, scratch):
    """Thirty-two words instead of 2,000 conditional aggregates; equal to a plain count."""
    import random
    import re

    rng = random.Random(2)
    names = [f"f{i:04d}" for i in range(2000)]
    sets = frame(spark, "sets", [dict(concept_set_name=n, column_name=n, domain="condition_occurrence", comorbidity=1) for n in names])
    of = {c: rng.sample(names, rng.randint(1, 3)) for c in range(3000)}
    members = frame(spark, "members", [dict(concept_id=c, concept_set_name=n, is_most_recent_version=True) for c, own in of.items() for n in own])
    seen = [(rng.randint(1, 20), f"2020-01-{rng.randint(1, 9):02d}", rng.randrange(3100)) for _ in range(4000)]
    conditions = frame(spark, "conditions", [dict(person_id=p, condition_start_date=d(x), condition_concept_id=c) for p, x, c in seen])
    cohort = frame(spark, "cohort", [dict(person_id=p) for p in range(1, 16)])
    out = event_flags(cohort, conditions, members, sets, names)
    got = {(r[0], r[1]): {n for n, v in zip(names, r[2:]) if v} for r in out.collect()}
    want = {}
    for p, x, c in seen:
        if p < 16 and c in of:
            want.setdefault((p, d(x)), set()).update(of[c])
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    aggregates = re.findall(r"(\*\(\d+\) )?HashAggregate\(keys=\[person_id", plan.split("Initial Plan")[0])
    assert aggregates and all(aggregates)  # all within whole-stage code generation
    assert len(re.findall(r"bit_or", plan)) < 2000
    out.write.parquet(f"{scratch}/flags")
    whole = with_person_flags(cohort, spark.read.parquet(f"{scratch}/flags"), names)
    by_person = {p: set().union(*[own for (q, _), own in want.items() if q == p]) for p in range(1, 16)}
    assert {r["person_id"]: {n for n in names if r[n]} for r in whole.collect()} == by_person
    lazy = with_flags(cohort, person_words(coded_events(cohort, conditions, members, sets, names), names), names)
    assert {r["person_id"]: {n for n in names if r[n]} for r in lazy.collect()} == by_person


def test_flags_at_the_edges_of_words(spark):
    names = [f"g{i}" for i in range(127)]
    sets = frame(spark, "sets", [dict(concept_set_name=n, column_name=n, domain="condition_occurrence", comorbidity=1) for n in names])
    members = frame(spark, "members", [dict(concept_id=i, concept_set_name=n, is_most_recent_version=True) for i, n in enumerate(names)])
    chosen = sorted(names)
    for picked in ([0, 62], [63], [62, 63, 125, 126], list(range(127))):
        conditions = frame(spark, "conditions", [dict(person_id=1, condition_start_date=d("2020-01-01"), condition_concept_id=int(chosen[i][1:])) for i in picked])
        row = event_flags(frame(spark, "cohort", [dict(person_id=1)]), conditions, members, sets).collect()[0]
        assert [row[n] for n in chosen] == [int(i in picked) for i in range(127)]
