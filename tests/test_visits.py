"""T6: window edges, the both-dates rule, first stay and ER, full outer merge."""

import datetime as dt

from cohortlens.operators.visits import (
    FIRST_ER,
    FIRST_STAY_END,
    FIRST_STAY_START,
    er_visit_rows,
    er_visits_near,
    first_index_visits,
    first_stay,
    hospital_stays_near,
    index_visits,
)
from tests.util import as_set, d, frame

IDX = "2020-06-10"


def _cohort(spark, rows):
    return frame(spark, "cohort", rows)


def _stay_visit(pid, sid, start, end=None, concept=9201):
    return dict(person_id=pid, visit_concept_id=concept, visit_start_date=d(start), macrovisit_id=sid,
                macrovisit_start_date=d(start), macrovisit_end_date=d(end))


def _er_visit(pid, date, concept=9203):
    return dict(person_id=pid, visit_concept_id=concept, visit_start_date=d(date))


def _sets(spark):
    return frame(spark, "sets", [dict(concept_set_name="ER", column_name="er", domain="visit_occurrence",
                                      comorbidity=0, er_only_visit=1)])


def _members(spark, rows=((9203, "ER", True), (9202, "ER", False))):
    return frame(spark, "members", [dict(concept_id=c, concept_set_name=n, is_most_recent_version=v) for c, n, v in rows])


def test_window_edges_either(spark):
    cohort = _cohort(spark, [dict(person_id=1, first_pos_pcr_antigen_date=d(IDX), first_poslab_or_diagnosis_date=d(IDX)),
                             dict(person_id=2, first_poslab_or_diagnosis_date=None)])
    offsets = {"a": -2, "b": -1, "c": 0, "e": 16, "f": 17}
    base = dt.date.fromisoformat(IDX)
    rows = [_stay_visit(1, k, str(base + dt.timedelta(days=v))) for k, v in offsets.items()]
    rows += [_stay_visit(2, "z", IDX), dict(person_id=1, macrovisit_id="n", macrovisit_start_date=None)]
    got = as_set(hospital_stays_near(cohort, frame(spark, "visits", rows)), "macrovisit_id")
    assert got == {("b",), ("c",), ("e",)}


def test_both_dates_rule(spark):
    lab = dt.date.fromisoformat(IDX)
    dx = {1: None, 2: lab + dt.timedelta(-2), 3: lab + dt.timedelta(-1), 4: lab + dt.timedelta(16),
          5: lab + dt.timedelta(17), 6: lab}
    rows = [dict(person_id=p, first_pos_pcr_antigen_date=lab, first_pos_diagnosis_date=x,
                 first_poslab_or_diagnosis_date=min(lab, x or lab)) for p, x in dx.items()]
    rows.append(dict(person_id=7, first_pos_diagnosis_date=lab, first_poslab_or_diagnosis_date=lab))  # lab null
    cohort = _cohort(spark, rows)
    visits = frame(spark, "visits", [_stay_visit(p, f"s{p}", IDX) for p in range(1, 8)])
    got = as_set(hospital_stays_near(cohort, visits, require_both=True), "person_id")
    assert got == {(3,), (4,), (6,)}
    either = as_set(hospital_stays_near(cohort, visits), "person_id")
    assert either == {(p,) for p in range(1, 8)}  # each index date is within -1..+16 of the stay


def test_first_stay_ties_and_null_end(spark):
    cohort = _cohort(spark, [dict(person_id=1, first_poslab_or_diagnosis_date=d(IDX)),
                             dict(person_id=2, first_poslab_or_diagnosis_date=d(IDX)),
                             dict(person_id=3, first_poslab_or_diagnosis_date=d(IDX))])
    visits = frame(spark, "visits", [
        _stay_visit(1, "b", IDX, "2020-06-20"), _stay_visit(1, "a", IDX, "2020-06-30"),  # same start: smaller end
        _stay_visit(1, "c", "2020-06-11", "2020-06-12"),
        _stay_visit(2, "x", IDX, "2020-06-20"), _stay_visit(2, "y", IDX, None),  # end null comes first
        _stay_visit(3, "m", IDX, "2020-06-15"), _stay_visit(3, "m", IDX, "2020-06-15"),  # one stay, many rows
        _stay_visit(3, "k", "2020-06-12", None),
    ])
    near = hospital_stays_near(cohort, visits)
    want = {(1, "b", d(IDX), d("2020-06-20")), (2, "y", d(IDX), None), (3, "m", d(IDX), d("2020-06-15"))}
    cols = ("person_id", "macrovisit_id", FIRST_STAY_START, FIRST_STAY_END)
    assert as_set(first_stay(near), *cols) == want


def test_er_only_rules(spark):
    cohort = _cohort(spark, [dict(person_id=p, first_poslab_or_diagnosis_date=d(IDX)) for p in (1, 2, 3, 4)])
    visits = frame(spark, "visits", [
        _er_visit(1, IDX),
        _er_visit(1, "2020-06-12"),
        _er_visit(2, IDX, concept=9202),  # retired ER concept
        dict(_stay_visit(3, "s", IDX), visit_concept_id=9203),  # ER concept inside a stay: not ER-only
        _er_visit(4, "2020-07-30"),  # outside the window
    ])
    got = er_visits_near(cohort, visits, _members(spark), _sets(spark))
    assert as_set(got) == {(1, d(IDX)), (1, d("2020-06-12"))}
    assert er_visit_rows(visits, _members(spark, ()), _sets(spark)).count() == 0  # empty ER list


def test_first_visits_kinds(spark):
    cohort = _cohort(spark, [dict(person_id=p, first_poslab_or_diagnosis_date=d(IDX)) for p in (1, 2, 3, 4)])
    visits = frame(spark, "visits", [
        _stay_visit(1, "s1", IDX, "2020-06-12"),  # stay only
        _er_visit(2, "2020-06-11"),  # ER only
        _stay_visit(3, "s3", "2020-06-15"), _er_visit(3, "2020-06-09"),  # both
    ])
    firsts = first_index_visits(cohort, visits, _members(spark), _sets(spark))
    cols = ("person_id", "macrovisit_id", FIRST_STAY_START, FIRST_STAY_END, FIRST_ER)
    assert as_set(firsts, *cols) == {
        (1, "s1", d(IDX), d("2020-06-12"), None),
        (2, None, None, None, d("2020-06-11")),
        (3, "s3", d("2020-06-15"), None, d("2020-06-09")),
    }
    full = index_visits(cohort, visits, _members(spark), _sets(spark))
    assert full.count() == 4 and as_set(full.where("person_id = 4"), *cols) == {(4, None, None, None, None)}
    hosp_only = index_visits(cohort, visits, _members(spark), _sets(spark), with_er=False)
    assert FIRST_ER not in hosp_only.columns
    assert as_set(hosp_only.where("macrovisit_id is not null"), "person_id") == {(1,), (3,)}


def test_single_pass_equals_full_outer(spark):
    import random

    from cohortlens.operators.visits import first_er, first_visits

    rng = random.Random(11)
    base = dt.date(2020, 6, 1)
    cohort_rows, visit_rows = [], []
    for p in range(80):
        lab = base + dt.timedelta(rng.randint(0, 30)) if rng.random() < 0.9 else None
        dx = base + dt.timedelta(rng.randint(0, 30)) if rng.random() < 0.8 else None
        idx = min([x for x in (lab, dx) if x], default=None)
        cohort_rows.append(dict(person_id=p, first_pos_pcr_antigen_date=lab, first_pos_diagnosis_date=dx,
                                first_poslab_or_diagnosis_date=idx))
        for v in range(rng.randint(0, 8)):
            day = str(base + dt.timedelta(rng.randint(-5, 50)))
            if rng.random() < 0.5:
                sid = f"{p}-{rng.randint(0, 3)}"
                end = str(base + dt.timedelta(rng.randint(50, 60))) if rng.random() < 0.7 else None
                visit_rows.append(_stay_visit(p, sid, day, end, concept=rng.choice([9201, 9202, 9203])))
            else:
                visit_rows.append(_er_visit(p, day, concept=rng.choice([9202, 9203, 9203])))
    cohort = _cohort(spark, cohort_rows)
    visits = frame(spark, "visits", visit_rows)
    members, sets = _members(spark), _sets(spark)
    cols = ("person_id", "macrovisit_id", FIRST_STAY_START, FIRST_STAY_END, FIRST_ER)
    for window in (dict(), dict(require_both=True, before=5, after=20)):
        single = first_index_visits(cohort, visits, members, sets, **window)
        outer = first_visits(
            first_stay(hospital_stays_near(cohort, visits, **window)),
            first_er(er_visits_near(cohort, visits, members, sets, **window)),
        )
        assert as_set(single, *cols) == as_set(outer, *cols)
        assert single.count() == outer.count() > 0


def test_semi_join_equals_collected_isin(spark):
    """The semi join gives the rows of a membership test."""
    from pyspark.sql import functions as F

    from cohortlens.operators.concepts import er_concepts
    from cohortlens.sources.bindings import bound_tables

    t = bound_tables(spark, "/root/testdata/sf0.001")
    ids = [r.concept_id for r in er_concepts(t.members, t.sets).collect()]
    literal = (
        t.visits.where(F.col("macrovisit_start_date").isNull() & F.col("visit_concept_id").isin(ids))
        .select("person_id", "visit_start_date")
        .distinct()
    )
    assert as_set(er_visit_rows(t.visits, t.members, t.sets)) == as_set(literal)
    assert literal.count() > 0


def test_span_prefilter_is_exact(spark):
    from cohortlens.functions.windows import within_span

    cohort = _cohort(spark, [dict(person_id=1, first_poslab_or_diagnosis_date=d("2020-06-10")),
                             dict(person_id=2, first_poslab_or_diagnosis_date=d("2020-07-01")),
                             dict(person_id=3, first_poslab_or_diagnosis_date=None)])
    days = spark.createDataFrame([(d(x),) for x in ("2020-06-08", "2020-06-09", "2020-07-17", "2020-07-18", "2015-01-01")],
                                 "day date")
    kept = {r.day.isoformat() for r in days.where(within_span("day", cohort, "first_poslab_or_diagnosis_date", 1, 16)).collect()}
    assert kept == {"2020-06-09", "2020-07-17"}
    empty = cohort.where("first_poslab_or_diagnosis_date is null")
    assert days.where(within_span("day", empty, "first_poslab_or_diagnosis_date", 1, 16)).count() == 0


def test_lookups_by_id_are_ordered_and_match_the_registered_queries(spark):
    import __spark_entry__ as entry_mod
    from cohortlens.operators.visits import stay_timeline, visits_of_stay
    from cohortlens.sources.bindings import bound_tables

    sf = "/root/testdata/sf0.01"
    t = bound_tables(spark, sf)
    # the ids the survey names for sf0.01
    stay = visits_of_stay(t.visits, "4379").collect()
    person = stay_timeline(t.visits, 1242).collect()
    assert len(stay) == 13 and len(person) == 83
    assert [r.visit_concept_id for r in stay] == sorted(r.visit_concept_id for r in stay)
    assert [r.macrovisit_start_date for r in person] == sorted(r.macrovisit_start_date for r in person)
    assert all(r.macrovisit_id is not None and r.person_id == 1242 for r in person)
    cols = stay[0].__fields__
    q_stay = entry_mod.queries()["visits_of_stay"](spark, sf).collect()
    assert sorted(tuple(r) for r in q_stay) == sorted(tuple(r) for r in stay) and q_stay[0].__fields__ == cols
    for df in (visits_of_stay(t.visits, "4379"), stay_timeline(t.visits, 1242)):  # the id is in the scan's filters
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "4379" in plan or "EqualTo(o_custkey,1242)" in plan
