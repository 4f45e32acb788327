"""The index-visit match against a plain-Python brute force on a random fixture."""

import datetime as dt
import random

from cohortlens.operators.visits import FIRST_ER, FIRST_STAY_END, FIRST_STAY_START, first_index_visits
from tests.util import frame

ER_CONCEPTS = {9203}  # current ER concept of the fixture's sets


def _fixture(seed=5, people=60):
    rng = random.Random(seed)
    base = dt.date(2021, 1, 1)
    day = lambda lo, hi: base + dt.timedelta(rng.randint(lo, hi))
    cohort, visits = [], []
    for p in range(people):
        lab = day(0, 40) if rng.random() < 0.85 else None
        dx = day(0, 40) if rng.random() < 0.85 else None
        idx = min([x for x in (lab, dx) if x], default=None)
        cohort.append(dict(person_id=p, first_pos_pcr_antigen_date=lab, first_pos_diagnosis_date=dx,
                           first_poslab_or_diagnosis_date=idx))
        for _ in range(rng.randint(0, 10)):
            start = day(-30, 90) if rng.random() < 0.95 else None
            concept = rng.choice([9201, 9202, 9203])
            if rng.random() < 0.5:  # a visit inside a stay
                sid = f"{p}-{rng.randint(0, 4)}"
                end = start + dt.timedelta(rng.randint(0, 5)) if start and rng.random() < 0.8 else None
                visits.append(dict(person_id=p, visit_concept_id=concept, visit_start_date=start, macrovisit_id=sid,
                                   macrovisit_start_date=start, macrovisit_end_date=end))
            else:
                visits.append(dict(person_id=p, visit_concept_id=concept, visit_start_date=start))
    return cohort, visits


def _brute(cohort, visits, *, both, before, after):
    def near(ref, d):
        return ref is not None and d is not None and -after <= (ref - d).days <= before

    out = {}
    for c in cohort:
        p = c["person_id"]
        lab, dx, idx = c["first_pos_pcr_antigen_date"], c["first_pos_diagnosis_date"], c["first_poslab_or_diagnosis_date"]

        def ok(d):
            return (near(lab, d) and near(lab, dx)) if both else near(idx, d)

        stays = {(v["macrovisit_start_date"], v.get("macrovisit_end_date"), v["macrovisit_id"])
                 for v in visits if v["person_id"] == p and v.get("macrovisit_start_date") and ok(v["macrovisit_start_date"])}
        ers = {v["visit_start_date"] for v in visits
               if v["person_id"] == p and not v.get("macrovisit_start_date")
               and v["visit_concept_id"] in ER_CONCEPTS and ok(v["visit_start_date"])}
        if not stays and not ers:
            continue
        key = lambda s: (s[0], s[1] is not None, s[1] or dt.date.min, s[2])  # noqa: E731  start, end nulls first, id
        first = min(stays, key=key) if stays else (None, None, None)
        out[p] = (first[2], first[0], first[1], min(ers) if ers else None)
    return out


def test_first_index_visits_against_brute_force(spark):
    cohort_rows, visit_rows = _fixture()
    cohort = frame(spark, "cohort", cohort_rows)
    visits = frame(spark, "visits", visit_rows)
    members = frame(spark, "members", [dict(concept_id=9203, concept_set_name="ER", is_most_recent_version=True),
                                       dict(concept_id=9202, concept_set_name="ER", is_most_recent_version=False)])
    sets = frame(spark, "sets", [dict(concept_set_name="ER", column_name="er", domain="visit_occurrence",
                                      comorbidity=0, er_only_visit=1)])
    for window in (dict(both=False, before=1, after=16), dict(both=True, before=3, after=20)):
        got = {
            r.person_id: (r.macrovisit_id, r[FIRST_STAY_START], r[FIRST_STAY_END], r[FIRST_ER])
            for r in first_index_visits(cohort, visits, members, sets, require_both=window["both"],
                                        before=window["before"], after=window["after"]).collect()
        }
        want = _brute(cohort_rows, visit_rows, **window)
        assert got == want
        assert len(want) > 5
