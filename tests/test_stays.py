"""T7 later stays, single pass against a brute force."""

import datetime as dt
import random

from cohortlens.operators.stays import stays_after
from cohortlens.operators.visits import FIRST_STAY_END, FIRST_STAY_START, INDEX
from tests.util import as_set, d, frame


def _fact(spark, rows):
    return spark.createDataFrame(
        rows,
        f"person_id long, {INDEX} date, {FIRST_STAY_START} date, {FIRST_STAY_END} date, macrovisit_id string",
    )


def _stay(pid, sid, start, end=None):
    return dict(person_id=pid, macrovisit_id=sid, macrovisit_start_date=d(start), macrovisit_end_date=d(end))


def test_edges(spark):
    fact = _fact(spark, [
        (1, d("2020-06-01"), d("2020-06-05"), d("2020-06-07"), "s1"),
        (2, d("2020-06-01"), None, None, None),
    ])
    visits = frame(spark, "visits", [
        _stay(1, "s1", "2020-06-05", "2020-06-07"),  # the first stay itself: same day, out
        _stay(1, "s0", "2020-05-01"),  # before the anchor
        _stay(1, "s2", "2020-07-01", "2020-07-03"),
        _stay(1, "s2", "2020-07-01", "2020-07-03"),  # many visit rows of one stay
        _stay(1, "s3", "2020-06-06"),  # after the first stay start, null end
        _stay(2, "t1", "2020-06-01"),  # same day as the index date: out
        _stay(2, "t2", "2020-06-02", "2020-06-04"),
        _stay(2, None, "2020-08-01"),  # null stay id: not a stay
    ])
    got = as_set(stays_after(fact, visits), "person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date")
    assert got == {
        (1, "s2", d("2020-07-01"), d("2020-07-03")),
        (1, "s3", d("2020-06-06"), None),
        (2, "t2", d("2020-06-02"), d("2020-06-04")),
    }


def test_inconsistent_stay_keeps_earliest_start_after_anchor(spark):
    fact = _fact(spark, [(1, d("2020-06-01"), None, None, None)])
    visits = frame(spark, "visits", [
        _stay(1, "s", "2020-05-01", "2020-05-02"),  # before the anchor: filtered first
        _stay(1, "s", "2020-06-10", "2020-06-20"),
        _stay(1, "s", "2020-06-10", "2020-06-12"),
        _stay(1, "s", "2020-06-15", "2020-06-16"),
    ])
    got = as_set(stays_after(fact, visits), "macrovisit_start_date", "macrovisit_end_date")
    assert got == {(d("2020-06-10"), d("2020-06-12"))}


def test_single_pass_equals_brute_force(spark):
    rng = random.Random(7)
    base = dt.date(2020, 1, 1)
    fact_rows, stays = [], []
    for p in range(60):
        idx = base + dt.timedelta(rng.randint(0, 200))
        first = idx + dt.timedelta(rng.randint(0, 10)) if rng.random() < 0.5 else None
        fact_rows.append((p, idx, first, first and first + dt.timedelta(3), None))
        for s in range(rng.randint(0, 6)):
            start = base + dt.timedelta(rng.randint(0, 300))
            end = start + dt.timedelta(rng.randint(0, 9)) if rng.random() < 0.8 else None
            for _ in range(rng.randint(1, 3)):
                stays.append(_stay(p, f"{p}-{s}", str(start), end and str(end)))
    fact = _fact(spark, fact_rows)
    visits = frame(spark, "visits", stays)
    wanted = {}
    for p, idx, first, _, _ in fact_rows:
        for v in stays:
            if v["person_id"] == p and v["macrovisit_start_date"] > (first or idx):
                end = v["macrovisit_end_date"]
                row = (v["macrovisit_start_date"], end is not None, end or dt.date.min)
                key = (p, v["macrovisit_id"])
                wanted[key] = min(wanted.get(key, row), row)
    got = as_set(stays_after(fact, visits), "person_id", "macrovisit_id", "macrovisit_start_date", "macrovisit_end_date")
    assert got == {(p, s, start, end if known else None) for (p, s), (start, known, end) in wanted.items()}
    assert got


def test_prefilter_changes_nothing(spark):
    fact = _fact(spark, [
        (1, d("2020-06-01"), d("2020-06-05"), d("2020-06-07"), "s1"),
        (2, d("2020-03-01"), None, None, None),
    ])
    visits = frame(spark, "visits", [
        _stay(1, "a", "2019-01-01"), _stay(1, "b", "2020-06-06"), _stay(2, "c", "2020-03-01"),
        _stay(2, "d", "2020-03-02", "2020-03-05"), _stay(2, "e", "2018-01-01"),
    ])
    assert as_set(stays_after(fact, visits, prefilter=True)) == as_set(stays_after(fact, visits))
    assert as_set(stays_after(fact, visits), "macrovisit_id") == {("b",), ("d",)}
