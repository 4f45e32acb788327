"""Generic event operators: window join on any key, first event per key."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators.events import events_in_window, first_event
from tests.util import as_set


def _d(s):
    return dt.date.fromisoformat(s) if s else None


def test_events_in_window_any_key(spark):
    index = spark.createDataFrame([(1, _d("2021-03-10"), 5), (2, None, 0), (3, _d("2021-03-01"), 0)],
                                  "acct long, opened date, tier int")
    events = spark.createDataFrame(
        [(1, _d(x), i) for i, x in enumerate(["2021-03-07", "2021-03-08", "2021-03-10", "2021-03-13", "2021-03-14"])]
        + [(2, _d("2021-03-10"), 9), (3, _d("2021-02-27"), 10), (3, None, 11)],
        "acct long, at date, n int",
    )
    args = dict(index_date="opened", event_date="at", before=2, after=3, key="acct")
    got = events_in_window(index, events, **args)
    assert as_set(got, "acct", "n") == {(1, 1), (1, 2), (1, 3), (3, 10)}
    assert as_set(events_in_window(index, events, prefilter=False, **args), "acct", "n") == as_set(got, "acct", "n")
    also = events_in_window(index, events, also=F.col("tier") > 1, **args)
    assert as_set(also, "acct", "n") == {(1, 1), (1, 2), (1, 3)}
    assert set(got.columns) == {"acct", "at", "n", "opened", "tier"}


def test_first_event_whole_row_and_ties(spark):
    df = spark.createDataFrame(
        [("a", _d("2021-01-02"), 5, "x"), ("a", _d("2021-01-02"), 3, "y"), ("a", _d("2021-01-01"), None, "z"),
         ("b", None, 1, "n"), ("b", _d("2020-01-01"), 1, "m")],
        "k string, day date, rank int, tag string",
    )
    got = first_event(df, "k", order=["day", "rank", "tag"], payload=["tag", "rank"])
    assert got.columns == ["k", "tag", "rank"]
    assert as_set(got) == {("a", "z", None), ("b", "n", 1)}  # nulls first in the order
    two = first_event(df.where("day is not null"), ["k"], order=["day", "rank"], payload=["tag"])
    assert as_set(two) == {("a", "z"), ("b", "m")}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_days = st.one_of(st.none(), st.integers(min_value=0, max_value=60))


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 6), _days), min_size=1, max_size=8, unique_by=lambda r: r[0]),
    st.lists(st.tuples(st.integers(0, 8), _days), min_size=1, max_size=60),
    st.integers(0, 5),
    st.integers(0, 10),
    st.booleans(),
)
def test_events_in_window_against_brute_force(spark, index_rows, event_rows, before, after, prefilter):
    base = dt.date(2021, 1, 1)
    day = lambda n: None if n is None else base + dt.timedelta(n)
    index = spark.createDataFrame([(k, day(n)) for k, n in index_rows], "k long, at date")
    events = spark.createDataFrame([(k, day(n), i) for i, (k, n) in enumerate(event_rows)], "k long, on date, i int")
    got = events_in_window(index, events, index_date="at", event_date="on", before=before, after=after,
                           key="k", prefilter=prefilter)
    at = {k: n for k, n in index_rows}
    want = {
        i for i, (k, n) in enumerate(event_rows)
        if k in at and at[k] is not None and n is not None and -after <= at[k] - n <= before
    }
    assert {r.i for r in got.collect()} == want


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), _days, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 999)),
                min_size=1, max_size=60, unique_by=lambda r: r[3]))
def test_first_event_against_brute_force(spark, rows):
    base = dt.date(2021, 1, 1)
    day = lambda n: None if n is None else base + dt.timedelta(n)
    df = spark.createDataFrame([(k, day(d), r, i) for k, d, r, i in rows], "k long, day date, rank int, id int")
    got = {r.k: r.id for r in first_event(df, "k", order=["day", "rank", "id"], payload=["id"]).collect()}
    nulls_first = lambda v: (v is not None, v if v is not None else 0)
    want = {}
    for k, d, r, i in rows:
        key = (nulls_first(d), nulls_first(r), i)
        if k not in want or key < want[k][0]:
            want[k] = (key, i)
    assert got == {k: v[1] for k, v in want.items()}
