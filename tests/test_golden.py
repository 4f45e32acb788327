"""Row counts at sf0.01 that SURVEY's SQL probes found before any DataFrame code
existed (bindings in FIXTURES.md), plus this build's own counts where its
bindings differ (conditions use every line item; deaths are a category)."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.01"

GOLDEN = {
    # from the survey's probes
    "enrich_locations": 1472,
    "birth_date": 1500,
    "race_ethnicity": 1500,
    "zip5": 25,
    "hosp_either": 1027,
    "hosp_both": 16,
    "first_hosp": 973,
    "person_fact": 1472,
    "stays_after_index": 7447,
    "inpatient_codes_per_stay": 6808,
    "distinct_dates_per_stay": 9859,
    "visits_of_stay": 13,
    "stay_timeline": 83,
    # this build's bindings (ER concepts come from part: counts of the DuckDB oracle)
    "er_concepts": 5,
    "er_visits_either": 60,
    "first_er": 57,
    "first_visits": 1001,
    "comorbidity_by_visit": 12542,
    "person_death": 1727,
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden_count(spark, name):
    assert entry_mod.queries()[name](spark, SF).count() == GOLDEN[name]
