"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry_mod
from cohortlens.plans.queries import QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    res = compare(df, con, entry_mod.oracle_sql()[name])
    assert res["ok"], res
    assert res["rows_spark"] > 0


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "person_id" in df.columns and "first_COVID_hospitalization_start_date" in df.columns


@pytest.mark.parametrize("name", ["clean_demographics", "age_at_index", "birth_date", "person_fact"])
def test_query_matches_oracle_with_ansi_off(spark, con, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = entry_mod.queries()[name](spark, SF)
        res = compare(df, con, entry_mod.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert res["ok"], res
