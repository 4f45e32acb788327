"""Cohort sample and enrichment (T1, T2) and deaths (T8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.joins import left_lookup

PERSON_COLUMNS = [
    "year_of_birth", "month_of_birth", "day_of_birth",
    "ethnicity_concept_name", "race_concept_name", "gender_concept_name",
    "location_id", "data_partner_id",
]
LOCATION_COLUMNS = ["city", "state", "zip", "county"]
MANIFEST_COLUMNS = ["run_date", "cdm_name", "cdm_version", "shift_date_yn", "max_num_shift_days"]
INDEX_DATE = "first_poslab_or_diagnosis_date"
SUPERSEDED_DATE = "first_antigen_or_poslab_or_diagnosis_date"
#: Equal rows that a sample unfolds in one step.
ROWS_AT_ONCE = 4096


def sample_cohort(cohort: DataFrame, fraction: float = 1.0, seed: int = 111) -> DataFrame:
    """A reproducible sample without replacement (fraction 1.0 keeps every row).

    A person is in the sample if the first 32 bits of the MD5 of
    "seed:person_id" are below that fraction of their range: the rule depends
    on nothing else, so every branch of a plan picks the same persons.
    """
    if fraction >= 1.0:
        return cohort
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("person_id").cast("string")))
    return cohort.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < F.lit(int(fraction * 2**32)))


def sample_rows(df: DataFrame, fraction: float, seed: int = 111) -> DataFrame:
    """A reproducible sample of rows without replacement (fraction 1.0 keeps every row).

    Equal rows are numbered from 1, and a row is in the sample if the first 32
    bits of the MD5 of "seed|column|...|number" are below that fraction of
    their range (null columns as ``\\N``).  So each row has its own chance,
    also of rows that repeat, and the sample is the same on any partitioning.

    Equal rows are counted before they shuffle and unfolded after it, in steps
    of at most ``ROWS_AT_ONCE``, which AQE spreads: a row that makes up a third
    of the table doesn't meet in one task.
    """
    if fraction >= 1.0:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count("*").alias("__n"))
    steps = F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / ROWS_AT_ONCE))
    rows = counted.withColumn("__step", F.explode(steps)).hint("rebalance")
    first = F.col("__step") * ROWS_AT_ONCE + 1
    rows = rows.withColumn("__number", F.explode(F.sequence(first, F.least(F.col("__n"), first + (ROWS_AT_ONCE - 1)))))
    text = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *text, F.col("__number").cast("string")))
    kept = rows.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < F.lit(int(fraction * 2**32)))
    return kept.select(*columns)


def enrich(cohort: DataFrame, persons: DataFrame, location: DataFrame, manifest: DataFrame) -> DataFrame:
    """Persons with an index date, plus person, location and source-manifest columns."""
    with_index = cohort.where(F.col(INDEX_DATE).isNotNull()).drop(SUPERSEDED_DATE)
    person_side = persons.select(F.col("person_id").alias("__k"), *PERSON_COLUMNS)
    with_person = with_index.join(person_side, F.col("person_id") == F.col("__k"), "left").drop("__k")
    with_location = left_lookup(with_person, location, "location_id", LOCATION_COLUMNS, spread_by="person_id")
    return left_lookup(with_location, manifest, "data_partner_id", MANIFEST_COLUMNS, spread_by="person_id")


def with_death(fact: DataFrame, death: DataFrame, *, earliest: bool = False) -> DataFrame:
    """Every death record of each person (several records give several rows).

    With ``earliest``, one record per person: the one with the earliest
    ``death_date`` (nulls last, then the smallest record as a whole), taken
    whole with ``min_by``, aggregated partially before its shuffle.
    """
    records = death.drop("data_partner_id")
    if earliest:
        others = [c for c in records.columns if c != "person_id"]
        row = F.struct(*others)
        order = F.struct(F.col("death_date").isNull(), F.col("death_date"), row)
        records = records.groupBy("person_id").agg(F.min_by(row, order).alias("r")).select("person_id", "r.*")
    return fact.join(records, "person_id", "left")
