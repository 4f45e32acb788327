"""A person holding a third of all visit rows: AQE splits the person join, results unchanged."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators.stays import stays_after
from cohortlens.operators.visits import first_index_visits
from cohortlens.sources import schemas
from tests.util import as_set, frame

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _visits(spark, n_people=200, per_person=6, hot_rows=600):
    """Visit rows as a Spark job (no driver-side list): person 0 gets as many stays as everyone else."""
    base = F.lit(dt.date(2020, 6, 1))
    ids = spark.range(n_people * per_person + hot_rows)
    person = F.when(F.col("id") < hot_rows, F.lit(0)).otherwise(F.col("id") % n_people + 1)
    day = F.date_add(base, (F.col("id") % 23 - 3).cast("int"))
    cols = {
        "person_id": person.cast("long"),
        "visit_occurrence_id": F.col("id"),
        "visit_concept_id": F.when(F.col("id") % 4 == 0, 9203).otherwise(9201).cast("int"),
        "visit_concept_name": F.lit(None).cast("string"),
        "visit_start_date": day,
        "visit_end_date": day,
        "macrovisit_id": F.when(F.col("id") % 4 != 0, F.col("id").cast("string")),
        "macrovisit_start_date": F.when(F.col("id") % 4 != 0, day),
        "macrovisit_end_date": F.when(F.col("id") % 4 != 0, F.date_add(day, 2)),
    }
    return ids.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in schemas.VISITS.fields])


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_person_is_split_and_results_hold(spark):
    visits = _visits(spark)
    assert visits.where("person_id = 0").count() * 3 >= visits.count()
    cohort = spark.range(0, 201).select(
        F.col("id").alias("person_id"),
        F.lit(dt.date(2020, 6, 5)).alias("first_pos_pcr_antigen_date"),
        F.lit(None).cast("date").alias("first_pos_diagnosis_date"),
        F.lit(dt.date(2020, 6, 5)).alias("first_poslab_or_diagnosis_date"),
    )
    members = frame(spark, "members", [dict(concept_id=9203, concept_set_name="ER", is_most_recent_version=True)])
    sets = frame(spark, "sets", [dict(concept_set_name="ER", column_name="er", domain="visit_occurrence",
                                      comorbidity=0, er_only_visit=1)])

    def run():
        firsts = first_index_visits(cohort, visits, members, sets)
        later = stays_after(cohort.join(firsts, "person_id", "left"), visits)
        rows = as_set(firsts), as_set(later)  # actions on these DataFrames finalise their adaptive plans
        plans = firsts._jdf.queryExecution().executedPlan().toString() + later._jdf.queryExecution().executedPlan().toString()
        return rows[0], rows[1], plans

    got_firsts, got_later, plans = _with_conf(spark, SKEW_CONF, run)
    assert "skew=true" in plans
    ref_firsts, ref_later, _ = _with_conf(spark, {**SKEW_CONF, "spark.sql.adaptive.enabled": "false"}, run)
    assert got_firsts == ref_firsts and got_later == ref_later
    assert len(got_later) > 0 and any(r[0] == 0 for r in got_firsts)


def test_hot_person_in_conditions_is_split(spark):
    from cohortlens.operators.flags import event_flags

    n = 1800
    ids = spark.range(n)
    conditions = ids.select(
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 200 + 1).cast("long").alias("person_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 97).cast("int")).alias("condition_start_date"),
        (F.col("id") % 6).cast("long").alias("condition_concept_id"),
    )
    cohort = spark.range(0, 201).select(F.col("id").alias("person_id"))
    members = frame(spark, "members", [dict(concept_id=c, concept_set_name="S" if c < 3 else "T",
                                            is_most_recent_version=True) for c in range(6)])
    sets = frame(spark, "sets", [
        dict(concept_set_name="S", column_name="fs", domain="condition_occurrence", comorbidity=1, er_only_visit=0),
        dict(concept_set_name="T", column_name="ft", domain="condition_occurrence", comorbidity=1, er_only_visit=0),
    ])

    def run():
        flags = event_flags(cohort, conditions, members, sets)
        rows = as_set(flags)
        return rows, flags._jdf.queryExecution().executedPlan().toString()

    got, plan = _with_conf(spark, SKEW_CONF, run)
    assert "skew=true" in plan
    ref, _ = _with_conf(spark, {**SKEW_CONF, "spark.sql.adaptive.enabled": "false"}, run)
    assert got == ref and any(r[0] == 0 for r in got)


def test_hot_person_is_split_in_a_plain_session(spark):
    """The operators themselves allow the split; the session need not."""
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    old = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        test_hot_person_is_split_and_results_hold(spark)
        assert spark.conf.get(key) == "true"
        spark.conf.unset(key)
        test_hot_person_in_conditions_is_split(spark)
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


def test_rows_without_a_location_are_spread(spark):
    """A third of the persons have no location id: no task of the sort-merge join gets them all."""
    from cohortlens.operators.joins import left_lookup

    n = 3000
    persons = spark.range(n).select(
        F.col("id").alias("person_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 900).alias("location_id")
    )
    location = spark.range(900).select(F.col("id").alias("location_id"), F.col("id").cast("string").alias("city"))

    def run():
        out = left_lookup(persons, location, "location_id", ["city"], spread_by="person_id")
        sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        return as_set(out), [r["count"] for r in sizes], out.columns

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    rows, sizes, columns = _with_conf(spark, conf, run)
    assert columns == ["person_id", "location_id", "city"]
    assert rows == {(i, i % 900 if i % 3 else None, str(i % 900) if i % 3 else None) for i in range(n)}
    assert max(sizes) < n // 6
