"""Publish every output of the cohort fact, stage by stage.

Each stage is written to the output folder (a shared path) and the next
stage reads the written table back, the dataset boundaries of the reference:
sample -> locations -> clean -> comorbidities -> covid visits (the person
fact) -> later stays and deaths; flags per visit and the visit checks on
the side.  A written table is the lineage cut: after an executor loss a stage
re-reads Parquet instead of re-running every join upstream, and a failed run
can resume from the last written stage.

Row counts of every output are gathered with ``observe`` during the write
(no extra job), including the two branch counts of the later stays that the
reference prints.
"""

from __future__ import annotations

import dataclasses
import functools
import json

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS, key_bits as bits_for
from cohortlens.operators.checks import unique
from cohortlens.operators.concepts import comorbidity_concepts, er_concepts
from cohortlens.operators.demographics import clean_demographics
from cohortlens.operators.enrich import INDEX_DATE, enrich, sample_cohort, with_death
from cohortlens.operators.flags import event_flags, flag_names, with_person_flags
from cohortlens.operators.stays import stays_after
from cohortlens.operators.visits import (
    FIRST_STAY_START,
    first_index_visits,
    stay_date_variants,
    stay_timeline,
    visit_code_counts,
    visits_of_stay,
)
from cohortlens.plans.fact import FactOptions
from cohortlens.sources.tables import Tables
from cohortlens.sources.versions import Version, current, fingerprint, in_buckets, n_buckets, publish, read_version

FACT = "person_fact"


def with_row_counts(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """``df`` observed: its row count (``rows``) and one count per condition, gathered
    while the write runs, with no extra job."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.observe(obs, *metrics), obs


def fitting_bits(persons: DataFrame, asked: int | None) -> int | None:
    """Bits for the map of a written cohort's ids: as asked (0: no map), or as many as its rows need."""
    return bits_for(persons.count()) if asked is None else asked or None


def later_stays_observed(fact: DataFrame, visits: DataFrame, key_bits: int | None = KEY_BITS) -> tuple[DataFrame, Observation]:
    """Later stays with the counts the reference prints: all rows, rows of persons with a
    first index stay, rows of persons without one.  ``fact`` is the written table, so
    the earliest-anchor prefilter is one cheap aggregate over it."""
    has_first = F.col(FIRST_STAY_START).isNotNull()
    later = stays_after(fact, visits, prefilter=True, key_bits=key_bits or KEY_BITS)
    return with_row_counts(later, "stays_after_index", with_first_stay=has_first, without_first_stay=~has_first)


def build_outputs(
    t: Tables,
    out_dir: str,
    opts: FactOptions = FactOptions(),
    metrics: dict | None = None,
    *,
    stay_id: str | None = None,
    person_id: int | None = None,
    resume: bool = False,
    buckets: int | None = None,
    plans: dict | None = None,
) -> dict[str, str]:
    """Write every output under ``out_dir`` (a shared folder); return name -> folder of the version written.

    ``metrics``, when given, receives the observed row counts of each output
    written in this run, and ``plans`` the physical plan of each.  ``stay_id``
    and ``person_id`` add the two look-ups (visits of one stay, stays of one
    person).

    Each output is a table in versions (``sources.versions``); readers of the
    last good one are never disturbed.  Tables by person are bucketed by
    person, so the joins between stages need no exchange.  (Where raw visits
    and conditions meet the cohort, its few columns are shuffled with them:
    only then can AQE split a person that holds a large share of the rows.)

    With ``resume``, a stage is read back instead of recomputed if its last
    version was made by the same recipe: the options, the files (names, sizes,
    times) and columns of the inputs that it reads itself, and the versions of
    the stages that it reads.  A changed input file makes anew the stages that
    read it, and those that read these.
    """
    spark = t.cohort.sparkSession
    out = out_dir.rstrip("/")
    versions: dict[str, Version] = {}
    observed: dict[str, Observation] = {}
    options = dataclasses.asdict(opts)

    @functools.cache
    def state_of(table: str) -> dict:
        df = getattr(t, table)
        return {"files": fingerprint(df), "columns": df.dtypes}

    def stage(name: str, df: DataFrame, inputs: str = "", stages: str = "", *, obs: Observation | None = None, by_person: bool = False, aligned: bool = False, **more) -> DataFrame:
        read = {"inputs": {x: state_of(x) for x in inputs.split()}, "stages": {x: versions[x].folder for x in stages.split()}}
        recipe = json.dumps({"stage": name, "options": options, **read, **more}, sort_keys=True)
        last = current(spark, f"{out}/{name}") if resume else None
        if last is None or last.recipe != recipe:
            if obs is None:
                df, obs = with_row_counts(df, name)
            observed[name] = obs
            if plans is not None:
                written = in_buckets(df, "person_id", n_buckets(spark, buckets), aligned) if by_person else df
                plans[name] = written._jdf.queryExecution().executedPlan().toString()
            key = "person_id" if by_person else None
            last = publish(df, f"{out}/{name}", bucket_by=key, buckets=buckets, aligned=aligned, recipe=recipe)
        versions[name] = last
        return read_version(spark, last)

    names = flag_names(t.sets, opts.max_flags)
    # written, so that their bytes decide whether the planner broadcasts them
    flag_concepts = stage("comorbidity_concepts", comorbidity_concepts(t.members, t.sets).distinct(), "members sets")
    er_ids = stage("er_concepts", er_concepts(t.members, t.sets), "members sets") if opts.with_er else None
    cohort, people = (unique(x, "person_id", n) if opts.check_keys else x for x, n in ((t.cohort, "cohort"), (t.persons, "persons")))
    sampled = stage("sample_cohort", sample_cohort(cohort, opts.fraction, opts.seed), "cohort", by_person=True)
    located = stage("enrich_locations", enrich(sampled, people, t.location, t.manifest), "persons location manifest", "sample_cohort", by_person=True)
    clean = stage("clean_demographics", clean_demographics(located), "", "enrich_locations", by_person=True, aligned=True)
    # the same rows, read without their buckets
    persons = spark.read.parquet(versions["sample_cohort"].folder).where(F.col(INDEX_DATE).isNotNull())
    key_bits = fitting_bits(persons, opts.key_bits)
    by_date = stage(
        "comorbidity_by_visit",
        event_flags(persons, t.conditions, t.members, t.sets, names, until=opts.flags_until, concepts=flag_concepts, key_bits=key_bits),
        "conditions",
        "sample_cohort comorbidity_concepts",
        by_person=True,
        names=names,
    )
    flagged = stage("person_with_comorbidities", with_person_flags(clean, by_date, names), "", "clean_demographics comorbidity_by_visit", by_person=True)
    firsts = first_index_visits(
        persons,
        t.visits,
        t.members,
        t.sets,
        with_er=opts.with_er,
        require_both=opts.require_both,
        before=opts.days_before,
        after=opts.days_after,
        er_ids=er_ids,
        key_bits=key_bits,
    )
    er_stage = " er_concepts" if opts.with_er else ""
    fact = stage(FACT, flagged.join(firsts, "person_id", "left"), "visits", "sample_cohort person_with_comorbidities" + er_stage, by_person=True)
    anchors = spark.read.parquet(versions[FACT].folder)
    later, counts = later_stays_observed(anchors, t.visits, key_bits)
    stage("stays_after_index", later, "visits", FACT, obs=counts)
    stage("person_death", with_death(fact, t.death), "death", FACT)
    stage("inpatient_codes_per_stay", visit_code_counts(t.visits), "visits")
    stage("distinct_dates_per_stay", stay_date_variants(t.visits), "visits")
    if stay_id is not None:
        stage("visits_of_stay", visits_of_stay(t.visits, stay_id), "visits", id=stay_id)
    if person_id is not None:
        stage("stay_timeline", stay_timeline(t.visits, person_id), "visits", id=person_id)
    if metrics is not None:
        metrics.update({name: obs.get for name, obs in observed.items()})
    return {name: version.folder for name, version in versions.items()}
