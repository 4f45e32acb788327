"""The person fact (T6 + T9): every operator composed into one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS
from cohortlens.operators.demographics import clean_demographics
from cohortlens.operators.enrich import INDEX_DATE, enrich, sample_cohort, with_death
from cohortlens.operators.flags import MAX_FLAGS, coded_events, flag_names, person_words, with_flags
from cohortlens.operators.stays import stays_after
from cohortlens.operators.visits import cohort_summary, first_index_visits, index_visits
from cohortlens.sources.tables import Tables


@dataclass(frozen=True)
class FactOptions:
    """Switches of the index-visit match and of the cohort sample."""

    with_er: bool = True
    require_both: bool = False
    days_before: int = 1
    days_after: int = 16
    fraction: float = 1.0
    seed: int = 111
    max_flags: int = MAX_FLAGS  # how many flag columns are allowed
    flags_until: str | None = None  # e.g. the index date: only conditions on or before it count
    # bits of the map of the cohort's ids that events are filtered by before they shuffle; None: the workflow, whose
    # cohort is written, takes as many as its rows need, and a lazy fact goes without (its cohort would run once more); 0: never
    key_bits: int | None = None
    check_keys: bool = True  # the workflow fails if a person id repeats in the cohort or among the persons


def index_cohort(t: Tables, opts: FactOptions = FactOptions()) -> DataFrame:
    """The sampled cohort restricted to persons with an index date (the persons of the fact)."""
    return sample_cohort(t.cohort, opts.fraction, opts.seed).where(F.col(INDEX_DATE).isNotNull())


def clean_cohort(t: Tables, opts: FactOptions = FactOptions()) -> DataFrame:
    """Sampled, enriched and cleaned cohort (T1-T3)."""
    sampled = sample_cohort(t.cohort, opts.fraction, opts.seed)
    return clean_demographics(enrich(sampled, t.persons, t.location, t.manifest))


def cohort_with_flags(
    t: Tables,
    clean: DataFrame,
    names: list[str] | None = None,
    persons: DataFrame | None = None,
    until: str | None = None,
    key_bits: int | None = KEY_BITS,
    held: Column | None = None,
) -> DataFrame:
    """The cleaned cohort with one comorbidity flag per name (T4-T5).

    ``persons`` (default: ``clean``) restricts the events to the cohort; a
    narrow table of the same persons keeps the wide lineage out of that join.
    """
    names = flag_names(t.sets) if names is None else names
    events = coded_events(clean if persons is None else persons, t.conditions, t.members, t.sets, names, until=until, key_bits=key_bits, held=held)
    return with_flags(clean, person_words(events, names), names) if names else clean


def person_fact(t: Tables, opts: FactOptions = FactOptions(), names: list[str] | None = None) -> DataFrame:
    """One row per cohort person with an index date: demographics, flags, first stay and ER visit.

    Flags and visit matching read only the narrow index cohort (person id and
    index dates, unchanged by enrichment); the wide cleaned cohort meets
    them in two left joins on ``person_id``.
    """
    base = index_cohort(t, opts)
    names = flag_names(t.sets, opts.max_flags) if names is None else names
    # all persons of the fact have an index date: flags are filtered by the value that visits are, computed once
    held = cohort_summary(base, key_bits=opts.key_bits) if opts.key_bits else None
    flagged = cohort_with_flags(t, clean_cohort(t, opts), names, persons=base, until=opts.flags_until, key_bits=opts.key_bits or None, held=held)
    return index_visits(
        flagged,
        t.visits,
        t.members,
        t.sets,
        with_er=opts.with_er,
        require_both=opts.require_both,
        before=opts.days_before,
        after=opts.days_after,
        index_cohort=base,
        key_bits=opts.key_bits or None,
    )


def person_death(t: Tables, fact: DataFrame) -> DataFrame:
    return with_death(fact, t.death)


def stay_anchors(t: Tables, opts: FactOptions = FactOptions()) -> DataFrame:
    """Person, index date, start and end of the first index stay: what later stays need of the fact."""
    base = index_cohort(t, opts)
    window = dict(require_both=opts.require_both, before=opts.days_before, after=opts.days_after, key_bits=opts.key_bits or None)
    return base.join(first_index_visits(base, t.visits, t.members, t.sets, with_er=False, **window), "person_id", "left")


def later_stays(t: Tables, fact: DataFrame | None = None, opts: FactOptions = FactOptions()) -> DataFrame:
    """Later stays, from a written fact or from the narrow anchors alone."""
    if fact is None:
        return stays_after(stay_anchors(t, opts), t.visits, persons=index_cohort(t, opts) if opts.key_bits else None)
    return stays_after(fact, t.visits)
