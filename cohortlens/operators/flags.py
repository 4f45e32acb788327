"""Coded events to 0/1 flags (T4) and flags per person (T5).

The flag columns are fixed up front: the ``column_name`` values of the chosen
sets (a short list, fetched with a bound) or an explicit list.  A flag is a
bit: flag i is bit i % 63 of word i // 63.  A concept carries the bits of all
its flags, so an event row is its key and one word, ``bit_or`` puts the words
of a person and date (or a person) together, and only the last projection
turns bits into columns.  A flag without any event is a column of zeros.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.keys import KEY_BITS, may_hold, summary
from cohortlens.operators.concepts import comorbidity_concepts, comorbidity_sets
from cohortlens.operators.joins import split_hot_keys

MAX_FLAGS = 10_000
#: Flags of one word: the sign bit stays clear.
WORD_FLAGS = 63
#: Names that are searched in a literal list for each concept.
SEARCHED = 256


def flag_names(sets: DataFrame, max_flags: int = MAX_FLAGS) -> list[str]:
    """Sorted distinct non-null flag names of the comorbidity sets.

    These become column names, so they are schema, not data.  ``max_flags``
    (``FactOptions.max_flags``, ``--max-flags``) is how many columns the
    caller allows; more raise an error, none is dropped.
    """
    names = comorbidity_sets(sets).where(F.col("column_name").isNotNull()).select("column_name").distinct()
    rows = names.limit(max_flags + 1).collect()
    if len(rows) > max_flags:
        raise ValueError(f"more than {max_flags} comorbidity flags; raise max_flags")
    return sorted(r[0] for r in rows)


def concept_words(concepts: DataFrame, names: list[str]) -> DataFrame:
    """Rows (concept_id, word, bits): the bit of each of a concept's flags that are among ``names``.

    The list of names is a literal: a few are searched in place, more are
    joined.  (A concept with several flags may have several rows; ``bit_or``
    puts them together with those of its events.)
    """
    listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
    if len(names) <= SEARCHED:
        rows = concepts.select("concept_id", (F.array_position(listed, F.col("column_name")) - 1).alias("number")).where("number >= 0")
    else:
        numbered = concepts.sparkSession.range(1).select(F.posexplode(listed).alias("number", "column_name"))
        rows = concepts.join(numbered, "column_name")
    word = F.floor(F.col("number") / WORD_FLAGS).cast("int")
    return rows.select("concept_id", word.alias("word"), F.expr(f"1L << cast(number % {WORD_FLAGS} AS int)").alias("bits"))


def n_words(names: list[str]) -> int:
    return -(-len(names) // WORD_FLAGS)


def word_columns(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``keys`` and the words ``__w0``, ``__w1``, ... of all rows (keys, word, bits) of a key."""
    if n_words(names) == 1:
        return rows.groupBy(*keys).agg(F.bit_or("bits").alias("__w0"))
    each = rows.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
    return each.groupBy(*keys).agg(*[F.bit_or(F.when(F.col("word") == w, F.col("bits"))).alias(f"__w{w}") for w in range(n_words(names))])


def unpacked(names: list[str]) -> dict[str, Column]:
    """Each flag as a column, 0 or 1, from the words (0 where a word is null)."""
    words = [F.coalesce(F.col(f"__w{w}"), F.lit(0).cast("long")) for w in range(n_words(names))]
    return {n: F.getbit(words[i // WORD_FLAGS], F.lit(i % WORD_FLAGS)).cast("int") for i, n in enumerate(names)}


def packed(names: list[str]) -> list[Column]:
    """The words of flag columns."""
    bits = [F.shiftleft(F.col(f"`{n}`").cast("long"), i % WORD_FLAGS) for i, n in enumerate(names)]
    return [functools.reduce(Column.bitwiseOR, bits[a : a + WORD_FLAGS]).alias(f"__w{a // WORD_FLAGS}") for a in range(0, len(names), WORD_FLAGS)]


def coded_events(
    cohort: DataFrame, conditions: DataFrame, members: DataFrame, sets: DataFrame, names: list[str], *,
    until: str | None = None, concepts: DataFrame | None = None, key_bits: int | None = KEY_BITS, held: Column | None = None,
) -> DataFrame:
    """Rows (person_id, comorbidity_start_date, word, bits): the cohort's dated conditions that have a flag.

    ``concepts``: the resolved list (``comorbidity_concepts``), if it has been
    written as a stage; its bytes then decide whether the planner broadcasts
    it into the scan of conditions, so that only matched rows leave the map
    side.  Rows of persons outside the cohort are dropped in the scan stage by
    a bitmap of its ids (``functions.keys``; None: without; ``held``: a summary
    of the same persons that the plan has already).  The rest is
    joined to the cohort's person ids (an inner join, one shuffle by person).
    (A semi join with the cohort would be moved by the optimizer below the
    concept join, shuffling every condition row; the inner join keeps the
    concept filter first.)  AQE splits a person holding a large share of the
    rows.
    """
    listed = comorbidity_concepts(members, sets) if concepts is None else concepts
    events = conditions.where(F.col("condition_start_date").isNotNull())
    if key_bits:
        held = summary(cohort, bits=key_bits) if held is None else held
        events = events.where(may_hold(held, "person_id", key_bits))
    events = events.select(
        "person_id",
        F.col("condition_start_date").alias("comorbidity_start_date"),
        F.col("condition_concept_id").alias("concept_id"),
    ).join(concept_words(listed, names), "concept_id", "inner")
    events = split_hot_keys(events).drop("concept_id")
    if until is None:
        return events.join(cohort.select("person_id"), "person_id", "inner")
    bound = cohort.select("person_id", F.col(until).alias("__until"))
    return events.join(bound, "person_id", "inner").where(F.col("comorbidity_start_date") <= F.col("__until")).drop("__until")


def event_flags(
    cohort: DataFrame,
    conditions: DataFrame,
    members: DataFrame,
    sets: DataFrame,
    names: list[str] | None = None,
    **options,
) -> DataFrame:
    """One row per cohort person and condition date with at least one matched concept.

    Columns: ``person_id``, ``comorbidity_start_date``, one int flag per name.
    Conditions without a date are dropped; conditions at any time count,
    unless ``until`` names a date column of ``cohort``: then only conditions
    on or before the person's date count (a person without that date gets
    no flags).  A person listed twice in the cohort changes nothing.
    Options: those of ``coded_events``.
    """
    names = flag_names(sets) if names is None else list(names)
    events = coded_events(cohort, conditions, members, sets, names, **options)
    keys = ["person_id", "comorbidity_start_date"]
    if not names:
        return events.select(*keys).distinct()
    return word_columns(events, keys, names).select(*keys, *[c.alias(n) for n, c in unpacked(names).items()])


def person_words(events: DataFrame, names: list[str]) -> DataFrame:
    """The words of each person's flags, from ``coded_events``: no step by date in between."""
    return word_columns(events, ["person_id"], names)


def packed_by_person(flags_by_date: DataFrame, names: list[str]) -> DataFrame:
    """The words of each person's flags, from flag columns by date."""
    words = [F.bit_or(f"__w{w}").alias(f"__w{w}") for w in range(n_words(names))]
    rows = flags_by_date.select("person_id", *packed(names))
    return rows.groupBy("person_id").agg(*words) if words else rows.distinct()


def person_flags(flags_by_date: DataFrame, names: list[str]) -> DataFrame:
    """Max of every flag per person."""
    words = packed_by_person(flags_by_date, names)
    return words.select("person_id", *[c.alias(n) for n, c in unpacked(names).items()])


def with_flags(cohort: DataFrame, words: DataFrame, names: list[str]) -> DataFrame:
    """The cohort with one flag column per name, from the words of its persons; 0 without events."""
    if not names:
        return cohort
    joined = cohort.join(words, "person_id", "left")
    return joined.withColumns(unpacked(names)).drop(*[f"__w{w}" for w in range(n_words(names))])


def with_person_flags(cohort: DataFrame, flags_by_date: DataFrame, names: list[str]) -> DataFrame:
    """The cohort with one flag column per name: the person's max, 0 without events."""
    return with_flags(cohort, packed_by_person(flags_by_date, names), names)
