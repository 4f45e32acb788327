"""Concept sets: choose sets, resolve their current concept ids (T6a)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_current(members: DataFrame) -> Column:
    """``is_most_recent_version`` as a predicate, stored as boolean or as text 'true'."""
    col = F.col("is_most_recent_version")
    if isinstance(members.schema["is_most_recent_version"].dataType, T.BooleanType):
        return col
    return col == "true"


def comorbidity_sets(sets: DataFrame) -> DataFrame:
    """Sets that feed a comorbidity flag: condition domain, comorbidity = 1."""
    return sets.where(F.col("domain").contains("condition_occurrence") & (F.col("comorbidity") == 1)).select(
        "concept_set_name", "column_name"
    )


def er_sets(sets: DataFrame) -> DataFrame:
    """Sets of emergency-room-only visit concepts."""
    return sets.where(F.col("er_only_visit") == 1).select("concept_set_name")


def current_members(members: DataFrame, chosen: DataFrame) -> DataFrame:
    """Current (concept_id, concept_set_name) of the chosen sets.

    A semi join: the result is at most as large as ``members``, and the
    planner knows it, so its byte-based check decides whether a join with a
    large table broadcasts the list.
    """
    current = members.where(is_current(members)).select("concept_id", "concept_set_name")
    return current.join(chosen.select("concept_set_name"), "concept_set_name", "left_semi")


def comorbidity_concepts(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(concept_id, column_name) of the comorbidity flags (repeats do no harm to a flag)."""
    chosen = comorbidity_sets(sets)
    return current_members(members, chosen).join(chosen, "concept_set_name").select("concept_id", "column_name")


def er_members(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Current concept ids of the ER-only sets, one row per membership (duplicates kept)."""
    return current_members(members, er_sets(sets)).select("concept_id")


def er_concepts(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct current concept ids of the ER-only sets (one column, ``concept_id``)."""
    return er_members(members, sets).distinct()
