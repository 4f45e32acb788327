"""The nine inputs of a cohort fact, passed around as one value."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    """Input DataFrames, one per clinical table.

    cohort      persons with index dates (one row per person expected)
    persons     demographics, one row per person
    location    addresses, one row per location
    manifest    source metadata, one row per data partner
    visits      visit rows, each optionally part of a hospital stay
    members     concept ids per concept set and version
    sets        the chosen concept sets and the flag each one feeds
    conditions  coded conditions per person and date
    death       death records, possibly several per person
    """

    cohort: DataFrame
    persons: DataFrame
    location: DataFrame
    manifest: DataFrame
    visits: DataFrame
    members: DataFrame
    sets: DataFrame
    conditions: DataFrame
    death: DataFrame

    def names(self) -> list[str]:
        return [f.name for f in fields(self)]

    def replace(self, **changes: DataFrame) -> Tables:
        values = {name: getattr(self, name) for name in self.names()}
        values.update(changes)
        return Tables(**values)
