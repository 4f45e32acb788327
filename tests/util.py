"""Small builders for hand-made rows."""

from __future__ import annotations

import datetime as dt

from cohortlens.sources import schemas


def d(s: str | None):
    return None if s is None else dt.date.fromisoformat(s)


def frame(spark, name: str, rows: list[dict]):
    """A DataFrame with the declared schema of input ``name``; missing keys are null."""
    schema = schemas.BY_NAME[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def as_set(df, *cols):
    cols = cols or tuple(df.columns)
    return {tuple(r[c] for c in cols) for r in df.collect()}
