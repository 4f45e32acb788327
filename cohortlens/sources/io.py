"""Readers.

Inputs are Parquet directories; their declared columns are checked and cast
(timestamp columns that hold dates become dates).  Outputs are written by
``sources.versions``: a written table is also the way to cut a long lineage,
since a lost executor then re-reads the table instead of re-running the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources import schemas
from cohortlens.sources.tables import Tables


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` as input ``name``: its declared columns, cast; for ``schemas.OPEN`` inputs also all others.

    Raises if declared columns are missing, naming all of them.  A person id
    that is stored as text stays text.
    """
    schema = schemas.BY_NAME[name]
    stored = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in stored]
    if missing:
        raise ValueError(f"input {name} lacks column(s): {', '.join(missing)}")

    def declared(f: T.StructField):
        kind = T.StringType() if f.name == "person_id" and isinstance(stored[f.name], T.StringType) else f.dataType
        return F.col(f.name).cast(kind).alias(f.name)

    others = [F.col(f"`{c}`") for c in df.columns if c not in schema.names] if name in schemas.OPEN else []
    optional = [declared(f) for f in schemas.OPTIONAL.get(name, []) if f.name in stored]
    return df.select(*[declared(f) for f in schema.fields], *optional, *others)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read input ``name`` from Parquet (see ``conform``)."""
    return conform(spark.read.parquet(path), name)


def read_tables(spark: SparkSession, paths: dict[str, str]) -> Tables:
    """Read the nine inputs from Parquet paths keyed like ``Tables``' fields."""
    missing = [name for name in schemas.BY_NAME if name not in paths]
    if missing:
        raise ValueError(f"no path given for input(s): {', '.join(missing)}")
    return Tables(**{name: read_table(spark, paths[name], name) for name in schemas.BY_NAME})
