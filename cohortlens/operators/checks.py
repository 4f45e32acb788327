"""Assertions that travel in the plan: rows pass only if the whole table keeps a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, key: str, table: str) -> DataFrame:
    """``df``; whatever reads it fails if a value of ``key`` (not null) is in several rows.

    The error names the table, the key, how many values repeat, and the least
    and greatest of them.  Keys are counted once, in a scalar subquery before
    the scan (partial counts, one shuffle of keys); nothing but its message
    reaches the driver.
    """
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    message = F.concat(
        F.lit(f"REPEATED_KEY: {table}.{key} repeats for "), F.count("*").cast("string"), F.lit(" value(s), from "), text(F.min(key)), F.lit(" to "), text(F.max(key))
    )
    found = repeated.agg(F.when(F.count("*") > 0, message).alias("message")).scalar()
    return df.where(F.when(found.isNull(), F.lit(True)).otherwise(F.raise_error(found).cast("boolean")))
