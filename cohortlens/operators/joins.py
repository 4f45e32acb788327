"""Joins whose hot keys are split.

A sort-merge join puts all rows of a key, and all rows without one, into one
task unless something splits them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORCE_SPLIT = "spark.sql.adaptive.forceOptimizeSkewedJoin"
NULL_SALTS = 64


def split_hot_keys(df: DataFrame) -> DataFrame:
    """``df``, after allowing AQE to split its hot join keys in any session.

    By default AQE leaves a skewed join alone when a later aggregation by the
    same key would need one more shuffle.  In these plans that shuffle is
    small (rows are reduced within the join's stage first), so the split is
    allowed unless the session says otherwise.
    """
    conf = df.sparkSession.conf
    if conf.get(FORCE_SPLIT, None) is None:
        conf.set(FORCE_SPLIT, "true")
    return df


def left_lookup(df: DataFrame, dim: DataFrame, key: str, columns: list[str], *, spread_by: str) -> DataFrame:
    """Left join on ``key`` keeping ``df``'s key column in place and appending ``columns``.

    No hint: the dimension is a plain scan, so the planner's own size check
    broadcasts it when it is small and plans a sort-merge join otherwise.  For
    the latter, rows without a key (they match nothing) are spread over
    ``NULL_SALTS`` partitions by ``spread_by``; AQE splits a hot key.
    """
    # always 0, but no literal: a literal would be folded away, and the salt with it
    right = dim.select(F.col(key).alias("__k"), F.pmod(F.hash(key), F.lit(1)).alias("__s"), *columns)
    salt = F.when(F.col(key).isNull(), F.pmod(F.hash(spread_by), F.lit(NULL_SALTS))).otherwise(F.lit(0))
    left = split_hot_keys(df).withColumn("__salt", salt)
    return left.join(right, (F.col(key) == F.col("__k")) & (F.col("__salt") == F.col("__s")), "left").drop("__k", "__s", "__salt")
