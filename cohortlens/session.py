"""A SparkSession with the settings the operators are designed for.

AQE re-plans at run time: small join sides become broadcasts when their
measured size is under the threshold, partitions are coalesced, and a skewed
key (one person or partner holding a large share of rows) is split across
tasks.  ``forceOptimizeSkewedJoin`` lets AQE split a skewed join even when the
split needs one more shuffle after it; in these plans the rows after a skewed
join are already filtered down, so that shuffle is small.

On a cluster, keep the cluster's own ``spark.checkpoint.dir``; tests name a
scratch folder only because none is set there.
"""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # scan splits and shuffle partitions of about 128 MB: set the shuffle
    # partition count high for the largest stage (about input bytes / 128 MB)
    # and let AQE coalesce the smaller ones.
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    master: str | None = "local[*]",
    *,
    app: str = "cohortlens",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with ``SETTINGS`` where neither the cluster nor the caller has set them.

    What ``spark-submit --conf``, ``spark-defaults.conf`` or an active session
    say stays.  ``shuffle_partitions`` and ``extra`` are the caller's own and
    override; without the former, the cluster's count holds.
    """
    asked = dict(extra or {})
    if shuffle_partitions is not None:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = SparkSession.getActiveSession()
    if spark is None:
        given = SparkConf()  # system properties, and so spark-submit's
        builder = SparkSession.builder.appName(app)
        if master and not given.contains("spark.master"):
            builder = builder.master(master)
        for key, value in ({k: v for k, v in SETTINGS.items() if not given.contains(k)} | asked).items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        for key, value in SETTINGS.items():
            if spark.conf.get(key, None) is None and spark.conf.isModifiable(key):
                spark.conf.set(key, value)
        for key, value in asked.items():
            spark.conf.set(key, value)
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", checkpoint_dir)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
