"""Published tables in versions: a write never touches what readers have.

A table is a folder.  A write puts its rows into a version folder of its own
and then appends one line to the table's log: number, folder, recipe, layout.
Readers take the last line.  A write that fails, or a driver that is lost
before the line is there, leaves a folder that no line names; the last good
version stays what it was, also for readers that have it open.  ``expire``
removes what is no longer wanted.

A version may be bucketed by a key: one file a bucket, sorted by the key.
Joins of two such tables by that key, and aggregates over it, need no
exchange.  The layout is in the log, so another session can read it so, too.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "commits"


@dataclass(frozen=True)
class Version:
    """One line of a table's log."""

    number: int
    folder: str
    recipe: str = ""
    bucket_by: str = ""
    buckets: int = 0

    @property
    def name(self) -> str:
        """The version as a table of the session's catalog, if it is bucketed."""
        return "version_" + self.folder.rsplit("-", 1)[1]


def _file(spark: SparkSession, path: str):
    """A path and the file system that has it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def log(spark: SparkSession, path: str) -> list[Version]:
    """All versions of a table, oldest first (one row a write)."""
    lines = f"{path.rstrip('/')}/{LOG}"
    file, system = _file(spark, lines)
    if not system.exists(file):
        return []
    rows = spark.read.text(lines).collect()
    return sorted((Version(**json.loads(r.value)) for r in rows if r.value), key=lambda v: (v.number, v.folder))


def current(spark: SparkSession, path: str) -> Version | None:
    """The last version that was written whole; None: there is none."""
    versions = log(spark, path)
    return versions[-1] if versions else None


def n_buckets(spark: SparkSession, buckets: int | None = None) -> int:
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_buckets(df: DataFrame, key: str, buckets: int, aligned: bool = False) -> DataFrame:
    """The rows as they are written into buckets: those of a bucket in one task.

    Joins and aggregates over buckets of the same number have the rows so
    already, and the planner leaves out this exchange.  ``aligned``: the plan
    is a projection of such a table; it goes without, too.
    """
    return df if aligned else df.repartition(buckets, F.col(f"`{key}`"))


def publish(
    df: DataFrame, path: str, *, partition_by: list[str] | None = None, bucket_by: str | None = None, buckets: int | None = None,
    aligned: bool = False, recipe: str = "",
) -> Version:
    """Write a new version of the table at ``path``; it is the current one once all of it is there.

    ``bucket_by``: a key column, into ``buckets`` (default: the session's number
    of shuffle partitions) files (see ``in_buckets``).
    """
    spark, path = df.sparkSession, path.rstrip("/")
    last = current(spark, path)
    number = last.number + 1 if last else 1
    version = Version(number, f"{path}/v{number:06d}-{uuid.uuid4().hex}", recipe)
    if bucket_by:
        if partition_by:
            raise ValueError("a table is either partitioned or bucketed")
        n = n_buckets(spark, buckets)
        version = Version(number, version.folder, recipe, bucket_by, n)
        in_buckets(df, bucket_by, n, aligned).write.format("parquet").bucketBy(n, bucket_by).sortBy(bucket_by).option("path", version.folder).saveAsTable(version.name)
    else:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(version.folder)
    line = spark.range(1).coalesce(1).select(F.lit(json.dumps(asdict(version))).alias("value"))
    line.write.mode("append").text(f"{path}/{LOG}")
    return version


def read_version(spark: SparkSession, version: Version) -> DataFrame:
    """The rows of a version; if it is bucketed, in its buckets."""
    if not version.bucket_by:
        return spark.read.parquet(version.folder)
    if not spark.catalog.tableExists(version.name):  # written by another session
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(version.folder).schema)
        layout = f"CLUSTERED BY (`{version.bucket_by}`) SORTED BY (`{version.bucket_by}`) INTO {version.buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {version.name} ({columns}) USING parquet {layout} LOCATION '{version.folder}'")
    return spark.table(version.name)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``."""
    version = current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version was published at {path}")
    return read_version(spark, version)


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the folders of all but the last ``keep`` versions (their lines stay); returns those removed."""
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    removed = []
    for version in log(spark, path)[:-keep]:
        if version.bucket_by:
            spark.sql(f"DROP TABLE IF EXISTS {version.name}")
        folder, system = _file(spark, version.folder)
        if system.delete(folder, True):
            removed.append(version.folder)
    return removed


def fingerprint(df: DataFrame) -> str:
    """What a table read from files holds, as far as its files tell: names, sizes and times of change.

    One aggregate over the listing of the files, none of which is opened.  A
    table that is not read from files counts as changed in every session.
    """
    files = df.inputFiles()
    if not files:
        return f"plan {df.semanticHash()}"
    from urllib.parse import unquote

    listed = df.sparkSession.read.format("binaryFile").load([unquote(f) for f in files]).select("path", "length", "modificationTime")
    line = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
    found = listed.agg(F.count("*").alias("n"), F.sum(line.cast("decimal(38,0)")).alias("all"), F.sum("length").alias("bytes")).first()
    return f"{found.n} files, {found.bytes} bytes, {found['all']}"
