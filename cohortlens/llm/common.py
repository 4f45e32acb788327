"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The white space of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: Text handled in one numpy pass; a single longer text goes through in tiles of this size.
CHUNK_BYTES = 1 << 19
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_path(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only on a local master that names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    return _local_folder()


def ship(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import this package, once per session (as ``--py-files`` would).

    Batches of texts for them are kept to ``BATCH_BYTES`` unless the session
    says otherwise: a worker holds several forms of a batch at a time.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    if not getattr(sc, "_cohortlens_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="run-")) / "cohortlens.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._cohortlens_shipped = True
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage and fixes the rows."""
    path = f"{shared_path(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name}`")


def free_name(name: str, df: DataFrame) -> str:
    """The name, with more underscores if a column has it."""
    while name in df.columns:
        name += "_"
    return name


def id_text(name: str) -> Column:
    """An id as text; null counts as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def remainder(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the folds of the contracts."""
    return F.crc32(id_text(name)) % n


def spread(n: int, *names: str) -> Column:
    """A salt in [0, n) from the values of columns: equal on every run."""
    return F.pmod(F.xxhash64(*[col(x) for x in names]), F.lit(n)).cast("int")


def salts(n: int) -> Column:
    """One row for each salt."""
    return F.explode(F.array([F.lit(i) for i in range(n)]))


def batches_to(schema: T.StructType) -> pa.Schema:
    """The Arrow schema that ``mapInArrow`` expects for a Spark schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def encoded(values: pa.Array) -> list[bytes]:
    """UTF-8 of every text of an Arrow column; null counts as the empty text."""
    return [x or b"" for x in values.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes] | list[str], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts of about ``limit`` bytes in all; one text is never split."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one byte array, each ended by a space, and the start of each (with the end of the last)."""
    lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer(b" ".join([*texts, b""]), np.uint8), starts


def tiles(text: bytes, overlap: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[bytes, int, bool]]:
    """A long text in pieces: each with up to ``overlap`` bytes before it, how many these are, and whether it is the last."""
    for at in range(0, max(len(text), 1), limit):
        context = min(at, overlap)
        yield text[at - context : at + limit], context, at + limit >= len(text)
