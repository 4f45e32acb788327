"""Repeated lines across documents, found with two Bloom filters.

Pass one hashes each document's different line keys and sets their bits in a
filter of bits seen once and a filter of bits seen twice or more.  Pass two
probes the second: only lines whose bits have all been seen twice are
suspects, and only (hash, id) of suspects shuffle, to be counted exactly and
to choose the one document that keeps the line.  Documents without a suspect
line pass straight through; the others meet the list of lines they lose.

Scale: equal lines are reduced before the shuffle (partial aggregates), and a
line that is in a third of all documents meets its documents in ``SALTS``
tasks.  A filter that outgrows what is sent to executors stays on Spark, as in
``exact_dedup``: the suspect hashes then meet the lines, and the lists of lost
lines the documents, in joins.  A document's list of lost lines
is no longer than the document.

Cases: null and empty texts are one empty line; rows are documents, so a
repeated row counts again; among ids null is the smallest, and rows that
share the largest id all keep the line; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import col, encoded, id_text, salts, spread, written
from cohortlens.llm.exact_dedup import RANGE_BITS, blocks_for, fits, prober, suspect_hashes

MIN_CHARS, MIN_DOCUMENTS = 20, 3
SALTS = 16


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128 bits of a line's key, or None for one that is too short to count."""
    key = line.strip().lower()  # of bytes: the contract's white space and A-Z only
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(text: bytes, min_chars: int) -> list[bytes]:
    """The different hashes of a document's lines."""
    return list({h for line in text.split(b"\n") if (h := line_hash(line, min_chars))})


def first_bytes(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), "<i8")[::2].astype(np.int64)


def suspect_lines(min_chars: int, test: Callable[[np.ndarray], np.ndarray] | None = None):
    """Over rows (id, text, key): a row (_id, _key, _line, _hash) for each different line hash that the test lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [line_hashes(x, min_chars) for x in encoded(batch.column(1))]
            rows = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
            flat = [h for own in hashes for h in own]
            first = first_bytes(flat)
            lines = pa.array(flat, pa.binary())
            if test is not None and len(flat):
                keep = np.flatnonzero(test(first))
                rows, lines, first = rows[keep], lines.take(pa.array(keep)), first[keep]
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(2).take(of), lines, pa.array(first)], names=["_id", "_key", "_line", "_hash"])

    return run


def drop_repeated_lines(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, range_bits: int = RANGE_BITS
) -> DataFrame:
    """All rows and columns, with ``kept_text``, ``n_lines`` and ``n_dropped`` in last columns (in place of any of those names)."""
    documents = documents.drop("kept_text", "n_lines", "n_dropped")
    others = F.struct(F.lit(0).alias("_0"), *[col(c).alias(c) for c in documents.columns if c != text])  # no row holds its text twice
    # rows that share an id lose the same lines; those without one are told apart by their text
    key = F.when(col(id).isNull(), F.concat(F.lit("\0"), F.hex(F.xxhash64(col(text))))).otherwise(id_text(id))
    packed = documents.select(others.alias("_doc"), col(id).alias("_id"), col(text).alias("_text"), key.alias("_key"))
    schema = f"_id {packed.schema['_id'].dataType.simpleString()}, _key string, _line binary, _hash long"
    read = packed.select("_id", "_text", "_key")
    hashes = written(read.mapInArrow(suspect_lines(min_chars), schema).select("_hash"), "line-hashes")
    n_rows = hashes.count()
    if fits(n_rows, range_bits):
        test = prober(hashes, "_hash", blocks_for(n_rows))
        suspect = read.mapInArrow(suspect_lines(min_chars, test), schema)

        @F.pandas_udf("boolean")
        def any_suspect(texts: pd.Series) -> pd.Series:
            hashes = [line_hashes((x or "").encode(), min_chars) for x in texts]
            return pd.Series([bool(len(x)) and bool(test(first_bytes(x)).any()) for x in hashes])

        packed = packed.withColumn("_any", any_suspect("_text"))
    else:  # the filter is probed on the narrow hashes, block by block, and every document meets its list
        found = suspect_hashes(hashes, n_rows)
        suspect = read.mapInArrow(suspect_lines(min_chars), schema).join(found, "_hash", "left_semi")
        packed = packed.withColumn("_any", F.lit(True))
    suspect = written(suspect.select("_id", "_key", "_line"), "line-suspects")
    order = F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"))
    repeated = suspect.groupBy("_line").agg(F.count("*").alias("n"), F.max(order).alias("last")).where(F.col("n") >= min_documents)
    repeated = repeated.select("_line", "last").withColumn("_salt", salts(SALTS))
    lost = suspect.withColumn("_salt", spread(SALTS, "_key")).join(repeated, ["_line", "_salt"])
    lost = lost.where(~F.col("_id").eqNullSafe(F.col("last.id"))).groupBy("_key").agg(F.collect_set("_line").alias("_lost"))

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def cut(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        out = []
        for whole, gone in zip(texts, lost):
            own = (whole or "").split("\n")
            if gone is None:
                out.append((whole or "", len(own), 0))
                continue
            gone = {bytes(x) for x in gone}
            kept = [x for x in own if line_hash(x.encode(), min_chars) not in gone]
            out.append(("\n".join(kept), len(own), len(own) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    rows = packed.where("_any").join(lost, "_key", "left").withColumn("_cut", cut("_text", "_lost"))
    whole = F.coalesce("_text", F.lit(""))
    straight = packed.where("NOT _any").select(
        "_doc", "_text", F.struct(whole.alias("kept"), (F.length(whole) - F.length(F.translate(whole, "\n", "")) + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).alias("_cut")
    )
    rows = straight.unionByName(rows.select("_doc", "_text", "_cut"))
    own = [F.col("_text").alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in documents.columns]
    return rows.select(*own, F.col("_cut.kept").alias("kept_text"), F.col("_cut.n_lines").alias("n_lines"), F.col("_cut.n_dropped").alias("n_dropped"))
