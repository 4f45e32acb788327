"""Exact de-duplication with two passes over Bloom filters.

Pass one hashes each text without its white space (SHA-256) and sets the bits
of the hash in Bloom filters: one for bits set once, one for bits set by two
rows or more.  Pass two probes the second filter: a row with a bit that only
it has set cannot have an equal and passes straight through; only the rest,
the suspects, shuffle for the exact comparison.

Scale: texts are never shuffled by ``decide``; it works on one narrow row a
document (id, length, hash).  All bits of a hash lie in one block; blocks are
kept sparse and merged on the executors; a filter has about ``BITS_A_ROW`` bits
a row.  A filter of at most ``RANGE_BITS`` goes through the driver to the
executors as packed bytes (32 MB).  A larger one stays on Spark: its blocks are
a written table, hashes (equal ones reduced within a task first) meet the
block that they lie in, and rows learn by a salted join whether their hash is
suspect.  Groups of copies are reduced before the shuffle (partial
aggregates), and the join that gives each copy its group spreads a group over
``SALTS`` tasks.

Cases: a null text counts as empty, and empty texts equal each other and
white-space texts; null ids sort last among texts of the same length; of rows
that repeat even the id, one is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WHITE, col, salts, spread, written

HASHES = 4
BITS_A_ROW = 48
BLOCK_BITS = 1 << 16
#: Bits of a filter that is sent to executors whole.
RANGE_BITS = 1 << 28
SALTS = 16


def blocks_for(n_rows: int, bits_a_row: int = BITS_A_ROW) -> int:
    """How many blocks the filter for a number of rows has."""
    return max(1, -(-n_rows * bits_a_row // BLOCK_BITS))


def block_of(hash: Column, n_blocks: int) -> Column:
    """The block of a 64-bit hash (a long)."""
    return F.shiftrightunsigned(hash, 20) % F.lit(n_blocks)


def offsets(hashes: np.ndarray) -> np.ndarray:
    """The bits of each 64-bit hash within its block, a row for each."""
    mixed = ((hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).astype("<u8")
    return mixed.view("<u2").reshape(len(hashes), HASHES)


def positions(hashes: np.ndarray, n_blocks: int) -> np.ndarray:
    """The bits of each hash (unsigned) in the whole filter."""
    block = ((hashes >> np.uint64(20)) % np.uint64(n_blocks)).astype(np.int64)
    return block[:, None] * BLOCK_BITS + offsets(hashes)


def repeated_bits(hashes: DataFrame, n_blocks: int) -> DataFrame:
    """Blocks of the filter of bits set twice or more: (block, bits), the bits as sorted 16-bit offsets."""

    def reduced(parts: list[np.ndarray]) -> np.ndarray:
        """Sorted positions, none more than twice: more often says no more."""
        at = np.sort(np.concatenate(parts))
        return at[np.r_[True, True, at[2:] != at[:-2]][: len(at)]]

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            parts.append(positions(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), n_blocks).ravel())
            held += len(parts[-1])
            if held > 1 << 22:
                parts = [reduced(parts)]
                held = len(parts[0])
        at = reduced(parts) if held else np.empty(0, np.int64)
        for begin in range(0, len(at), 1 << 22):
            own = at[begin : begin + (1 << 22)]
            block = own // BLOCK_BITS
            first = np.flatnonzero(np.r_[True, np.diff(block) > 0])
            pieces = np.split((own % BLOCK_BITS).astype(np.uint16), first[1:])
            yield pa.RecordBatch.from_arrays([pa.array(block[first]), pa.array([x.tobytes() for x in pieces], pa.binary())], names=["block", "bits"])

    def merge(key: tuple, pieces: pa.Table) -> pa.Table:
        """Once-seen and twice-seen bits of a block; the second filter is what pass two needs."""
        seen = np.bincount(np.frombuffer(b"".join(pieces.column("bits").to_pylist()), np.uint16), minlength=BLOCK_BITS)
        twice = np.flatnonzero(seen > 1).astype(np.uint16)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([twice.tobytes()], pa.binary())})

    pieces = hashes.mapInArrow(set_bits, "block long, bits binary")
    return pieces.groupBy("block").applyInArrow(merge, "block long, bits binary")


def packed_block(bits: bytes) -> np.ndarray:
    """A block's sparse bits as packed bytes."""
    out = np.zeros(BLOCK_BITS, bool)
    out[np.frombuffer(bits, np.uint16)] = True
    return np.packbits(out)


def prober(hashes: DataFrame, hash: str, n_blocks: int) -> Callable[[np.ndarray], np.ndarray]:
    """A test, for use in tasks, of hashes (longs): false only if at most one row of ``hashes`` has it."""
    size = BLOCK_BITS // 8
    twice = np.zeros(n_blocks * size, np.uint8)
    for block, found in repeated_bits(hashes.select(col(hash)), n_blocks).toPandas().itertuples(index=False):
        twice[block * size : (block + 1) * size] = packed_block(found)
    shared = hashes.sparkSession.sparkContext.broadcast(twice)
    return lambda values: all_set(shared.value, positions(values.astype(np.int64, copy=False).view(np.uint64), n_blocks))


def all_set(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)


def probed(test: Callable[[np.ndarray], np.ndarray], hash: Column) -> Column:
    """A prober's test as a boolean column."""

    @F.pandas_udf("boolean")
    def probe(values: pd.Series) -> pd.Series:
        return pd.Series(test(values.to_numpy(np.int64)))

    return probe(hash)


def fits(n_rows: int, range_bits: int = RANGE_BITS) -> bool:
    """Whether the filter for a number of rows is sent to executors whole."""
    return blocks_for(n_rows) * BLOCK_BITS <= max(range_bits, BLOCK_BITS)


def suspect_hashes(hashes: DataFrame, n_rows: int, hash: str = "_hash") -> DataFrame:
    """The different hashes (longs, in a column of the same name) that several rows may have; the filter stays on Spark."""
    n_blocks = blocks_for(n_rows)
    blocks = written(repeated_bits(hashes.select(col(hash)), n_blocks), "filter-blocks")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            n += len(held[-1])
            if n > 1 << 21:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["hash"])
                held, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["hash"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows (block, hash, bits), each block's bits before its hashes."""
        packed = np.zeros(BLOCK_BITS // 8, np.uint8)
        for batch in batches:
            block, bits = batch.column(0).to_numpy(), batch.column(2)
            values = batch.column(1).fill_null(0).to_numpy().view(np.uint64)
            is_bits, found = bits.is_valid().to_numpy(zero_copy_only=False), np.zeros(len(block), bool)
            edges = np.r_[0, np.flatnonzero(np.r_[False, np.diff(block) != 0] | is_bits), len(block)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if is_bits[a]:
                    packed = packed_block(bits[int(a)].as_py())
                    a += 1
                found[a:b] = all_set(packed, offsets(values[a:b]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(values[found].view(np.int64))], names=[hash])

    none = F.lit(None)
    own = hashes.select(col(hash).alias("hash")).mapInArrow(different, "hash long")
    own = own.select(block_of(F.col("hash"), n_blocks).alias("block"), "hash", none.cast("binary").alias("bits"))
    rows = own.unionByName(blocks.select("block", none.cast("long").alias("hash"), "bits"))
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("bits").isNull())
    return rows.mapInArrow(probe, f"`{hash}` long").distinct()


def suspects(hashed: DataFrame, n_rows: int, hash: str = "_hash", spread_by: str = "_row", *, range_bits: int = RANGE_BITS) -> DataFrame:
    """All rows with a boolean ``_suspect``: false only if no other row has the same hash (a long).

    ``hashed`` should be a written table: it is read once more.
    """
    if fits(n_rows, range_bits):
        return hashed.withColumn("_suspect", probed(prober(hashed, hash, blocks_for(n_rows)), col(hash)))
    return told(hashed, suspect_hashes(hashed, n_rows, hash), hash, spread_by)


def told(rows: DataFrame, found: DataFrame, hash: str, spread_by: str) -> DataFrame:
    """Rows with ``_suspect``: whether their hash is among those found; rows that share one meet it in ``SALTS`` tasks."""
    found = found.withColumn("_suspect", F.lit(True)).withColumn("_salt", salts(SALTS))
    rows = rows.withColumn("_salt", spread(SALTS, spread_by)).join(found, [hash, "_salt"], "left").drop("_salt")
    return rows.withColumn("_suspect", F.coalesce("_suspect", F.lit(False)))


def normalised(text: str = "text") -> Column:
    """The text without the contract's white space; null counts as empty."""
    return F.translate(F.coalesce(col(text), F.lit("")), WHITE, "")


def signatures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_sha`` (binary), ``_hash`` (its first 8 bytes, mixed) and ``_length`` (code points) to each row."""
    df = df.withColumn("_sha", F.unhex(F.sha2(normalised(text), 256)))
    return df.withColumn("_hash", F.xxhash64("_sha")).withColumn("_length", F.coalesce(F.length(col(text)), F.lit(0)))


def decide(documents: DataFrame, *, id: str = "doc_id", text: str = "text", range_bits: int = RANGE_BITS) -> DataFrame:
    """One row a document: ``id``, keep_id, group_size, kept, text_sha256 (the operator's decisions, without texts)."""
    narrow = signatures(documents.select(col(id).alias("_id"), col(text).alias("_text")), "_text")
    narrow = narrow.select("_id", "_length", "_sha", "_hash", F.monotonically_increasing_id().alias("_row"))
    narrow = written(narrow, "exact-dedup")
    marked = suspects(narrow, narrow.count(), range_bits=range_bits)
    one = F.lit(1).cast("long")
    alone = marked.where(~F.col("_suspect")).select("_id", F.col("_id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "_sha")
    rows = marked.where("_suspect").drop("_suspect", "_hash")
    # the longest text first, then the smallest id (null last), then the first row
    order = F.struct((-F.col("_length")).alias("n"), F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    groups = rows.groupBy("_sha").agg(F.min(order).alias("top"), F.count("*").alias("group_size"))
    # a group that is hot among the rows meets its one line of `groups` in SALTS tasks
    groups = groups.where("group_size > 1").withColumn("_salt", salts(SALTS))
    rows = rows.withColumn("_salt", (F.col("_row") % SALTS).cast("int")).join(groups, ["_sha", "_salt"], "left")
    first = F.coalesce(F.col("top.row") == F.col("_row"), F.lit(True))
    keep_id = F.when(F.col("top").isNull(), F.col("_id")).otherwise(F.col("top.id"))
    rows = rows.select("_id", keep_id.alias("keep_id"), F.coalesce("group_size", one).alias("group_size"), first.alias("kept"), "_sha")
    out = alone.unionByName(rows)
    return out.select(F.col("_id").alias(id), "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256"))


def deduplicate(documents: DataFrame, *, id: str = "doc_id", text: str = "text", range_bits: int = RANGE_BITS) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that are no suspects pass straight through; only whole suspect rows
    shuffle, and the copies that a task holds of a text are reduced to one
    before they do.  A filter of more than ``range_bits`` bits is not sent out
    whole: the suspects are then found on the narrow hashes, block by block,
    and rows learn by a join on the hash whether they are among them.
    """
    packed = documents.select(F.struct("*").alias("_doc"), col(id).alias("_id"), col(text).alias("_text"))
    signed = signatures(packed, "_text").drop("_text")
    hashes = written(signed.select("_hash"), "exact-dedup-hashes")
    n_rows = hashes.count()
    if fits(n_rows, range_bits):
        marked = signed.withColumn("_suspect", probed(prober(hashes, "_hash", blocks_for(n_rows)), F.col("_hash")))
    else:
        marked = told(signed, suspect_hashes(hashes, n_rows), "_hash", "_id")
    # the longest text first, then the smallest id (null last), then the first by its hash
    order = F.struct((-F.col("_length")).alias("n"), F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.xxhash64("_doc").alias("row"))
    one = marked.where("_suspect").groupBy("_sha").agg(F.min_by("_doc", order).alias("_doc"))
    return marked.where(~F.col("_suspect")).select("_doc").unionByName(one.select("_doc")).select("_doc.*")
