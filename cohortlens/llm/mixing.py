"""Mixing sources to target weights by Sainte-Lague apportionment.

Texts are laid end to end, in words, within shards (source and a hash of the
id), in an order drawn by a seeded hash.  Each shard is cut into blocks of
equal size.  The blocks that the mix takes are allocated to sources by the
highest quotients of their targets (target / 1, / 3, / 5 ...), then within a
source to its shards by the highest quotients of their blocks, which gives an
integer quota for each shard.  Of a shard's b blocks, quota // b copies of
each are taken, and the remaining quota % b are a run of blocks from a seeded
start, around the end (the texts' order is random already, and few are cut).
A text contributes those of its words that lie in taken blocks.

The highest quotients are found by their threshold: a claimant with weight w
gets every seat whose quotient is above it, round(w / d) seats for a divisor
d, and d is searched for the right total.

Scale: each text becomes a row (id, source, size); every source is spread over
shards whose number grows with the table, so no window or join meets a whole
source.  The list of sources (a mixture's configuration: name, size) is the
only thing that the driver holds, one row a source and at most
``max_sources``; it goes back out as quotas by shard through a join, not a
broadcast.  Blocks are never rows: the copies of any range of blocks are a
closed formula.

Cases: null and empty texts have size 0 and take 0; a null source is a source
of its own, after all others; a null id is hashed as an empty text, with the
row's text; rows that repeat an id are texts of their own; an
empty table gives an empty result; a source of size 0 has target 0.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import col, id_text, written

#: Shards of each source, at least; as many more as keep a shard below so many of all rows.
SHARDS, SHARD_ROWS = 64, 1_000_000
MOST = 3
#: Blocks that the smallest source is cut into at least, and words of a block at most.
BLOCKS, BLOCK_WORDS = 4096, 1024
MAX_SOURCES = 1_000_000
SEED = 42


def seats(weights: np.ndarray, n: int, most: np.ndarray) -> np.ndarray:
    """Sainte-Lague: ``n`` seats by highest quotients weight / 1, / 3, / 5 ..., at most ``most`` each."""
    weights, most = np.asarray(weights, float), np.asarray(most, np.int64)
    n = int(min(n, most[weights > 0].sum()))
    if n <= 0:
        return np.zeros(len(weights), np.int64)
    given = lambda d: np.minimum(np.floor(weights / d + 0.5), most).astype(np.int64)
    low, high = weights[weights > 0].min() / (4.0 * n + 4), 4 * weights.max() + 1
    while given(low).sum() < n:
        low /= 4
    for _ in range(200):  # given(low) >= n > given(high)
        middle = (low + high) / 2
        if given(middle).sum() >= n:
            low = middle
        else:
            high = middle
    out = given(high)
    spare = n - out.sum()
    if spare > 0:  # equal quotients at the threshold: the first claimants get the last seats
        more = np.flatnonzero((given(low) > out) & (out < most))
        for i in more:
            take = min(spare, int(given(low)[i] - out[i]))
            out[i] += take
            spare -= take
    return out


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = MOST) -> np.ndarray:
    """Shares of the total by weight, stopped at ``most`` times the size, the excess reshared by weight."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), sizes.sum()
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > most * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = most * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def words(text: Column) -> Column:
    """How many runs of anything but the contract's white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(documents: DataFrame, id: str, text: str, source: str, seed: int) -> DataFrame:
    """Narrow rows: _id, _text (a hash of it), _key (the source, null last in code point order), _shard, _place (seeded hashes), size."""
    name = col(source).cast("string")
    own = [id_text(id), col(text)]  # the text spreads rows that share an id, or have none
    rows = documents.select(
        col(id).alias("_id"),
        F.xxhash64(col(text)).alias("_text"),
        F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name)).alias("_key"),
        F.xxhash64(F.lit(seed), *own).alias("_shard"),
        F.xxhash64(F.lit(seed + 1), *own).alias("_place"),
        words(col(text)).alias("size"),
    )
    rows = written(rows, "mixing-sizes")
    n_shards = max(SHARDS, -(-rows.count() // SHARD_ROWS))
    return rows.withColumn("_shard", F.pmod("_shard", F.lit(n_shards)).cast("int"))


_QUOTAS = T.StructType(
    [T.StructField("_key", T.StringType()), T.StructField("_shard", T.IntegerType())]
    + [T.StructField(x, T.LongType()) for x in ("total", "length", "blocks", "quota", "source_size")]
    + [T.StructField("target", T.DoubleType())]
)


def quotas(rows: DataFrame, weights: tuple[float, ...], max_sources: int, most: int) -> DataFrame:
    """Of each shard: its words, its blocks, how many block copies it gives, and its source's size and target."""
    shards = written(rows.groupBy("_key", "_shard").agg(F.sum("size").alias("total")), "mixing-shards")
    listed = shards.groupBy("_key").agg(F.sum("total").alias("size")).limit(max_sources + 1).collect()
    if len(listed) > max_sources:
        raise ValueError(f"more than {max_sources} sources; raise max_sources, or name fewer sources")
    listed = sorted(listed, key=lambda r: r["_key"])
    sizes = np.array([r["size"] for r in listed], np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(listed))], float)
    target = targets(sizes, weight, most)
    smallest = int(sizes[sizes > 0].min()) if (sizes > 0).any() else 1
    # words of a block; at least so many that a shard's blocks squared fit in a long
    block = max(1, min(BLOCK_WORDS, smallest // BLOCKS), int(sizes.max(initial=0)) >> 30)
    given = seats(target, round(target.sum() / block), np.maximum(most * sizes // block, most * (sizes > 0)))
    plan = {r["_key"]: (int(s), float(t), int(g)) for r, s, t, g in zip(listed, sizes, target, given)}
    shared = rows.sparkSession.sparkContext.broadcast((block, plan))

    def allocate(pieces: pd.DataFrame) -> pd.DataFrame:
        block, plan = shared.value
        size, wanted, given = plan[pieces["_key"].iloc[0]]
        pieces = pieces.sort_values("_shard")
        total = pieces["total"].to_numpy(np.int64)
        length = -(-total // np.maximum(1, np.rint(total / block).astype(np.int64)))
        blocks = -(-total // np.maximum(length, 1))
        given = round(given * block * blocks.sum() / max(1, total.sum()))  # in blocks of these shards' own lengths
        quota = seats(blocks, given, most * blocks)
        return pieces.assign(length=length, blocks=blocks, quota=quota, source_size=size, target=wanted)[[f.name for f in _QUOTAS]]

    return shards.groupBy("_key").applyInPandas(allocate, _QUOTAS)


def plan(
    documents: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    seed: int = SEED,
    max_sources: int = MAX_SOURCES,
    most: int = MOST,
) -> DataFrame:
    """One narrow row a document: _id, _text (a hash of it), size, source_size, target, taken, and where it lies in its shard's blocks."""
    rows = sized(documents, id, text, source, seed)
    shard = quotas(rows, weights, max_sources, most).hint("shuffle_hash")
    running = Window.partitionBy("_key", "_shard").orderBy("_place", "size", "_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("_end", F.sum("size").over(running)).withColumn("_start", F.col("_end") - F.col("size"))
    placed = placed.join(shard, ["_key", "_shard"]).withColumn("_n", F.greatest("blocks", F.lit(1)).cast("long")).withColumn("_len", F.greatest("length", F.lit(1)).cast("long"))
    placed = placed.withColumn("_phase", F.pmod(F.xxhash64(F.lit(seed), "_key", "_shard"), F.col("_n")))
    placed = placed.withColumn("_base", F.expr("quota div _n")).withColumn("_more", F.expr("quota % _n"))

    def before(at: str) -> Column:
        """Words taken of the shard's first ``at`` words."""
        # drawn blocks among the first j: a run of _more blocks from _phase on, around the end to the start
        drawn = lambda j: f"(greatest(0L, least({j}, _phase + _more) - _phase) + least({j}, greatest(0L, _phase + _more - _n)))"
        j = f"({at} div _len)"
        return F.expr(f"_base * {at} + {drawn(j)} * _len + ({drawn(j + ' + 1')} - {drawn(j)}) * ({at} % _len)")

    placed = placed.withColumn("taken", before("_end") - before("_start"))
    return placed.select("_id", "_text", "size", "source_size", "target", "taken", "_start", F.struct("_len", "_n", "_phase", "_base", "_more").alias("_draw"))


def pieces(start: int, size: int, draw: dict) -> list[tuple[int, int]]:
    """The word ranges (start, end within the text) that the mix takes; a range that is taken twice comes twice."""
    length, n, phase, base, more = (draw[x] for x in ("_len", "_n", "_phase", "_base", "_more"))
    out = [(0, size)] * base if size else []
    begin = None
    for j in range(start // length, (start + size - 1) // length + 1 if size else 0):
        drawn = phase <= j < phase + more or j < phase + more - n
        lo, hi = max(0, j * length - start), min(size, (j + 1) * length - start)
        if drawn and begin is None:
            begin = lo
        if begin is not None and (not drawn or hi == size):
            out.append((begin, hi if drawn else lo))
            begin = None
    return out


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut(text: str, ranges: list[tuple[int, int]]) -> list[str]:
    """The ranges of words of a text, with the white space between their words; a whole text stays as it is."""
    data, spans, out = text.encode(), None, []
    for lo, hi in ranges:
        if spans is None and (lo, hi) != (0, len(data.split())):
            spans = [m.span() for m in _WORD.finditer(data)]
        whole = spans is None or (lo, hi) == (0, len(spans))
        out.append(text if whole else data[spans[lo][0] : spans[hi - 1][1]].decode())
    return out


def mix(documents: DataFrame, *, id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a row for each copy of a text or of a part of it.

    A column ``n_chars`` is set to the length of the row's text.  Rows of the
    same id and text share one place in the blocks.
    """
    placed = plan(documents, id=id, text=text, **options).where("taken > 0")
    placed = placed.groupBy(id_text("_id").alias("_k"), F.col("_text").alias("_h")).agg(F.min(F.struct("_start", "_draw", "size")).alias("_at"))

    @F.pandas_udf("array<string>")
    def texts(values: pd.Series, at: pd.DataFrame) -> pd.Series:
        draws = at["_draw"].to_dict("records") if isinstance(at["_draw"], pd.DataFrame) else [dict(x) for x in at["_draw"]]
        return pd.Series([cut(x or "", pieces(int(a), int(n), d)) for x, n, a, d in zip(values, at["size"], at["_start"], draws)])

    # the other columns and the text go apart, so that no row holds its text twice; texts shuffle unsorted
    others = F.struct(F.lit(0).alias("_0"), *[col(c).alias(c) for c in documents.columns if c != text])
    packed = documents.select(others.alias("_doc"), id_text(id).alias("_k"), col(text).alias("_text"), F.xxhash64(col(text)).alias("_h"))
    rows = packed.join(placed.hint("shuffle_hash"), ["_k", "_h"]).select("_doc", F.explode(texts("_text", "_at")).alias("_text"))
    own = {text: F.col("_text")} | ({n_chars: F.length("_text")} if n_chars in documents.columns else {})
    kinds = dict(documents.dtypes)
    return rows.select(*[own[c].cast(kinds[c]).alias(c) if c in own else F.col("_doc").getField(c).alias(c) for c in documents.columns])
