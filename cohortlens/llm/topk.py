"""Exact top-k inner products by block-at-a-time pruning.

Rows are laid out in ranges of (signs of the first components, id), so that
neighbours point in similar directions, and cut into blocks of ``BLOCK`` rows
within shards of about ``SHARD``.  A block keeps its forward index (the
integer vectors) and the largest and smallest value of each term (component).
For a query, the summed maxima of its terms bound every score in the block.
Each query takes a shard's blocks from the highest bound down and stops when a
bound falls below its k-th score so far; the result is exact.

Scale: queries start in the shard they lie in, which gives a k-th score before
any other shard is looked at; a chunk of queries then travels only to shards
whose summed maxima can still reach it.  The maxima of ``GROUP`` shards are one
row; a chunk meets these rows in a join and finds its shards in one product
with each.  These routes are a narrow written table; blocks that no chunk
travels to don't shuffle again.  A task holds one shard and streams query
chunks past it, up to about ``VISITS``: a shard that more travel to is visited
in parts, each with a copy of its blocks.  Nothing is broadcast; the driver
gets two counts.

Cases: a row whose id or vector is null, or whose vector is empty or has a
null or non-finite component, takes no part; vectors of different lengths are
compared as if padded with zeros; rows that repeat an id are rows of their
own, as candidates and as queries, and only the query's own row is left out;
fewer than k candidates give fewer ranks; ties go to the smaller id; an empty
table gives an empty result.  Scores are exact as long as they are longs;
components beyond a long after scaling, and scores beyond one, are clipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import col, salts, spread, written

BLOCK, SHARD = 256, 8192
#: Shards whose maxima are one row.
GROUP = 1024
#: Query chunks that are dealt to one copy of a shard's blocks.
VISITS = 256
SIGNS = 12
NONE = np.iinfo(np.int64).min + 1  # its negative is a long, too
_LONG = np.iinfo(np.int64)
_INDEX = "kind int, shard long, nth int, n int, wide boolean, rows binary, ids binary, vectors binary, low binary, high binary, kth binary"


class Best:
    """The k best (score, id) of each query of a chunk."""

    def __init__(self, n: int, k: int, kth: np.ndarray | None = None):
        self.scores, self.ids = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)
        self.kth = np.full(n, NONE) if kth is None else kth.copy()

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows x candidates) of candidates with these ids."""
        hit = np.flatnonzero((scores >= self.kth[rows][:, None]).any(axis=1))
        if not len(hit):
            return
        rows, k = rows[hit], self.scores.shape[1]
        s = np.concatenate([self.scores[rows], scores[hit]], axis=1)
        i = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        self.kth[rows] = np.maximum(self.kth[rows], self.scores[rows, -1])


def largest(x: np.ndarray) -> float:
    return max(float(x.max()), -float(x.min())) if x.size else 0.0


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T: through floating point where its 53 bits hold every sum, as longs, or as Python's integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = largest(a) * largest(b) * max(1, width)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64) if bound < 2**62 else a.astype(object) @ b.T.astype(object)


def as_long(x: np.ndarray) -> np.ndarray:
    return np.clip(x, NONE + 1, _LONG.max).astype(np.int64) if x.dtype == object else x


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The summed term maxima of each query (rows) in each block (columns)."""
    return as_long(product(np.maximum(queries, 0), high) + product(np.minimum(queries, 0), low))


Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # row numbers, ids, vectors


def search(best: Best, numbers: np.ndarray, queries: np.ndarray, blocks: list[Block], low: np.ndarray, high: np.ndarray) -> int:
    """Score the queries (row numbers, vectors) in these blocks, each from its highest bound down; returns how many (query, block) were scored."""
    bound = bounds(queries, low, high)
    order = np.argsort(-bound, axis=1, kind="stable")
    live, scored = np.arange(len(queries)), 0
    for turn in range(len(blocks)):
        nth = order[live, turn]
        keep = bound[live, nth] >= best.kth[live]  # a tie at the bound may still have a smaller id
        live, nth = live[keep], nth[keep]
        if not len(live):
            break
        scored += len(live)
        by_block = np.argsort(nth, kind="stable")
        for rows in np.split(live[by_block], np.flatnonzero(np.diff(nth[by_block])) + 1):
            there, ids, vectors = blocks[order[rows[0], turn]]
            scores = as_long(product(queries[rows], vectors))
            scores[numbers[rows][:, None] == there[None, :]] = NONE
            best.add(rows, scores, ids)
    return scored


def matrix(rows: pa.Array) -> np.ndarray:
    """Lists of longs as rows, padded with zeros; 32 bits a component if that is enough."""
    lengths = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), int(lengths.max(initial=0))), np.int32 if largest(flat) < 2**31 else np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def _results(numbers: np.ndarray, ids: np.ndarray, best: Best) -> tuple[np.ndarray, ...]:
    row, rank = np.nonzero(best.scores > NONE)
    return numbers[row], ids[row], best.ids[row, rank], best.scores[row, rank]


def build(every: int, k: int):
    """Over sorted rows (row number, id, vector): block rows (kind 0), a row of the shard's queries with their k-th scores (1), their results here (2)."""

    def shard_rows(number: int, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple]:
        wide = vectors.dtype == np.int64
        blocks = [(numbers[a : a + BLOCK], ids[a : a + BLOCK], vectors[a : a + BLOCK]) for a in range(0, len(ids), BLOCK)]
        low, high = (np.stack([f(v, axis=0) for *_, v in blocks]) for f in (np.min, np.max))
        for nth, (rows, own, v) in enumerate(blocks):
            yield (0, number, nth, len(own), wide, rows.tobytes(), own.tobytes(), v.tobytes(), low[nth].tobytes(), high[nth].tobytes(), None)
        asked = np.flatnonzero(ids % every == 0)
        if len(asked):
            rows, own, queries = numbers[asked], ids[asked], vectors[asked]
            best = Best(len(own), k)
            search(best, rows, queries, blocks, low, high)
            yield (1, number, 0, len(own), wide, rows.tobytes(), own.tobytes(), queries.tobytes(), None, None, best.kth.tobytes())
            r, q, i, s = _results(rows, own, best)
            yield (2, number, 0, len(q), wide, r.tobytes(), q.tobytes(), i.tobytes(), s.tobytes(), None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        n = 0

        def emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal number
            numbers, ids = (rows.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            out = list(zip(*shard_rows(number, numbers, ids, matrix(rows.column(2).combine_chunks()))))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()] + [pa.binary()] * 6
            names = [x.split()[0] for x in _INDEX.split(", ")]
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=names)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= 2 * SHARD:  # a range that came out long becomes several shards
                whole = pa.Table.from_batches(held)
                yield from emit(whole.slice(0, SHARD))
                held, n = whole.slice(SHARD).to_batches(), n - SHARD
        if n:
            yield from emit(pa.Table.from_batches(held))

    return run


def _vectors(data: bytes, n: int, wide: bool) -> np.ndarray:
    return np.frombuffer(data, np.int64 if wide else np.int32).reshape(n, -1)


def visit(k: int):
    """Over rows of one part of a shard's visits after another, its blocks first, then query chunks: results (query_row, query_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visited, blocks, low, high = None, [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["part"]) != visited:
                    visited, blocks, low, high = (row["shard"], row["part"]), [], [], []
                vectors = _vectors(row["vectors"], row["n"], row["wide"])
                numbers, ids = (np.frombuffer(row[x], np.int64) for x in ("rows", "ids"))
                if row["kind"] == 0:
                    blocks.append((numbers, ids, vectors))
                    low.append(_vectors(row["low"], 1, row["wide"])[0])
                    high.append(_vectors(row["high"], 1, row["wide"])[0])
                else:
                    best = Best(len(ids), k, np.frombuffer(row["kth"], np.int64))
                    search(best, numbers, vectors, blocks, np.stack(low), np.stack(high))
                    names = ["query_row", "query_id", "vec_id", "score"]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _results(numbers, ids, best)], names=names)

    return run


def usable(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """Rows (_row, a number of their own, _id, _vector of longs) that take part."""
    value = col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(col(id).isNotNull() & value.isNotNull() & (F.size(value) > 0)).where(~bad)
    scaled = F.transform(value, lambda x: F.floor(F.greatest(F.least(F.lit(scale) * x.cast("double"), F.lit(9.2e18)), F.lit(-9.2e18))))
    return rows.select(F.monotonically_increasing_id().alias("_row"), col(id).cast("long").alias("_id"), scaled.alias("_vector"))


def signs(vector: str) -> Column:
    """Which of the first components are positive, as a number."""
    return sum((F.when(F.get(F.col(vector), F.lit(i)) > 0, F.lit(1 << (SIGNS - 1 - i))).otherwise(F.lit(0)) for i in range(SIGNS)), F.lit(0))


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose id is divisible by ``every``, the ``k`` rows of highest integer inner product."""
    rows = written(usable(vectors, id, vector, scale), "topk-rows")
    n_shards = max(1, -(-rows.count() // SHARD))
    rows = rows.withColumn("_signs", signs("_vector")).repartitionByRange(n_shards, "_signs", "_id", "_row").sortWithinPartitions("_signs", "_id", "_row")
    index = written(rows.select("_row", "_id", "_vector").mapInArrow(build(every, k), _INDEX), "topk-index")
    blocks, asked = index.where("kind = 0"), index.where("kind = 1")

    # the maxima of each shard, those of GROUP shards in a row, and the shards that a chunk of queries must travel to
    def extremes(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        low, high = ([_vectors(x, 1, w)[0] for x, w in zip(group[c], group["wide"])] for c in ("low", "high"))
        low, high = np.min(np.stack(low), axis=0).astype(np.int64), np.max(np.stack(high), axis=0).astype(np.int64)
        return pd.DataFrame({"shard": [key[0]], "low": [low.tobytes()], "high": [high.tobytes()]})

    def stacked(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, group["low"]))
        parts = {c: b"".join(x.ljust(width, b"\0") for x in group[c]) for c in ("low", "high")}
        return pd.DataFrame({"group": [key[0]], "shards": [group["shard"].to_numpy(np.int64).tobytes()], "lows": [parts["low"]], "highs": [parts["high"]]})

    n_groups = -(-n_shards // GROUP)
    summary = blocks.select("shard", "wide", "low", "high").groupBy("shard").applyInPandas(extremes, "shard long, low binary, high binary")
    summary = summary.withColumn("group", spread(n_groups, "shard")).groupBy("group").applyInPandas(stacked, "group int, shards binary, lows binary, highs binary")

    @F.pandas_udf("array<long>")
    def reach(home: pd.Series, n: pd.Series, wide: pd.Series, data: pd.Series, kth: pd.Series, shards: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
        out = []
        for own, size, w, v, least, there, low, high in zip(home, n, wide, data, kth, shards, lows, highs):
            there = np.frombuffer(there, np.int64)
            low, high = (np.frombuffer(x, np.int64).reshape(len(there), -1) for x in (low, high))
            hit = (bounds(_vectors(v, size, w), low, high) >= np.frombuffer(least, np.int64)[:, None]).any(axis=0)
            out.append(there[hit & (there != own)])
        return pd.Series(out, dtype=object)

    travel = asked.withColumn("group", salts(n_groups)).join(summary, "group")
    routes = travel.select(F.col("shard").alias("home"), F.explode(reach("shard", "n", "wide", "vectors", "kth", "shards", "lows", "highs")).alias("shard"))
    routes = written(routes, "topk-routes")
    visits = routes.groupBy("shard").agg(F.ceil(F.count("*") / VISITS).cast("int").alias("parts"))
    n_visits = visits.agg(F.sum("parts")).first()[0] or 1
    copies = visits.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    routes = routes.join(visits, "shard").select("home", "shard", F.pmod(F.xxhash64("home"), F.col("parts")).cast("int").alias("part"))
    chunks = asked.withColumnRenamed("shard", "home").join(routes, "home").drop("home")
    both = blocks.join(copies, "shard").unionByName(chunks).repartition(n_visits, "shard", "part").sortWithinPartitions("shard", "part", "kind", "nth")
    away = both.mapInArrow(visit(k), "query_row long, query_id long, vec_id long, score long")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                arrays = [pa.array(np.frombuffer(row[x], np.int64)) for x in ("rows", "ids", "vectors", "low")]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_row", "query_id", "vec_id", "score"])

    home = index.where("kind = 2").select("rows", "ids", "vectors", "low").mapInArrow(unpack, "query_row long, query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    out = home.unionByName(away).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
