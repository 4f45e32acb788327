"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint has a bit for each bit that more than half of a text's shingle
hashes have.  Two fingerprints within ``max_bits`` differing bits, cut into
``max_bits + 2`` pieces, agree in two pieces at least, so every linked pair
meets in one of the buckets named by two pieces (exact: no pair is lost).
Within a bucket, fingerprints are stored as bit planes, 64 to a machine word.
A fingerprint is compared with 64 others at once: plane by plane, differing
bits are added into carry-save counters of a few words, and a block of 64 is
abandoned when all of its counters have passed the radius.

Scale: a text is read once and becomes 8 bytes; equal fingerprints are
reduced to one before anything is compared.  Buckets are read from sorted
partitions as a stream; a bucket of more than ``BUCKET`` fingerprints is cut
into parts whose pairs are separate units of work on other tasks.  A unit
emits a spanning forest of its links, never all pairs.  Components come from
alternating star contraction over those links; hot nodes are joined salted.
Broadcast: the list of buckets above ``BUCKET``, and that of rows to drop, if
their counted size is small; longer ones are joined by a shuffle.

Cases: null counts as empty; a text without words has fingerprint zero and
links like any other; null ids take part in links, but a component's id is
the smallest id that is not null (null if there is none); repeated rows link
to each other; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import chunks, col, encoded, salts, spread, written

BUCKET = 1 << 15
#: Runs up to this length are compared many at a time.
SMALL = 256
#: Pairs of a fingerprint and a word of 64 others that are compared in one pass.
PASS = 1 << 18
SALTS = 16
#: Lists up to this size are broadcast: row hashes of ``MARK_BYTES``, hot buckets of ``HOT_BYTES``.
BROADCAST_BYTES, MARK_BYTES, HOT_BYTES = 64 << 20, 64, 48
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- fingerprints


def shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.lower().split()  # of bytes: lowers A-Z only, splits at the contract's white space only
    if not words:
        return []
    whole = b" ".join(words)
    ends = list(itertools.accumulate(len(x) + 1 for x in words))
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(whole, 42)]
    digest = xxhash.xxh64_intdigest
    return [digest(whole[a : b - 1], 42) for a, b in zip([0, *ends], ends[width - 1 :])]


def fingerprints(texts: list[bytes], width: int = 3) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit numbers."""
    out = np.zeros(len(texts), ">u8")
    for a, b in chunks(texts):
        hashes = [shingle_hashes(x, width) for x in texts[a:b]]
        n = np.fromiter(map(len, hashes), np.int64, b - a)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        flat = np.fromiter(itertools.chain.from_iterable(hashes), np.uint64, int(n.sum())).astype(">u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(n) - n)[some]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[a + some] = np.packbits(2 * counts > n[some][:, None], axis=1).reshape(-1).view(">u8")
    return out.astype(np.uint64)


def fingerprint(text: str, width: int = 3) -> Column:
    """The fingerprint of a text column as a long (the same 64 bits, signed)."""

    @F.pandas_udf("long")
    def of(values: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(encoded(pa.Array.from_pandas(values, type=pa.string())), width).view(np.int64))

    return of(col(text))


# ---- comparison


def planes_of(prints: np.ndarray) -> np.ndarray:
    """64 bit planes; bit ``i % 64`` of word ``i // 64`` of plane p is bit p of fingerprint i."""
    padded = np.zeros(-(-len(prints) // 64) * 64, "<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def within(prints: np.ndarray, planes: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each (query, word): the lanes, of those given, whose fingerprint is within the radius.

    Returns the positions of the pairs with such a lane, and their lanes.  The
    counters start so that they overflow at radius + 1 differing bits; full
    adders take in three planes at a time.
    """
    size = max(1, int(radius).bit_length())
    start = (1 << size) - 1 - radius
    at = np.arange(len(query))
    values = prints[query]
    counters = [np.full(len(at), _FULL if start >> k & 1 else 0, np.uint64) for k in range(size)]
    over = ~lanes
    for p in range(0, 64, 3):
        a, b, c = (planes[q][word] ^ (np.uint64(0) - (values >> np.uint64(q) & np.uint64(1))) if q < 64 else None for q in (p, p + 1, p + 2))
        if b is None:
            low, high = a, np.zeros_like(a)
        else:
            half = a ^ b
            low, high = half ^ c, (a & b) | (half & c)
        carry = counters[0] & low
        counters[0] ^= low
        added = [high, carry]
        for k in range(1, size):
            both = added[0] & added[1]
            half = added[0] ^ added[1]
            carry = counters[k] & half
            counters[k] ^= half
            added = [both, carry]
        over |= added[0] | added[1]
        if p % 6 == 3:
            alive = np.flatnonzero(over != _FULL)
            if len(alive) < 0.75 * len(at):
                at, values, word, over = at[alive], values[alive], word[alive], over[alive]
                counters = [x[alive] for x in counters]
    alive = np.flatnonzero(over != _FULL)
    return at[alive], ~over[alive]


def lanes_between(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A word with lanes lo to hi - 1 set, both clipped to a word."""
    below = lambda n: np.where(n >= 64, _FULL, (np.uint64(1) << np.clip(n, 0, 63).astype(np.uint64)) - np.uint64(1))
    return below(hi) & ~below(lo)


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest node reachable from each node."""
    label = np.arange(n) if label is None else label
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def expand(word: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set lane: which of the entries has it, and the fingerprint it stands for."""
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    entry, lane = np.nonzero(bits)
    return entry, word[entry] * 64 + lane


def link_runs(prints: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """Labels of fingerprints that are compared with those after them up to their run's end."""
    n, planes = len(prints), planes_of(prints)
    first = np.arange(1, n + 1)
    counts = np.where(first < ends, (ends - 1) // 64 - first // 64 + 1, 0)
    cuts = np.cumsum(counts)
    label, begin = np.arange(n), 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(cuts, (cuts[begin - 1] if begin else 0) + PASS, "right")))
        own = counts[begin:stop]
        query = np.repeat(np.arange(begin, stop), own)
        word = first[query] // 64 + np.arange(len(query)) - np.repeat(np.cumsum(own) - own, own)
        at, lanes = within(prints, planes, query, word, lanes_between(first[query] - 64 * word, ends[query] - 64 * word), radius)
        entry, other = expand(word[at], lanes)
        label = forest(n, query[at][entry], other, label)
        begin = stop
    return label


def link_large(prints: np.ndarray, radius: int, rows: int = 256) -> np.ndarray:
    """Labels within one long run; of each fingerprint only the first link of a pass is kept, and links between passes' queries."""
    n, planes = len(prints), planes_of(prints)
    label = np.arange(n)
    for begin in range(0, n, rows):
        q = np.arange(begin, min(n, begin + rows))
        words = np.arange(begin // 64, planes.shape[1])
        query, word = np.repeat(q, len(words)), np.tile(words, len(q))
        at, lanes = within(prints, planes, query, word, lanes_between(query + 1 - 64 * word, n - 64 * word), radius)
        masks = np.zeros((len(q), len(words)), np.uint64)
        masks[query[at] - begin, word[at] - words[0]] = lanes
        linked = np.bitwise_or.reduce(masks, axis=0)
        owner = np.full(n, -1)
        pairs = []
        for i in range(len(q)):  # the first query that links a lane owns it; later ones link to its owner
            if masks[i].any():
                _, hit = expand(words[masks[i] != 0], masks[i][masks[i] != 0])
                owners = owner[hit]
                pairs += [(q[i], x) for x in np.unique(owners[owners >= 0])]
                owner[hit[owners < 0]] = q[i]
        if linked.any():
            mine = np.flatnonzero(owner >= 0)
            more = np.array(pairs, np.int64).reshape(-1, 2)
            label = forest(n, np.r_[mine, more[:, 0]], np.r_[owner[mine], more[:, 1]], label)
    return label


def bucket_links(radius: int):
    """Over rows (unit, part, print) sorted by unit and part: a forest of the links within each."""

    def emit(prints: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
        child = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(prints[child].view(np.int64)), pa.array(prints[label[child]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting
            unit, part, prints = (np.concatenate(x) for x in zip(*held))
            edge = np.flatnonzero((np.diff(unit) != 0) | (np.diff(part) != 0)) + 1
            starts = np.r_[0, edge]
            cut = len(unit) if last else int(starts[-1])
            held, waiting = ([] if last else [(unit[cut:], part[cut:], prints[cut:])]), 0
            starts = starts[starts < cut]
            ends = np.r_[starts[1:], cut].astype(np.int64)
            sizes = ends - starts
            for i in np.flatnonzero(sizes > SMALL):
                own = prints[starts[i] : ends[i]]
                yield emit(own, link_large(own, radius))
            small = np.flatnonzero((sizes > 1) & (sizes <= SMALL))
            if len(small):
                own = sizes[small]
                offset = np.cumsum(own) - own
                rows = np.arange(own.sum()) + np.repeat(starts[small] - offset, own)
                yield emit(prints[rows], link_runs(prints[rows], np.repeat(offset + own, own), radius))

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False).view(t) for i, t in enumerate((np.int64, np.int64, np.uint64))))
            waiting += batch.num_rows
            if waiting >= 200_000:
                yield from flush(False)
        if held:
            yield from flush(True)

    return run


def bucket_keys(prints: str, radius: int) -> Column:
    """An array of a print's buckets: for each two of radius + 2 pieces, the two pieces' bits and which they are."""
    if not 1 <= radius <= 7:
        raise ValueError("max_bits must be from 1 to 7")
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    value = col(prints)
    pieces = [F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    keys = []
    for t, (i, j) in enumerate(itertools.combinations(range(n), 2)):
        width = edges[j + 1] - edges[j]
        keys.append(F.lit(t << 44).bitwiseOR(F.shiftleft(pieces[i], width).bitwiseOR(pieces[j])))
    return F.array(*keys)


def links(prints: DataFrame, max_bits: int = 3, *, name: str = "_print", bucket: int = BUCKET) -> DataFrame:
    """A forest (a, b) of the links between different fingerprints; ``prints`` has each of them once."""
    rows = prints.select(F.explode(bucket_keys(name, max_bits)).alias("unit"), col(name).alias("print"))
    hot = rows.groupBy("unit").count().where(F.col("count") > bucket)
    hot = written(hot.select("unit", F.ceil(F.col("count") / bucket).cast("int").alias("parts")), "simhash-hot")
    rows = rows.join(F.broadcast(hot) if hot.count() * HOT_BYTES <= BROADCAST_BYTES else hot, "unit", "left")
    mine = F.pmod(F.xxhash64("print"), F.col("parts"))
    # a part meets every other part: the pair is named by the smaller and the larger of the two
    pairs = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1), lambda x: x != mine),
        lambda x: F.least(x, mine) * F.col("parts") + F.greatest(x, mine),
    )
    rows = rows.select("unit", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("part"), "print")
    rows = rows.repartition("unit", "part").sortWithinPartitions("unit", "part", "print")
    return rows.mapInArrow(bucket_links(max_bits), "a long, b long")


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links, by alternating large-star and small-star steps."""
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "simhash-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = star(both, "b > a", keep_self=False)
        edges = written(star(edges, None, keep_self=True).distinct(), "simhash-edges")
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def star(edges: DataFrame, larger: str | None, keep_self: bool) -> DataFrame:
    """Of each node, connect its neighbours to the smallest of them and itself."""
    low = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    rows = edges.withColumn("s", spread(SALTS, "b")).join(low.withColumn("s", salts(SALTS)), ["a", "s"])
    out = (rows.where(larger) if larger else rows).select(F.col("b").alias("a"), F.col("low").alias("b"))
    if keep_self:
        out = out.unionByName(low.select("a", F.col("low").alias("b")))
    return out.where("a != b")


def groups(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Of rows (_id, _print): ``_print``, ``component`` (smallest id) and ``top`` (smallest id and print) where a component has several rows."""
    order = F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_print").alias("print"))
    each = written(prints.groupBy("_print").agg(F.min(order).alias("top"), F.count("*").alias("n")), "simhash-prints")
    roots = components(links(each.select("_print"), max_bits))
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = each.join(roots, each["_print"] == roots["node"]).select("_print", "top", "root")
    best = linked.groupBy("root").agg(F.min("top").alias("best")).withColumn("s", salts(SALTS))
    linked = linked.withColumn("s", spread(SALTS, "_print")).join(best, ["root", "s"]).select("_print", F.col("best").alias("top"))
    alone = each.where("n > 1").join(linked.select("_print"), "_print", "left_anti").select("_print", "top")
    return linked.unionByName(alone)


def cluster(documents: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row a document: ``id``, fingerprint (16 hex digits), component_id."""
    prints = written(documents.select(col(id).alias("_id"), fingerprint(text, width).alias("_print")), "simhash")
    found = written(groups(prints, max_bits), "simhash-groups").withColumn("_salt", salts(SALTS))
    rows = prints.withColumn("_salt", spread(SALTS, "_id")).join(found, ["_print", "_salt"], "left")
    component = F.when(F.col("top").isNull(), F.col("_id")).otherwise(F.col("top.id"))
    return rows.select(F.col("_id").alias(id), F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), component.alias("component_id"))


def representatives(documents: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (and fingerprint, and hashes of the row).

    Fingerprints are computed once, into a narrow table in which two hashes of
    all columns stand for the row.  The rows to drop come back as such hashes:
    whole rows meet them in a join, by broadcast if the list is at most
    ``BROADCAST_BYTES``, and don't shuffle then.  Rows that are equal in all columns are one
    pair of hashes; only where such a pair stays do its rows shuffle, to
    become one.
    """
    row = F.struct("*")
    keys = F.xxhash64(row).alias("_a"), F.xxhash64(F.lit(1), row).alias("_b")
    prints = written(documents.select(col(id).alias("_id"), fingerprint(text, width).alias("_print"), *keys), "simhash")
    found = written(groups(prints.select("_id", "_print"), max_bits), "simhash-groups").withColumn("_salt", salts(SALTS))
    order = F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_print").alias("print"))
    linked = prints.withColumn("_salt", spread(SALTS, "_a")).join(found, ["_print", "_salt"])
    # of a component's first rows (same id, same print) one pair of hashes stays; all others go
    is_top = order == F.col("top")
    first = linked.where(is_top).groupBy("top").agg(F.min(F.struct("_a", "_b")).alias("kept"), F.count("*").alias("n")).withColumn("_salt", salts(SALTS))
    marked = linked.withColumn("_salt", spread(SALTS, "_b")).join(first, ["top", "_salt"]).withColumn("_stays", is_top & (F.struct("_a", "_b") == F.col("kept")))
    marks = marked.where(~F.col("_stays") | (F.col("n") > 1)).groupBy("_a", "_b").agg(F.bool_or("_stays").alias("_stays"))
    marks = written(marks, "simhash-marks")
    n, n_several = marks.agg(F.count("*"), F.count_if("_stays")).first()
    packed = documents.select(row.alias("_doc"), *keys)
    rows = packed.join(F.broadcast(marks) if n * MARK_BYTES <= BROADCAST_BYTES else marks, ["_a", "_b"], "left")
    alone = rows.where("_stays IS NULL").select("_doc.*")
    if not n_several:
        return alone
    several = rows.where("_stays").groupBy("_a", "_b").agg(F.first("_doc").alias("_doc"))
    return alone.unionByName(several.select("_doc.*"))
