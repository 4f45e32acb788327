"""Packing documents into sequences of fixed length: best fit, then swaps.

A document longer than a sequence is cut into full pieces, the first of which
may be shorter.  Pieces are dealt into shards of about ``SHARD_PIECES`` by
row, so no shard is large whatever repeats.  Within a shard the longest piece
goes first, into the sequence that it fills best.  Then the local search lets
underfull sequences, emptiest first, hand pieces on to fuller ones that have
room: by a move, by an exchange of one for one, of one for two or of two for
one.  Every step makes a fuller sequence fuller, so the sum of squared fills
grows, until no underfull sequence of the shard has a step or there are as few
sequences as the tokens need.  Then the sequences that shards leave underfull
are dealt into groups of about as many pieces, and searched once more.

Scale: texts become rows of five numbers before anything shuffles; full pieces
never shuffle.  A shard is one bounded group, and so is a group of leftovers;
each is searched in a task of its own (above ``TASKS`` they share evenly).

Cases: null and empty texts are their end id alone; null ids and repeated rows
are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import chunks, col, encoded, spread, written
from cohortlens.llm.tokens import ENCODE_CHARS, encoder

CAPACITY = 1024
SHARD_PIECES = 8192
#: Tasks that the shards are dealt to, by number: one shard each, up to so many.
TASKS = 10_000
#: How many times for each piece the search may look at another sequence (None: until no step is left).
PROBES: int | None = None


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Full pieces, after a shorter first one if they don't come out even."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


def tokenize(
    documents: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", end: int = 2, capacity: int = CAPACITY, keep_ids: bool = False, remembered: int | None = None
) -> DataFrame:
    """A row for each piece: ``id``, piece, start, length, ids_crc32 and, if wanted, ids (little-endian unsigned 32-bit).

    Workers keep one encoder, with a large memory of words, from task to task;
    with ``remembered``, a memory of about so many words (for workers that
    serve other stages, too).
    """
    source = documents.select(col(id).alias(id), col(text).alias("_text"))
    schema = f"`{id}` {source.schema[0].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary, remembered)
        for batch in batches:
            texts = encoded(batch.column(1))
            for a, b in chunks(texts, ENCODE_CHARS // 4 if remembered else ENCODE_CHARS):
                rows, out = [], []
                for i, ids in enumerate(own.encode(texts[a:b]), a):
                    ids += last
                    start = 0
                    for nth, n in enumerate(piece_lengths(len(ids) // 4, capacity)):
                        data = ids[4 * start : 4 * (start + n)]
                        rows.append(i)
                        out.append((nth, start, n, zlib.crc32(data), data))
                        start += n
                columns = list(zip(*out))
                arrays = [batch.column(0).take(pa.array(rows)), pa.array(columns[0], pa.int32()), *(pa.array(x, pa.int64()) for x in columns[1:4])]
                names = [id, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays, names = [*arrays, pa.array(columns[4], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers): the longest item first, each into the bin that it fills best."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            own, room = len(bins), capacity
            bins.append([])
        bins[own].append(i)
        room -= size
        if room:
            with_room[room].append(own)
            rooms |= 1 << room
    return bins


def widened(bits: int, n: int) -> int:
    """The numbers above each of a set (as bits) by 1 to ``n``."""
    out, width = bits << 1 if n else 0, 1
    while width < n:
        step = min(width, n - width)
        out |= out << step
        width += step
    return out


class LocalSearch:
    """Hands the items of underfull bins, emptiest first, on to fuller ones, until none of them can.

    What a bin may give (an item, two items) and what it may take against
    nothing, an item or two items are sets of sizes, kept as bits, so a look at
    another bin is one or two ands.  A bin that has no step is looked at again
    only if it or a bin that it can give to has changed.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.room = {b: r for b, own in enumerate(bins) if (r := capacity - sum(lengths[i] for i in own)) > 0}
        #: Items of each underfull bin, as sorted (length, item).
        self.items = {b: sorted((lengths[i], i) for i in bins[b]) for b in self.room}
        self.bins = bins
        #: Of each underfull bin: sizes of an item, of two items, and sizes taken for at most one item, for at most two.
        self.sizes: dict[int, tuple[int, int, int, int]] = {}
        for b in self.room:
            self.measure(b)
        #: Looks at another bin that are left; the search ends with them.
        self.probes = float("inf") if PROBES is None else PROBES * len(lengths)

    def measure(self, b: int) -> None:
        one = two = 0
        for size, _ in self.items[b]:
            two |= one << size
            one |= 1 << size
        for_one = widened(one | 1, self.room[b])
        self.sizes[b] = one, two, for_one, for_one | widened(two, self.room[b])

    def able(self) -> set[int]:
        """The bins that have a step: what one may give meets what all others of no more room take."""
        out: set[int] = set()
        order = sorted(self.room, key=self.room.__getitem__)
        for bins in (order, order[::-1]):  # the second time for bins of the same room that come later
            for_one = for_two = 0
            last = -1
            for b in bins:
                if bins is not order and self.room[b] != last:
                    for_one, for_two, last = 0, 0, self.room[b]
                one, two, own_one, own_two = self.sizes[b]
                if one & for_two or two & for_one:
                    out.add(b)
                for_one, for_two = for_one | own_one, for_two | own_two
        return out

    def takers(self, donor: int) -> list[int]:
        """Bins that this one can give to."""
        one, two, *_ = self.sizes[donor]
        most, room = self.room[donor], self.room
        return [b for b, (_, _, for_one, for_two) in self.sizes.items() if (one & for_two or two & for_one) and room[b] <= most and b != donor]

    def givers(self, taker: int) -> list[int]:
        """Bins that can give to this one."""
        *_, for_one, for_two = self.sizes[taker]
        least, room = self.room[taker], self.room
        return [b for b, (one, two, _, _) in self.sizes.items() if (one & for_two or two & for_one) and room[b] >= least and b != taker]

    def run(self) -> list[list[int]]:
        total = sum(self.lengths)
        n = len(self.bins)
        waiting = self.able()
        while waiting and n * self.capacity - total >= self.capacity and self.probes > 0:
            giver = max(waiting, key=lambda b: (self.room[b], -b))
            if not self.give(giver):
                waiting.remove(giver)
                continue
            for b in self.changed:
                if self.items[b] and self.room[b]:
                    waiting.add(b)
                    waiting.update(self.givers(b))
                    continue
                n -= not self.items[b]
                self.bins[b] = [i for _, i in self.items[b]]
                waiting.discard(b)
                del self.room[b], self.items[b], self.sizes[b]
        for b, own in self.items.items():
            self.bins[b] = [i for _, i in own]
        return [b for b in self.bins if b]

    def give(self, giver: int) -> bool:
        """One step that makes a fuller bin fuller at the cost of this one, if there is any."""
        self.probes -= len(self.room)
        takers = self.takers(giver)
        return bool(takers) and (any(self.hand_on(giver, x, takers) for x in sorted(self.items[giver], reverse=True)) or self.two_for_one(giver, takers))

    def swap(self, donor: int, given: list, taker: int, taken: list) -> bool:
        moved = sum(x[0] for x in given) - sum(x[0] for x in taken)
        for a, b, xs in ((donor, taker, given), (taker, donor, taken)):
            for x in xs:
                self.items[a].remove(x)
                insort(self.items[b], x)
        self.room[taker] -= moved
        self.room[donor] += moved
        self.changed = donor, taker
        self.measure(donor)
        self.measure(taker)
        return True

    def hand_on(self, donor: int, x: tuple[int, int], takers: list[int]) -> bool:
        """Move x, or exchange it for a shorter item or two of a fuller bin, whichever fills that bin most."""
        size, best = x[0], None
        for taker in takers:
            if not self.sizes[taker][3] >> size & 1:
                continue
            room = self.room[taker]
            if size <= room:
                gain, taken = size, []
            else:
                own = self.items[taker]
                at = bisect_left(own, (size - room,))
                gain, taken = (size - own[at][0], [own[at]]) if at < len(own) else (0, [])
                if gain < room:  # two shorter items may leave less room
                    for j, first in enumerate(own[:-1]):
                        k = bisect_left(own, (size - room - first[0],), j + 1)
                        if k < len(own) and size - first[0] - own[k][0] > gain:
                            gain, taken = size - first[0] - own[k][0], [first, own[k]]
            if gain > 0 and (best is None or (not taken, gain) > (not best[2], best[0])):
                best = (gain, taker, taken)
        return best is not None and self.swap(donor, [x], best[1], best[2])

    def two_for_one(self, donor: int, takers: list[int]) -> bool:
        """Give two items for one of a fuller bin that is shorter than both together."""
        own = self.items[donor]
        for j, first in enumerate(own):
            for second in own[j + 1 :]:
                size = first[0] + second[0]
                for taker in takers:
                    if self.sizes[taker][2] >> size & 1:
                        theirs = self.items[taker]
                        at = bisect_left(theirs, (size - self.room[taker],))
                        if at < len(theirs) and theirs[at][0] < size:
                            return self.swap(donor, [first, second], taker, [theirs[at]])
        return False


def places(lengths: list[int], bins: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of each item, its place there, and what the bin holds in all."""
    of, at, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for b, own in enumerate(bins):
        offset = 0
        for i in own:
            of[i], at[i] = b, offset
            offset += lengths[i]
        fill[own] = offset
    return of, at, fill


def pack_shard(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, and its place there."""
    return places(lengths, LocalSearch(lengths, best_fit(lengths, capacity), capacity).run())[:2]


def repack(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """The search over bins that exist, or over best fit of their items if that needs fewer."""
    found = LocalSearch(lengths, bins, capacity).run()
    if len(found) * capacity - sum(lengths) >= capacity:
        found = min(found, LocalSearch(lengths, best_fit(lengths, capacity), capacity).run(), key=len)
    return found


def pack(pieces: DataFrame, *, length: str = "length", capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """All rows and columns of ``pieces`` (narrow rows), with sequence_id and offset."""
    columns = pieces.columns
    rows = written(pieces.select(F.struct("*").alias("_piece"), col(length).alias("_length"), F.monotonically_increasing_id().alias("_row")), "packing-pieces")
    part = rows.where(F.col("_length") < capacity)
    n_shards = max(1, -(-part.count() // shard_pieces))

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row", ignore_index=True)
        lengths = group["_length"].tolist()
        of, at, fill = places(lengths, LocalSearch(lengths, best_fit(lengths, capacity), capacity).run())
        return pd.DataFrame({"_row": group["_row"], "_length": group["_length"], "sequence_id": (int(key[0]) << 32) + of, "offset": at, "_fill": fill})

    def place_again(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["sequence_id", "offset"], ignore_index=True)
        lengths = group["_length"].tolist()
        bins = [x.tolist() for x in group.groupby("sequence_id").indices.values()]
        of, at, _ = places(lengths, repack(lengths, bins, capacity))
        return pd.DataFrame({"_row": group["_row"], "sequence_id": (1 << 61) + (int(key[0]) << 32) + of, "offset": at})

    full = rows.where(F.col("_length") >= capacity)
    full = full.select("_piece", (F.lit(1 << 62) + F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    dealt = part.withColumn("_shard", spread(n_shards, "_row"))
    # few bytes but long to search: tasks by the shard's number, which neither share by chance nor are made fewer
    dealt = dealt.select("_shard", "_row", "_length").repartitionById(min(n_shards, TASKS), F.col("_shard"))
    placed = dealt.groupBy("_shard").applyInPandas(place, "_row long, _length long, sequence_id long, offset long, _fill long")
    if n_shards > 1:
        placed = written(placed, "packing-placed")
        left = placed.where(F.col("_fill") < capacity)
        n_groups = max(1, -(-left.count() // shard_pieces))
        left = left.withColumn("_group", spread(n_groups, "sequence_id")).select("_group", "_row", "_length", "sequence_id", "offset")
        left = left.repartitionById(min(n_groups, TASKS), F.col("_group"))
        again = left.groupBy("_group").applyInPandas(place_again, "_row long, sequence_id long, offset long")
        placed = placed.where(F.col("_fill") >= capacity).select("_row", "sequence_id", "offset").unionByName(again)
    part = part.join(placed.select("_row", "sequence_id", "offset"), "_row").select("_piece", "sequence_id", "offset")
    return full.unionByName(part).select(*[F.col("_piece").getField(c).alias(c) for c in columns], "sequence_id", "offset")


def report(packed: DataFrame, *, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """One row: sequences, and the fewest that could hold the tokens (least)."""
    return packed.agg(F.count_distinct("sequence_id").alias("sequences"), F.ceil(F.coalesce(F.sum(col(length)), F.lit(0)) / capacity).alias("least"))


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence: sequence_id, input_ids; ``packed`` has the ids of its pieces (``keep_ids``)."""

    def join(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        data = b"".join(bytes(x) for x in pieces.sort_values("offset")["ids"])
        return pd.DataFrame({"sequence_id": [key[0]], "input_ids": [np.frombuffer(data, "<u4").astype(np.int64)]})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(join, "sequence_id long, input_ids array<long>")
