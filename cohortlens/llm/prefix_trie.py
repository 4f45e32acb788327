"""Prefix tries of conversations in double arrays, a trie for each range of sequences.

A turn's key is a 128-bit hash of its role and text; a conversation becomes
the sequence of its turns' keys, and equal sequences become one.  Different
sequences are laid out in order, so a shard, a run of neighbours, is the part
of the trie between its first and its last sequence.  Within a shard turns get
dense ids, and the trie is packed into two arrays: the child of state s by
turn c is state BASE[s] + c, if CHECK of that state is s.  All sequences then
walk the arrays at once, turn by turn, and leave counts in the states; CHECK
leads back from children to parents for the sums over subtrees.

Only a prefix of a shard's first or last sequence can be a node of another
shard, too.  Every other node is done when its shard is.  The shared upper
nodes are merged globally: their counts add up, and what one of them is worth
goes to all above it by sums along the shards' first and last sequences.

Scale: texts don't shuffle, only keys (24 bytes a turn).  Conversations are
built in one shuffle by family (the one whose first turns are shared, and
those that share them).  Ranges hold different sequences, so neither a
conversation that a third of all rows repeat nor a first turn that a third of
all share makes a range large.  The ids that end at a node are digested as a
stream of lists of at most 2 ** ``ID_BITS`` ids.  A task holds one shard of
``SHARD_TURNS`` turns, or one conversation's keys if it is longer.  Nothing
is broadcast or sent to the driver.

Cases: turns are ordered by turn, null first, then by key, so ties give one
order; null role or text counts as empty; rows with a null conversation id
take no part; repeated rows are repeated turns; a conversation that is left
without turns is a member of the root alone; an empty table has no node, not
even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import col, salts, spread, written

KEY_BYTES = 16
#: Conversations of a family share the first turns of its first one.
FAMILY, MOST_SHARED = 5, 9
#: Bits of the ids that are listed in one row.
ID_BITS = 12
SHARD_TURNS = 1 << 15
#: Places that are looked at before children are put behind all others.
TRIES = 64
SALTS = 16
NONE = hashlib.sha256(b"").hexdigest()

_NODES = (
    "key binary, parent_key binary, path long, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string"
)
_NODES_ARROW = [pa.binary(), pa.binary(), *[pa.int64()] * 9, pa.string()]
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---- sequences


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.crc32(conv.cast("string")) % MOST_SHARED


def sequences(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Of each conversation: _conv, _seq (its turns' keys, one after the other), _sizes (UTF-8 bytes of their texts).

    One shuffle, by family: there a turn is numbered, learns which
    conversations its family has, and goes to those that take it.
    """
    role, text = (F.coalesce(col(x).cast("string"), F.lit("")) for x in (role, text))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY_BYTES)
    conv = col(id).cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("_family"), conv.alias("_own"), col(turn).alias("_turn"), key.alias("_key"), F.octet_length(text).alias("_size")
    )
    in_order = Window.partitionBy("_family", "_own").orderBy(F.asc_nulls_first("_turn"), "_key")
    turns = turns.repartition("_family").withColumn("_place", F.row_number().over(in_order)).drop("_turn")
    turns = turns.withColumn("_members", F.collect_set("_own").over(Window.partitionBy("_family")))

    own, place = F.col("_own"), F.col("_place")
    none = F.array().cast("array<struct<conv:bigint,place:int>>")
    at = lambda c, p: F.struct(c.alias("conv"), p.alias("place"))
    kept = F.when(place > shared_turns(own), F.array(at(own, place))).otherwise(none)
    is_head = (own == F.col("_family")) & (place < MOST_SHARED)
    takers = F.filter("_members", lambda c: place <= shared_turns(c))
    given = F.when(is_head, F.transform(takers, lambda c: at(c, place))).otherwise(none)
    itself = F.when(place == 1, F.array(at(own, F.lit(0)))).otherwise(none)  # so that none is lost that ends up without turns
    rows = turns.select("_family", "_key", "_size", F.explode(F.concat(kept, given, itself)).alias("_at"))
    rows = rows.select("_family", F.col("_at.conv").alias("_conv"), F.when(F.col("_at.place") > 0, F.struct(F.col("_at.place").alias("place"), "_key", "_size")).alias("_turn"))
    rows = rows.groupBy("_family", "_conv").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    return rows.select("_conv", F.unhex(F.array_join(F.transform("_turns", lambda x: x["_key"]), "")).alias("_seq"), F.transform("_turns", lambda x: x["_size"]).alias("_sizes"))


def different(rows: DataFrame) -> DataFrame:
    """Of each sequence, in one row for each range of ids that has it: _seq, _range, _n, _first, _ids (joined), _sizes."""
    in_range = F.shiftright("_conv", ID_BITS).alias("_range")
    return rows.groupBy("_seq", in_range).agg(
        F.count("*").alias("_n"),
        F.min("_conv").alias("_first"),
        F.array_join(F.transform(F.array_sort(F.collect_list("_conv")), lambda x: x.cast("string")), ",").alias("_ids"),
        F.first("_sizes").alias("_sizes"),
    )


# ---- one shard


class DoubleArray:
    """BASE and CHECK: the child of state s by id c is base[s] + c, if check of that state is s.  The root is state 0."""

    def __init__(self):
        self.base, self.check, self._next = [0], [-1], [1]

    def _free(self, at: int) -> int:
        """The first free state from ``at`` on."""
        after, n = self._next, len(self._next)
        path = []
        while at < n and after[at] != at:
            path.append(at)
            at = after[at]
        for x in path:
            after[x] = at
        return at

    def add(self, state: int, ids: list[int]) -> int:
        """Place the children of a state (sorted ids); returns its base."""
        first, tries = ids[0], 0
        at = self._free(max(first, 1))
        while any(at - first + c < len(self.check) and self.check[at - first + c] != -2 for c in ids[1:]):
            tries += 1
            at = self._free(at + 1) if tries < TRIES else max(len(self.check), first)
        base = at - first
        self.base[state] = base
        more = base + ids[-1] + 1 - len(self.check)
        if more > 0:
            self._next.extend(range(len(self.check), len(self.check) + more))
            self.check.extend([-2] * more)
            self.base.extend([0] * more)
        for c in ids:
            self.check[base + c] = state
            self._next[base + c] = base + c + 1
        return base

    @classmethod
    def of(cls, rows: list[list[int]]) -> DoubleArray:
        """The trie of different sequences of ids in order."""
        out = cls()
        waiting = [(0, len(rows), 0, 0)]  # rows from, to: at this state after so many ids
        while waiting:
            lo, hi, depth, state = waiting.pop()
            if lo < hi and len(rows[lo]) == depth:
                lo += 1
            if lo == hi:
                continue
            if hi - lo == 1:
                for c in rows[lo][depth:]:
                    state = out.add(state, [c]) + c
                continue
            ids, cuts = [], []
            for i in range(lo, hi):
                if not ids or rows[i][depth] != ids[-1]:
                    ids.append(rows[i][depth])
                    cuts.append(i)
            base = out.add(state, ids)
            waiting += [(a, b, depth + 1, base + c) for c, a, b in zip(ids, cuts, [*cuts[1:], hi])]
        return out


class Shard:
    """The nodes of a run of sequences: (keys, ids' count, smallest id, digest of the ids, sizes of the turns), in order."""

    def __init__(self, rows: list[tuple[bytes, int, int, str, list[int]]], number: int):
        self.number, self.rows = number, rows
        cut = [[seq[i : i + KEY_BYTES] for i in range(0, len(seq), KEY_BYTES)] for seq, *_ in rows]
        dense = {key: i for i, key in enumerate(sorted({x for keys in cut for x in keys}))}  # as they are ordered
        self.ids = [[dense[x] for x in keys] for keys in cut]
        self.trie = DoubleArray.of(self.ids)
        self.walk()
        self.sum_up()

    def walk(self) -> None:
        """All sequences walk the arrays, turn by turn, and count in every state they pass."""
        base, check = np.array(self.trie.base), np.array(self.trie.check)
        n = np.fromiter((r[1] for r in self.rows), np.int64, len(self.rows))
        first = np.fromiter((r[2] for r in self.rows), np.int64, len(self.rows))
        lengths = np.fromiter(map(len, self.ids), np.int64, len(self.ids))
        starts = np.cumsum(lengths) - lengths
        flat = np.fromiter((c for x in self.ids for c in x), np.int64, int(lengths.sum()))
        sizes = np.fromiter((s for r in self.rows for s in r[4]), np.int64, len(flat))
        self.n, self.first = np.zeros(len(check), np.int64), np.full(len(check), np.iinfo(np.int64).max)
        self.depth, self.size = np.full(len(check), -1), np.zeros(len(check), np.int64)
        self.ends: dict[int, str] = {}
        at, state, depth = np.arange(len(lengths)), np.zeros(len(lengths), np.int64), 0
        self.levels: list[np.ndarray] = []
        while len(at):
            np.add.at(self.n, state, n[at])
            np.minimum.at(self.first, state, first[at])
            self.depth[state] = depth
            self.levels.append(state[np.r_[True, state[1:] != state[:-1]]])  # equal states are neighbours
            done = lengths[at] == depth
            self.ends.update((int(s), self.rows[i][3]) for s, i in zip(state[done], at[done]))
            at, state = at[~done], state[~done]
            flat_at = starts[at] + depth
            there = base[state] + flat[flat_at]
            if not (check[there] == state).all():
                raise AssertionError("a sequence left the trie")
            self.size[there] = sizes[flat_at]
            state, depth = there, depth + 1
        self.check = check

    def path(self, ids: list[int]) -> list[int]:
        states = [0]
        for c in ids:
            states.append(self.trie.base[states[-1]] + c)
        return states

    def sum_up(self) -> None:
        """Children, leaves and saved bytes: of nodes that no other shard has, whole; of the others, what such nodes below add."""
        nodes = np.concatenate(self.levels)
        self.first_path, self.last_path = self.path(self.ids[0]), self.path(self.ids[-1])
        self.is_open = np.zeros(len(self.check), bool)
        self.is_open[self.first_path + self.last_path] = True
        own = nodes[~self.is_open[nodes]]
        self.children, self.leaves, self.saved = (np.zeros(len(self.check), np.int64) for _ in range(3))
        np.add.at(self.children, self.check[own], 1)
        self.leaves[own] = self.children[own] == 0
        self.saved[own] = (self.n[own] - 1) * self.size[own]
        for level in self.levels[:0:-1]:
            np.add.at(self.leaves, self.check[level], self.leaves[level])
            np.add.at(self.saved, self.check[level], self.saved[level])

    def keys(self, seq: bytes) -> list[bytes]:
        """A key for each prefix of a sequence, the empty one first."""
        digest = hashlib.sha256()
        out = [digest.digest()[:KEY_BYTES]]
        for i in range(0, len(seq), KEY_BYTES):
            digest.update(seq[i : i + KEY_BYTES])
            out.append(digest.copy().digest()[:KEY_BYTES])
        return out

    def table(self) -> pa.RecordBatch:
        """The shard's rows of ``_NODES``: done nodes have no key; a shared one is on the first or last path, and counts on one of them."""
        out: list[tuple] = []
        names: dict[int, bytes] = {}
        for which, (states, row) in enumerate(((self.first_path, self.rows[0]), (self.last_path, self.rows[-1]))):
            keys, parent = self.keys(row[0]), None
            for s, key in zip(states, keys):
                found = (int(self.first[s]), None, int(self.n[s]), int(self.children[s]), int(self.leaves[s]), int(self.saved[s]), int(self.size[s]), self.ends.get(s))
                found = (None, None, 0, 0, 0, 0, int(self.size[s]), None) if s in names else found
                out.append((key, parent, 2 * self.number + which, int(self.depth[s]), *found))
                parent = key
            names.update(zip(states, keys))
        shared = [pa.array(x, t) for x, t in zip(zip(*out), _NODES_ARROW)]
        nodes = np.concatenate(self.levels)
        nodes = nodes[~self.is_open[nodes]]
        above = self.check[nodes]
        below_shared = self.is_open[above]
        done = [
            pa.nulls(len(nodes), pa.binary()),
            pa.array([names[s] if o else None for s, o in zip(above.tolist(), below_shared.tolist())], pa.binary()),
            pa.nulls(len(nodes), pa.int64()),
            pa.array(self.depth[nodes]),
            pa.array(self.first[nodes]),
            pa.array(self.first[above], mask=below_shared),
            *(pa.array(x[nodes]) for x in (self.n, self.children, self.leaves, self.saved, self.size)),
            pa.array([self.ends.get(s, NONE) for s in nodes.tolist()], pa.string()),
        ]
        names_of = [x.split()[0] for x in _NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(shared, done)], names=names_of)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int, str, list[int]]]:
    """Rows of ``different``, sorted by (_seq, _range), as one for each sequence; its ids are digested as they pass."""
    seq = None
    for batch in batches:
        for own, n, first, ids, sizes in zip(*(x.to_pylist() for x in batch.columns)):
            if own != seq:
                if seq is not None:
                    yield seq, count, least, digest.hexdigest(), held
                seq, count, least, held, digest = own, 0, first, sizes, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
            count += n
    if seq is not None:
        yield seq, count, least, digest.hexdigest(), held


def shards(shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows, turns = [], 0
        for row in gathered(batches):
            if rows and turns + len(row[4]) > shard_turns:
                yield Shard(rows, number).table()
                rows, turns, number = [], 0, number + 1
            rows.append(row)
            turns += len(row[4]) + 1
        if rows:
            yield Shard(rows, number).table()

    return run


# ---- the whole


def merged(shared: DataFrame) -> DataFrame:
    """One row for each shared node: key, parent_key and its numbers over all shards and below."""
    total = shared.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"),
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("size").alias("size"),
        F.coalesce(F.max("ends_sha256"), F.lit(NONE)).alias("ends_sha256"),
        F.min("path").alias("home"),
    )
    total = written(total, "trie-shared")
    kids = total.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    total = total.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    worth = total.select(
        "key", "home", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("own")
    ).withColumn("_salt", salts(SALTS))
    # a node is worth something on one of its paths; a path gives each of its nodes what is at or below it
    rows = shared.select("path", "depth", "key", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("_salt")).join(worth, ["key", "_salt"])
    at_home, below = F.col("home") == F.col("path"), Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("key", *[F.sum(F.when(at_home, F.col(x)).otherwise(F.lit(0))).over(below).alias(x) for x in ("leaf", "own")])
    added = rows.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    total = total.join(added, "key")
    return written(total.withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("own")}), "trie-merged")


def trie(conversations: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = written(different(sequences(conversations, id=id, turn=turn, role=role, text=text)), "trie-sequences")
    rows = rows.select("_seq", "_range", "_n", "_first", "_ids", "_sizes").repartitionByRange("_seq").sortWithinPartitions("_seq", "_range")
    nodes = written(rows.drop("_range").mapInArrow(shards(shard_turns), _NODES), "trie-nodes")
    shared = merged(nodes.where("key IS NOT NULL").drop("parent_conv_id"))
    names = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above")).withColumn("_salt", salts(SALTS))
    done = nodes.where("key IS NULL")
    inside = done.where("parent_key IS NULL").select(*RESULT)
    below = done.where("parent_key IS NOT NULL").drop("parent_conv_id").select("parent_key", *[x for x in RESULT if x != "parent_conv_id"])
    below = below.unionByName(shared.select("parent_key", *[x for x in RESULT if x != "parent_conv_id"]))
    below = below.withColumn("_salt", spread(SALTS, "conv_id", "depth")).join(names, ["parent_key", "_salt"], "left")
    return inside.unionByName(below.withColumn("parent_conv_id", F.col("_above")).select(*RESULT))
