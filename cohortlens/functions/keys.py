"""Summary of an index table as one value: which keys it may have, and the span of its dates.

The keys are a bitmap: each key sets ``PROBES`` bits of a power of two, chosen
by its hash, so ids may be numbers or text.  A key whose bits are not all set
is surely not there; one that has them all set is there but for a few of a
hundred (with ten bits a key or more), and meets the real keys in the join
that follows.  The map is at most ``MAX_BYTES``, whatever the index holds: too
many keys for it make it let more through, never wrong.

The summary is a scalar subquery, computed once before the scan that uses it;
nothing reaches the driver but that value, which goes out with the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.windows import ColumnOrName, _c

#: Bits of the map: 512 kB, for about 400,000 keys; more on request.
KEY_BITS = 1 << 22
MAX_BYTES = 16 << 20
PROBES = 2
_WORD = 64


def key_bits(n_keys: int) -> int:
    """Bits for a number of keys: a power of two, ten a key at least, within ``MAX_BYTES``."""
    return max(_WORD, min(8 * MAX_BYTES, 1 << (10 * max(1, n_keys) - 1).bit_length()))


def _places(key: Column, bits: int) -> list[Column]:
    """The bits of a key: as many low bits of its hash as name one, and the next ones above."""
    hashed = F.xxhash64(key)
    return [F.shiftrightunsigned(hashed, 32 * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def summary(index: DataFrame, *, key: str = "person_id", date: ColumnOrName | None = None, bits: int = KEY_BITS) -> Column:
    """One value for a whole table: a struct of ``map`` (words of the bitmap), ``lo`` and ``hi`` (first and last date).

    Rows are reduced to words of the map before they meet (at most ``bits`` / 64
    of them); one task puts the words in order.  Without a row, no key is in
    the map and the dates are null.
    """
    if bits & (bits - 1) or not _WORD <= bits <= 8 * MAX_BYTES:
        raise ValueError(f"bits must be a power of two from {_WORD} to {8 * MAX_BYTES}")
    day = F.lit(None).cast("date") if date is None else _c(date)
    rows = index.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("bit"), day.alias("day"))
    rows = rows.select(F.shiftright("bit", 6).alias("number"), F.expr("1L << cast(bit & 63 AS int)").alias("bits"), "day")
    none = F.lit(None).cast("date")
    every = index.sparkSession.range(bits // _WORD).select(F.col("id").alias("number"), F.lit(0).cast("long").alias("bits"), none.alias("day"))
    words = rows.unionByName(every).groupBy("number").agg(F.bit_or("bits").alias("bits"), F.min("day").alias("lo"), F.max("day").alias("hi"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("number", "bits"))), lambda x: x["bits"])
    return words.agg(F.struct(in_order.alias("map"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).alias("summary")).scalar()


def may_hold(held: Column, key: ColumnOrName, bits: int = KEY_BITS) -> Column:
    """False only for keys that the summarised table lacks; false for null."""
    key = _c(key)
    words = held.getField("map")
    hit = [F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1 for at in _places(key, bits)]
    return key.isNotNull() & hit[0] & hit[1]


def may_be_near(held: Column, event_date: ColumnOrName, before: int, after: int) -> Column:
    """Exact prefilter: the event lies between the first date - ``before`` and the last + ``after`` (see ``within_span``)."""
    return _c(event_date).between(F.date_sub(held.getField("lo"), before), F.date_add(held.getField("hi"), after))
