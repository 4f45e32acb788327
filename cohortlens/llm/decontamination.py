"""Benchmark decontamination: a broadcast hash set of test n-grams, met by every window of training words.

Words are runs of digits, lower-cased letters A-Z and characters beyond ASCII.
A benchmark item gives its windows of ``WINDOW`` words, or one window of all
its words if it has fewer; equal windows become one row with the items that
have it.  Every window of a document's words is hashed and meets the hash set;
a hit counts only if the words themselves are equal.  Hits become spans of
words, which ``decontaminate`` cuts out of the texts, or drops the documents of.

Scale: DataFrame functions only.  Documents are read once; a document's
windows are hashed within its task, and only its hits (and one row for itself)
shuffle, by row number, so a passage that a third of all documents have is
spread like the documents.  The hash set goes to executors only if its
measured size is at most ``broadcast_bytes``.  Of a larger one they get a
bitmap of ``FILTER_BITS``; the windows whose bit is set shuffle with their
words to meet the set, and AQE splits hot ones.  Results are the same.  The
driver holds one row: the size, and the lengths of windows (ten at most).  A
task holds the words of one document at a time (some 100 bytes a word).

Cases: a null or empty text has no words and no hit; an item without words has
no window; a null item id counts as an item named by the empty text; rows of
documents that repeat stay rows of their own; an empty benchmark hits nothing;
an empty table gives an empty result; columns of documents that have the name
of a result give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import col, written
from cohortlens.operators.joins import split_hot_keys

WINDOW = 10
#: The hash set is broadcast up to this size (words, item ids and about 64 bytes a row).
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, in lower-cased texts and in texts as they are.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LETTER, _OTHER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Bits of the map that stands for a larger set (4 MB).
FILTER_BITS = 1 << 25
#: Keys, from 0, by which documents themselves get through the join with the hash set.
_SELF = 64


def words(text: str) -> Column:
    """The words of a text column, lower-cased A-Z."""
    lowered = F.translate(F.coalesce(col(text), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def starts(own: Column, n: int) -> Column:
    """Where the windows of ``n`` words start, from 1; the document itself (``n`` is 0) starts at 0."""
    if not n:
        return F.array(F.lit(0))
    return F.when(F.size(own) >= n, F.sequence(F.lit(1), F.size(own) - (n - 1))).otherwise(F.array().cast("array<int>"))


def test_windows(benchmark: DataFrame, *, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The different windows of all items: hash, n, window (its words), items (ids as text)."""
    rows = benchmark.select(F.coalesce(col(id).cast("string"), F.lit("")).alias("item"), words(text).alias("own")).where(F.size("own") > 0)
    rows = rows.withColumn("n", F.least(F.size("own"), F.lit(window)))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("own") - F.col("n") + 1)))
    rows = rows.select("item", "n", F.slice("own", F.col("at"), F.col("n")).alias("window"))
    rows = rows.groupBy("window", "n").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.select(F.xxhash64("window").alias("hash"), "n", "window", "items")


def mark(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows, with the columns ``keep`` (default: all) and n_words, n_hit, spans, items.

    ``spans`` are the hit words as disjoint (start, end) from word 1, ends
    exclusive; ``items`` are the ids (as text, sorted) of items with a window
    that occurs.
    """
    keep = [c for c in (documents.columns if keep is None else keep) if c not in ("n_words", "n_hit", "spans", "items")]
    tests = written(test_windows(benchmark, id=item, text=item_text, window=window), "test-windows")
    held = F.sum(ROW_BYTES + F.octet_length(F.concat_ws(" ", "window")) + F.octet_length(F.concat_ws(" ", "items")))
    lengths, size = tests.agg(F.sort_array(F.collect_set("n")), F.coalesce(held, F.lit(0))).first()
    itself = documents.sparkSession.range(_SELF).select(F.col("id").alias("hash"), F.lit(0).alias("n"), F.array(F.lit("")).alias("window"), F.array(F.lit("")).alias("items"))
    tests = tests.unionByName(itself)

    own, at, of = F.col("_words"), F.col("at"), F.col("of")
    scanned = documents.select(F.struct(*[col(c).alias(c) for c in keep]).alias("_doc"), F.monotonically_increasing_id().alias("_row"), words(text).alias("_words"))
    # starts are exploded, not hashes: a window is then cut and hashed in generated code
    by_length = F.array(*[F.struct(F.lit(n).alias("of"), starts(own, n).alias("all")) for n in (0, *lengths)])
    scanned = scanned.withColumn("_starts", F.explode(by_length))
    scanned = scanned.select("_doc", "_row", "_words", F.col("_starts.of").alias("of"), F.explode("_starts.all").alias("at"))
    is_self, found = at == 0, F.slice(own, F.greatest(at, F.lit(1)), of)
    scanned = scanned.select(
        "_row", "at", "of",
        F.when(is_self, F.col("_doc")).alias("_doc"),
        F.when(is_self, F.size(own).cast("long")).alias("n_words"),
        found.alias("found"),
        F.when(is_self, F.pmod("_row", F.lit(_SELF))).otherwise(F.xxhash64(found)).alias("hash"),
    )
    if size <= broadcast_bytes:
        hits = scanned.join(F.broadcast(tests), "hash")
    else:
        hits = split_hot_keys(scanned.where(maybe("hash", tests))).join(tests, "hash")
    hits = hits.where((F.col("n") == of) & (is_self | (F.col("found") == F.col("window"))))

    start = at.cast("long")
    hits = hits.select(
        "_row",
        "_doc",
        "n_words",
        F.when(~is_self, F.struct(start.alias("start"), (start + F.col("n")).alias("end"))).alias("span"),
        F.when(~is_self, F.col("items")).alias("items"),
    )
    rows = hits.groupBy("_row").agg(
        F.first("_doc", ignorenulls=True).alias("_doc"),
        F.max("n_words").alias("n_words"),
        merged(F.array_sort(F.collect_list("span"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rows.select(*[F.col("_doc").getField(c).alias(c) for c in keep], "n_words", n_hit.alias("n_hit"), "spans", "items")


def maybe(hash: str, tests: DataFrame) -> Column:
    """False only for a hash that ``tests`` lack: its bit, in a map that tasks get as the value of a subquery."""

    def place(hash: Column) -> Column:
        return F.pmod(hash, F.lit(FILTER_BITS))

    numbers = tests.select(place(F.col("hash")).alias("bit")).select(F.shiftright("bit", 6).alias("number"), F.expr("1L << cast(bit & 63 AS int)").alias("bits"))
    numbers = numbers.groupBy("number").agg(F.bit_or("bits").alias("bits"))
    every = tests.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "number").join(numbers, "number", "left")
    in_order = F.array_sort(F.collect_list(F.struct("number", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    bitmap = every.agg(F.transform(in_order, lambda x: x["bits"]).alias("map")).scalar()
    at = place(col(hash))
    return F.getbit(F.get(bitmap, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def merged(spans: Column) -> Column:
    """Sorted spans without overlaps: those that touch become one."""
    span = "struct<start:bigint,end:bigint>"
    begun = F.struct(F.array().cast(f"array<{span}>").alias("done"), F.lit(None).cast(span).alias("last"))

    def add(held: Column, x: Column) -> Column:
        done, last = held["done"], held["last"]
        joins = last.isNotNull() & (x["start"] <= last["end"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        closed = F.when(last.isNull() | joins, done).otherwise(F.concat(done, F.array(last)))
        return F.struct(closed.alias("done"), F.when(joins, longer).otherwise(x).alias("last"))

    return F.aggregate(spans, begun, add, lambda held: F.when(held["last"].isNull(), held["done"]).otherwise(F.concat(held["done"], F.array(held["last"]))))


def without(text: str, spans: str) -> Column:
    """A text without the words of these spans and what separates them from the next word."""
    parts = F.regexp_extract_all(col(text), F.lit(f"{_LETTER}+{_OTHER}*"), F.lit(0))
    kept = F.filter(parts, lambda _, i: ~F.exists(spans, lambda x: (i + 1 >= x["start"]) & (i + 1 < x["end"])))
    whole = F.concat(F.regexp_extract(col(text), f"^{_OTHER}*", 0), F.array_join(kept, ""))
    return F.when(F.size(spans) > 0, whole).otherwise(col(text))


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, remove: str = "spans", text: str = "text", **options) -> DataFrame:
    """``documents`` without the hit words (``remove="spans"``), or without the rows that have any (``"documents"``)."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    packed = documents.select(F.struct("*").alias("_doc"), col(text).alias("_text"))
    marked = mark(packed, benchmark, text="_text", **options)
    if remove == "documents":
        return marked.where("n_hit = 0").select("_doc.*")
    cut = without("_text", "spans")
    return marked.select(*[cut.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in documents.columns])
