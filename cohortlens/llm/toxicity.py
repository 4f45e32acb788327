"""Toxicity scores from class-conditional Kneser-Ney models of spelling.

Each word of a lower-cased text is spelled from a start mark to an end mark.
An event is a byte after its context (up to five bytes, start mark included).
The toxic and the ordinary model each hold their own counts of events; both
back off to one shared distribution, made of continuation counts pooled over
the classes, so an expression that is rare in a class gets nearly the same
likelihood from either and cannot sway a score by chance.  The difference
of the two log-likelihoods, divided by the length in words, is taken of the
whole text, of its most toxic passage (of all that start at any word) and of
its most toxic word; a logistic
curve fitted on training rows turns the three into a score.

Scale: events (at most six bytes) are packed into one long, so counting is one
hash aggregate over distinct events of the training rows, and every window of
the model groups at most 65,536 rows (the last two bytes of a key).  What is
sent to executors is the log-ratio of every event and of every context, each
found by its whole key, so none is lost to another at any size of the corpus
(some 12 bytes an event).  Above ``PART_EVENTS`` events the tables are sent in
parts, divided by context; a worker then holds one part at a time, and looks up
in it the events of some ``GROUP_BYTES`` of texts that lie there.  Events are
computed once whatever the number of parts, and scores are the same to the
bit.  Scoring reads each text once, with no shuffle; a long text goes through
in tiles, of which only a number a word stays.  Joining labels shuffles the
training texts by id.

Cases: null and empty texts have no event, so their features are 0; a null id takes part in no training;
if an id has several label rows, it is toxic if one of them says so; null
labels are ignored; without labels of both classes every score
is (next to) 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from cohortlens.llm.common import CHUNK_BYTES, chunks, col, encoded, id_text, joined, remainder, tiles, written

ORDER = 6
MARK = 0x20
DISCOUNT = 0.75
#: Words of a passage, and the words without evidence that its mean counts in besides.
PASSAGE_WORDS, PRIOR_WORDS = 32, 8
RIDGE = 1e-3
#: Events, about, of one part of the tables; texts (bytes) that go through the parts at a time if there are several.
PART_EVENTS, GROUP_BYTES = 1 << 22, 1 << 23
#: Training rows, at most, that fit the two numbers of the logistic curve (chosen by hash, so evenly).
CURVE_ROWS = 20_000

_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_LETTER[128:] = True
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def spelled(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed events of lower-case texts, where each one's byte is, and where the texts start (all joined)."""
    data, starts = joined(texts)
    letter = _LETTER[data]
    before = np.empty_like(letter)
    before[0] = False
    before[1:] = letter[:-1]
    first = np.flatnonzero(letter & ~before)
    at = np.flatnonzero(letter | before)
    if not len(at):
        return np.empty(0, np.uint64), at, starts
    symbols = np.where(letter, data, MARK).astype(np.uint64)
    since = at - first[np.searchsorted(first, at, "right") - 1]
    keys = symbols[at]
    for j in range(1, ORDER):
        earlier = np.where(since >= j, symbols[np.maximum(at - j, 0)], np.where(since == j - 1, MARK, 0).astype(np.uint64))
        keys |= earlier << np.uint64(8 * j)
    return keys, at, starts


def events(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed events of lower-case texts, the text of each event, and the words of each text."""
    keys, at, starts = spelled(texts)
    of = np.searchsorted(starts, at, "right") - 1
    return keys, of, np.bincount(of[begins(keys)], minlength=len(texts))


def begins(keys: np.ndarray) -> np.ndarray:
    """Which events are a word's first."""
    return (keys >> np.uint64(8) == MARK) & (keys & np.uint64(255) != MARK)


def event_tiles(text: bytes) -> Iterator[np.ndarray]:
    """The events of one long text, in order, each once; a tile sees as much before it as a context is long."""
    for tile, context, last in tiles(text, ORDER):
        keys, at, _ = spelled([tile])
        yield keys[(at >= context) & (at < len(tile) + last)]


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * _SPREAD) >> np.uint64(64 - bits)


def lower(values: pa.Array) -> list[bytes]:
    return encoded(pc.utf8_lower(values.cast(pa.large_string())))


def part_of(contexts: np.ndarray, n_parts: int) -> np.ndarray:
    """The part of the tables that has these contexts and the events after them."""
    return slots(contexts, 32) % np.uint64(n_parts)


@dataclass
class Table:
    """Values by key.  A key is spread one to one over 48 bits: the first ``bits`` are its slot, the rest the tag that tells it from others there."""

    starts: np.ndarray
    tags: np.ndarray
    values: np.ndarray
    bits: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        bits = max(16, len(keys).bit_length())
        slot, tag = cls.places(keys, bits)
        order = np.argsort(slot, kind="stable")
        starts = np.searchsorted(slot[order], np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        return cls(starts, tag[order], values[order].astype(np.float32), bits)

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        rest = 8 * ORDER - bits
        spread = (keys * _SPREAD) & np.uint64((1 << 8 * ORDER) - 1)
        return spread >> np.uint64(rest), (spread & np.uint64((1 << rest) - 1)).astype(np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key (NaN: it has none)."""
        slot, tag = self.places(keys, self.bits)
        at, end = self.starts[slot], self.starts[slot + np.uint64(1)]
        out = np.full(len(keys), np.nan, np.float32)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = self.tags[here] == tag[left]
            out[left[hit]] = self.values[here[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


@dataclass
class Model:
    """Log-ratios of events and contexts, in ``parts`` that were sent out; the logistic curve."""

    parts: list[Broadcast] = field(default_factory=list)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, -1e3)

    def ratios(self, keys: list[np.ndarray]) -> list[np.ndarray]:
        """Log-ratio of each event; an unseen event has that of its context.  Each part is opened once."""
        if len(self.parts) == 1:
            return [self.looked_up(x, 0) for x in keys]
        out = [np.zeros(len(x), np.float32) for x in keys]
        part = [part_of(x >> np.uint64(8), len(self.parts)) for x in keys]
        for nth in range(len(self.parts)):
            for ratio, x, own in zip(out, keys, part):
                here = np.flatnonzero(own == nth)
                ratio[here] = self.looked_up(x[here], nth)
        return out

    def looked_up(self, keys: np.ndarray, nth: int) -> np.ndarray:
        event, context = self.tables(nth)
        ratio = event.find(keys)
        unseen = np.flatnonzero(np.isnan(ratio))
        ratio[unseen] = np.nan_to_num(context.find(keys[unseen] >> np.uint64(8)))
        return ratio

    def tables(self, nth: int) -> tuple[Table, Table]:
        """The nth part; of several, only the last one used stays in memory."""
        part = self.parts[nth]
        path = getattr(part, "_path", None)
        if len(self.parts) == 1 or path is None:
            return part.value
        held = self.__dict__.get("_held")
        if not held or held[0] != nth:
            self._held = held = None
            self._held = held = (nth, part.load_from_path(path))
        return held[1]

    def features(self, values: pa.Array) -> np.ndarray:
        """Length-normalised log-ratios of each whole text, its most toxic passage and its most toxic word."""
        texts = lower(values)
        out = np.zeros((len(texts), 3))
        group: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def done() -> None:
            for (a, b, keys, of, words), ratio in zip(group, self.ratios([x[2] for x in group])):
                first = np.flatnonzero(begins(keys))
                word = np.add.reduceat(ratio.astype(float), first) if len(first) else np.empty(0)
                out[a:b] = measures(word, of[first], words)

        for a, b in chunks(texts):
            if len(texts[a]) > CHUNK_BYTES:
                word = self.long_words(texts[a])
                out[a] = measures(word, np.zeros(len(word), np.int64), np.array([len(word)]))[0]
                continue
            group.append((a, b, *events(texts[a:b])))
            size += sum(map(len, texts[a:b]))
            if len(self.parts) == 1 or size >= GROUP_BYTES:
                done()
                group, size = [], 0
        done()
        return out

    def long_words(self, text: bytes) -> np.ndarray:
        """Log-ratio of each word of one long text."""
        out: list[np.ndarray] = []
        going, some = 0.0, False  # the word that the last tile left open
        held: list[np.ndarray] = []

        def done() -> None:
            nonlocal going, some
            for keys, ratio in zip(held, self.ratios(held)):
                first, ratio = np.flatnonzero(begins(keys)), ratio.astype(float)
                if not len(first):
                    going += ratio.sum()
                    continue
                sums = np.add.reduceat(ratio, first)
                out.append(np.r_[[going + ratio[: first[0]].sum()] if some else [], sums[:-1]])
                going, some = sums[-1], True

        for keys in event_tiles(text):
            held.append(keys)
            if len(self.parts) == 1 or len(held) * CHUNK_BYTES >= GROUP_BYTES:
                done()
                held = []
        done()
        return np.concatenate([*out, [going] if some else []])

    def features_of(self, batches: Iterator[pa.Array]) -> Iterator[np.ndarray]:
        """Features of each batch; several parts are read once for about ``GROUP_BYTES`` of texts."""
        held: list[pa.Array] = []
        for batch in batches:
            held.append(batch)
            if len(self.parts) <= 1 or sum(x.nbytes for x in held) >= GROUP_BYTES:
                yield from self.grouped(held)
                held = []
        if held:
            yield from self.grouped(held)

    def grouped(self, held: list[pa.Array]) -> Iterator[np.ndarray]:
        found = self.features(pa.chunked_array(held).combine_chunks() if len(held) > 1 else held[0])
        yield from np.split(found, np.cumsum([len(x) for x in held])[:-1])

    def scores(self, features: np.ndarray) -> np.ndarray:
        *w, shift = self.weights
        return 1 / (1 + np.exp(-np.clip(features @ np.array(w) + shift, -700, 700)))


def measures(word: np.ndarray, of: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Log-ratio a word of each text, of its most toxic passage and of its most toxic word (0 without words)."""
    out = np.zeros((len(words), 3))
    some, ends = words > 0, np.cumsum(words)
    if not len(word):
        return out
    # a passage starts at every word and ends PASSAGE_WORDS later or with its text
    first = np.arange(len(word))
    stop = np.minimum(first + PASSAGE_WORDS, ends[of])
    running = np.concatenate([[0.0], np.cumsum(word)])
    passage = (running[stop] - running[:-1]) / (stop - first + PRIOR_WORDS)
    starts = (ends - words)[some]
    out[:, 0] = np.bincount(of, word, len(words)) / np.maximum(words, 1)
    out[some, 1], out[some, 2] = np.maximum.reduceat(passage, starts), np.maximum.reduceat(word, starts)
    return out


def count_events(training: DataFrame, text: str, label: str) -> DataFrame:
    """Distinct events of the training rows: key, and how often each class has it (n0, n1)."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n0", T.LongType()), T.StructField("n1", T.LongType())])
    arrow = pa.schema([("key", pa.int64()), ("n0", pa.int64()), ("n1", pa.int64())])

    def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        keys, index = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.concatenate([n for _, n in parts])
        return [(keys, np.stack([np.bincount(index, counts[:, y], len(keys)) for y in (0, 1)], axis=1))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts, labels = lower(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in chunks(texts):
                if len(texts[a]) > CHUNK_BYTES:
                    passes = ((keys, np.full(len(keys), labels[a] == 1)) for keys in event_tiles(texts[a]))
                else:
                    keys, of, _ = events(texts[a:b])
                    passes = [(keys, labels[a:b][of] == 1)]
                for keys, toxic in passes:
                    found, index = np.unique(keys, return_inverse=True)
                    parts.append((found, np.stack([np.bincount(index[toxic == y], minlength=len(found)) for y in (False, True)], axis=1)))
                    if len(parts) >= 16:
                        parts = merge(parts)
        if parts:
            keys, counts = merge(parts)[0]
            for i in range(0, len(keys), 100_000):
                n = counts[i : i + 100_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000].astype(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], schema=arrow)

    rows = training.select(col(text).alias("text"), col(label).cast("int").alias("y")).mapInArrow(count, schema)
    return rows.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def log_ratios(counted: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """Of each event: key, n, its log-ratio, and the log-ratio of an unseen byte after its context."""
    mask = (1 << 8 * (ORDER - 1)) - 1
    full = F.shiftrightunsigned(F.col("key"), 8 * (ORDER - 1)) > 0
    # the shared distribution: a context one byte shorter, and how many different longer events end so
    shorter = F.when(full, F.col("key").bitwiseAND(F.lit(mask))).otherwise(F.col("key").bitwiseAND(F.lit((1 << 8 * (ORDER - 2)) - 1)))
    df = counted.withColumn("context", F.shiftrightunsigned("key", 8)).withColumn("short", shorter)
    by_context, by_short = Window.partitionBy("context"), Window.partitionBy("short")
    df = df.withColumn("follows", F.count("*").over(by_short)).withColumn("head", F.row_number().over(by_short.orderBy("key")) == 1)
    by_tail = Window.partitionBy(F.shiftrightunsigned("short", 8))
    df = df.withColumn("tail", F.count("*").over(by_tail)).withColumn("kinds", F.sum(F.col("head").cast("int")).over(by_tail))
    held = F.least(F.lit(discount), F.col("follows"))
    shared = (F.col("follows") - held) / F.col("tail") + F.lit(discount) * F.col("kinds") / F.col("tail") / 256
    df = df.withColumn("shared", shared)
    for y in ("0", "1"):
        n, total = F.col("n" + y), F.sum("n" + y).over(by_context)
        kinds = F.sum((F.col("n" + y) > 0).cast("int")).over(by_context)
        left = F.when(total > 0, F.lit(discount) * kinds / total).otherwise(F.lit(1.0))
        own = F.when(total > 0, F.greatest(n - F.lit(discount), F.lit(0.0)) / total).otherwise(F.lit(0.0))
        df = df.withColumn("left" + y, left).withColumn("p" + y, own + F.col("left" + y) * F.col("shared"))
    return df.select(
        "key",
        "context",
        (F.col("n0") + F.col("n1")).alias("n"),
        (F.log("p1") - F.log("p0")).alias("event"),
        (F.log("left1") - F.log("left0")).alias("unseen"),
    )


def fit(
    training: DataFrame, *, n_rows: int, id: str = "doc_id", text: str = "text", label: str = "toxic", part_events: int = PART_EVENTS, curve_rows: int = CURVE_ROWS
) -> Model:
    """Count the events of all training rows; fit the curve on about ``curve_rows`` of the ``n_rows`` rows, picked by hash of the id."""
    counted = written(count_events(training, text, label), "toxicity-events")
    n_parts = max(1, -(-counted.count() // part_events))

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = part_of(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint64), n_parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *batch.columns], names=["part", "key", "context", "event", "unseen"])

    ratios = log_ratios(counted).select("key", "context", F.col("event").cast("float"), F.col("unseen").cast("float"))
    ratios = written(ratios.mapInArrow(divide, "part int, key long, context long, event float, unseen float"), "toxicity-ratios")

    def table(rows: DataFrame) -> Table:
        found = rows.toPandas()
        return Table.of(found.iloc[:, 0].to_numpy(np.uint64), found.iloc[:, 1].to_numpy(np.float32))

    model = Model()
    for nth in range(n_parts):
        own = ratios.where(F.col("part") == nth)
        tables = table(own.select("key", "event")), table(own.groupBy("context").agg(F.first("unseen")))
        model.parts.append(training.sparkSession.sparkContext.broadcast(tables))
    part = min(1.0, curve_rows / max(n_rows, 1))
    model.weights = curve(model, training.where(F.pmod(F.xxhash64(id_text(id)), F.lit(1 << 20)) < F.lit(int(part * (1 << 20)))), text, label)
    return model


def curve(model: Model, training: DataFrame, text: str, label: str) -> tuple[float, ...]:
    """Newton steps of a logistic regression of the label on the features."""

    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: list[pa.Array] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                labels.append(batch.column(1))
                yield batch.column(0)

        for x in model.features_of(texts()):
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T), labels.pop(0)], names=["a", "b", "c", "y"])

    found = training.select(col(text).alias("text"), col(label).cast("int").alias("y")).mapInArrow(feature, "a double, b double, c double, y int").toPandas()
    y = found.pop("y").to_numpy(float)
    if not 0 < y.sum() < len(y):
        return Model.weights
    design = np.column_stack([found.to_numpy(float), np.ones(len(y))])
    scale = np.maximum(np.abs(design).max(axis=0), 1e-9)
    design, w = design / scale, np.zeros(4)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + RIDGE * np.eye(4), design.T @ (y - p) - RIDGE * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(x) for x in w / scale)


def score(documents: DataFrame, model: Model, *, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns, with the score (0 to 1) in a column ``name`` (in place of one of that name)."""

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in model.features_of(pa.Array.from_pandas(values, type=pa.string()) for values in batches):
            yield pd.Series(model.scores(x))

    return documents.withColumn(name, toxic(col(text)))


def labelled(documents: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5) -> DataFrame:
    """Training rows (id, text, label): those with a label whose remainder isn't 0."""
    marks = labels.where(col(label).isNotNull() & col(id).isNotNull()).groupBy(col(id).alias("id")).agg((F.max(col(label)) > 0).cast("int").alias("y"))
    rows = documents.where(remainder(id, folds) != 0).select(col(id).alias("id"), col(text).alias("x"))
    # one plan at every size: the texts shuffle by id, unsorted, to meet their labels
    return rows.join(marks.hint("shuffle_hash"), "id").select(F.col("id").alias(id), F.col("x").alias(text), F.col("y").alias(label))


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of the contract, from the labelled rows of ``documents`` outside the held-out fold."""
    return fit(labelled(documents, labels), n_rows=labels.count())
