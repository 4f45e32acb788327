"""Language identification with error-correcting output codes.

Each language has a codeword.  For each bit of the code a binary classifier
over byte n-grams predicts whether a text's language has that bit: its weight
of an n-gram is the log-ratio of the n-gram's likelihoods in the languages
with and without the bit, and its margin is the mean weight over the text,
scaled by the square root of the text's length.  Decoding adds, for each
codeword, the logistic losses of the margins against its bits, weighted by how
reliable each bit was on training rows, and chooses the smallest.  If the
second smallest is close, the text is flagged as ambiguous.

Scale: n-grams are counted over all training rows, first within a task and
then in one aggregate of at most 2 ** ``SLOT_BITS`` rows a language.  What is
sent to executors is a weight for each slot and bit, whatever the corpus.
Only the bits' reliabilities use a sample of training rows, of about
``SAMPLE_ROWS``, chosen by hash.  Prediction reads each text once, no shuffle;
a text's answer depends on it alone, and a long one goes through in tiles.
N-grams share 2 ** ``SLOT_BITS`` slots at any size of the corpus.

Cases: a null text, and a text without a letter, are ``und`` with score 0;
rows with a null language train nothing; a null id counts as the empty text
in the folds; with one language learned, every other text is that language;
with none, every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import CHUNK_BYTES, chunks, col, encoded, id_text, joined, remainder, tiles

SLOT_BITS = 15
GRAM = 4
SAMPLE_ROWS = 4_000
SMOOTHING = 0.5
#: A text is ambiguous if its best language has less than this share of the decoding's weight.
CLEAR = 0.75
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz'")] = True
_LETTER[128:] = True


def grams(texts: list[bytes], bits: int = SLOT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each n-gram of lower-case texts (other bytes are spaces), and the text of each."""
    keys, at, starts = keyed(texts, bits)
    of = np.searchsorted(starts, at, "right") - 1
    inside = at - starts[of] >= GRAM - 2  # not across texts, but for the space before each
    return keys[inside], of[inside]


def keyed(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slot of the n-gram that ends at each letter or after a word, where it ends, and where the texts start."""
    data, starts = joined([b"", *texts])  # a space before the first text, as before all others
    letter = _LETTER[data]
    symbols = np.where(letter, data, 0x20).astype(np.uint32)
    key = symbols.copy()
    for j in range(1, GRAM):
        key[j:] |= symbols[:-j] << np.uint32(8 * j)
    at = np.flatnonzero(letter | np.r_[False, letter[:-1]])
    return ((key[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64), at, starts[1:]


def passes(texts: list[bytes], bits: int = SLOT_BITS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slots of texts from, to, and the text (from 0) of each; the n-grams of a long text come in several passes."""
    for a, b in chunks(texts):
        if len(texts[a]) <= CHUNK_BYTES:
            slots, of = grams(texts[a:b], bits)
            yield a, b, slots, of
            continue
        for tile, context, last in tiles(texts[a], GRAM):
            keys, at, starts = keyed([tile], bits)
            place = at - starts[0]
            own = (place >= max(context, 0 if context else GRAM - 2)) & (place < len(tile) + last)
            yield a, b, keys[own], np.zeros(int(own.sum()), np.int64)


def codewords(n: int, seed: int = 42) -> np.ndarray:
    """A codeword (a row of 0 and 1) for each of ``n`` languages; rows far apart, columns different."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 5:  # the exhaustive code: every way to part the languages, the first always with 1
        columns = [[1] + [(c >> i) & 1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(seed)
    length, best, distance = math.ceil(10 * math.log2(n)), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n, length), dtype=np.int8)
        if (code.min(axis=0) == code.max(axis=0)).any():
            continue
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(n, dtype=int) * length
        if apart.min() > distance:
            best, distance = code, int(apart.min())
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # slots x bits
    reliability: np.ndarray = field(default_factory=lambda: np.ones(1))

    def margins(self, values: pa.Array) -> np.ndarray:
        texts = encoded(pc.utf8_lower(values.cast(pa.large_string())))
        out, n = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts))
        for a, b, slots, of in passes(texts):
            n[a:b] += np.bincount(of, minlength=b - a)
            for bit in range(out.shape[1]):
                out[a:b, bit] += np.bincount(of, self.weights[slots, bit], b - a)
        return np.clip(out / np.sqrt(n + 1)[:, None], -30, 30)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword of each row of margins, and its share of the weight of all."""
        loss = np.zeros((len(margins), len(self.languages)))
        for i, word in enumerate(self.code):
            loss[:, i] = (np.logaddexp(0, -margins * (2.0 * word - 1)) * self.reliability).sum(axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), 1 / share.sum(axis=1)

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        if self.languages:
            nearest, share = self.decode(self.margins(pa.Array.from_pandas(texts, type=pa.string())))
            names = np.array(self.languages, dtype=object)[nearest]
        else:
            names, share = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        known = np.fromiter((x is not None and any(map(str.isalpha, x)) for x in texts), bool, len(texts))
        share = np.where(known, share, 0.0)
        return pd.DataFrame({"language": np.where(known, names, UNKNOWN), "score": share, "ambiguous": share < CLEAR})


def count_grams(training: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, slot, n) over all training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            texts = encoded(pc.utf8_lower(batch.column(0).cast(pa.large_string())))
            for name in set(names):
                own = [texts[i] for i in np.flatnonzero(names == name)]
                total = held.setdefault(name, np.zeros(1 << SLOT_BITS, np.int64))
                for *_, slots, _ in passes(own):
                    total += np.bincount(slots, minlength=1 << SLOT_BITS)
        for name, total in held.items():
            slot = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(slot), pa.string()), pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["lang", "slot", "n"])

    rows = training.select(F.coalesce(col(text), F.lit("")).alias("text"), col(lang).cast("string").alias("lang"))
    return rows.mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, *, n_rows: int, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on all rows with a language; ``n_rows`` is about how many there are."""
    training = training.where(col(lang).isNotNull())
    counted = count_grams(training, text, lang).toPandas()
    languages = sorted(counted["lang"].unique())
    counts = np.zeros((len(languages), 1 << SLOT_BITS))
    counts[counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), counted["slot"].to_numpy(int)] = counted["n"].to_numpy(float)
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
    code = codewords(len(languages))
    weights = np.zeros((1 << SLOT_BITS, code.shape[1]), np.float32)
    if len(languages) > 1:
        for bit in range(code.shape[1]):
            on = code[:, bit] == 1
            weights[:, bit] = np.log(p[on].mean(axis=0)) - np.log(p[~on].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape[1]))
    if len(languages) > 1:
        part = min(1.0, sample_rows / max(n_rows, 1))
        sample = training.where(F.pmod(F.xxhash64(id_text(id)), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))
        model.reliability = reliabilities(model, sample, text, lang)
    return model


def reliabilities(model: Model, sample: DataFrame, text: str, lang: str) -> np.ndarray:
    """Half the log-odds of each bit being right, on a sample; the sum is the number of bits."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        place = {x: i for i, x in enumerate(own.languages)}
        for batch in batches:
            truth = own.code[[place[x] for x in batch.column(1).to_pylist()]] if batch.num_rows else np.empty((0, own.code.shape[1]))
            right = ((own.margins(batch.column(0)) > 0) == (truth == 1)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(right), dtype=np.int32)), pa.array(right.astype(np.int64)), pa.array(np.full(len(right), batch.num_rows, np.int64))], names=["bit", "right", "n"])

    rows = sample.select(F.coalesce(col(text), F.lit("")).alias("text"), col(lang).cast("string").alias("lang"))
    found = rows.mapInArrow(run, "bit int, right long, n long").groupBy("bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n")).toPandas()
    out = np.ones(model.code.shape[1])
    error = np.clip(1 - (found["right"] + 0.5) / (found["n"] + 1.0), 1e-4, 0.49)
    out[found["bit"].to_numpy(int)] = 0.5 * np.log((1 - error) / error)
    return out / out.mean()


def identify(documents: DataFrame, model: Model, *, text: str = "text", name: str = "language") -> DataFrame:
    """All rows and columns, with a column ``name`` (in place of one of that name): struct (language, score, ambiguous)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("language string, score double, ambiguous boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(texts)

    return documents.withColumn(name, of(col(text)))


def train(documents: DataFrame, *, id: str = "doc_id", folds: int = 4, held_out: int = 2) -> Model:
    """The model of the contract: from rows outside the held-out fold that have a language."""
    training = documents.where((remainder(id, folds) != held_out) & F.col("lang").isNotNull())
    return fit(training, n_rows=training.count(), id=id)
