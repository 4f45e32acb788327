"""Fill-in-the-middle rearrangement over seekable compressed frames.

A text is stored as independent zstandard frames of ``FRAME_BYTES``; beside
them stand the line ends, code points and bytes up to the end of each frame.
The two cuts of a text fall after so many lines, drawn from a hash of the
document's id; the counts name the frame that holds a cut, and only that frame
is decompressed to find it.  The rearranged text is a list of ranges and
marks; digests and copies of it stream the frames in the order of the ranges,
one decompressed frame at a time.  The restored text is read from the frames
of the output alone: its marks are found in the stream, and its ranges are
streamed in the order of the text.

Scale: a document is a row, no row meets another and nothing shuffles or is
broadcast.  The store is a written table, some half of the texts' size; later
steps read it instead of the texts.  A task holds the texts of one Arrow batch
and, of each, its frames.

Cases: null and empty texts have no line and stay plain, as do texts that hold
a mark; a null id is hashed as no digits; repeated rows are equal rows; an
empty table gives an empty result; of columns that have the name of one of the
store's or of the result's, the new one stays.
"""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import batches_to, col, encoded

FRAME_BYTES = 1 << 16
LEVEL = 1
PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
SEED = 7
#: Of a hundred texts, how many are rearranged, and how many of these with the suffix first.
CHANGED, SUFFIX_FIRST = 100, 50

STORED = T.StructType(
    [T.StructField("frames", T.ArrayType(T.BinaryType()))]
    + [T.StructField(x, T.ArrayType(T.LongType())) for x in ("line_ends", "char_ends", "byte_ends")]
    + [T.StructField("open_line", T.BooleanType()), T.StructField("marked", T.BooleanType())]
)
DIGESTS = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("form", T.StringType())]
    + [T.StructField(x, T.LongType()) for x in ("prefix_chars", "middle_chars")]
    + [T.StructField(x, T.StringType()) for x in ("output_sha256", "restored_sha256")]
)


@functools.cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


@functools.cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def code_points(data: bytes) -> int:
    """Of UTF-8 that may begin or end within a character: the characters that begin in it."""
    return len(data) if data.isascii() else int(np.count_nonzero(np.frombuffer(data, np.int8) >= -64))


def cut_evenly(pieces: Iterable[bytes], size: int) -> Iterator[bytes]:
    """The same bytes in pieces of ``size``, the last one shorter."""
    held: list[bytes] = []
    n = 0
    for piece in pieces:
        at = 0
        while n + len(piece) - at >= size:
            take = size - n
            yield b"".join([*held, piece[at : at + take]])
            held, n, at = [], 0, at + take
        if at < len(piece):
            held.append(piece[at:])
            n += len(piece) - at
    if n:
        yield b"".join(held)


@dataclass
class Frames:
    """A text as independent frames, with the line ends, code points and bytes up to the end of each."""

    frames: list[bytes] = field(default_factory=list)
    lines: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    #: Whether the last line has no line end.
    open_line: bool = False

    @classmethod
    def of(cls, pieces: Iterable[bytes], size: int = FRAME_BYTES) -> Frames:
        out, lines, chars, n = cls(), 0, 0, 0
        for data in cut_evenly(pieces, size):
            lines, chars, n = lines + data.count(b"\n"), chars + code_points(data), n + len(data)
            out.frames.append(_compressor().compress(data))
            out.lines.append(lines)
            out.chars.append(chars)
            out.sizes.append(n)
            out.open_line = data[-1:] != b"\n"
        return out

    @property
    def size(self) -> int:
        return self.sizes[-1] if self.sizes else 0

    @property
    def n_lines(self) -> int:
        return self.lines[-1] + self.open_line if self.lines else 0

    def frame(self, i: int) -> bytes:
        return _decompressor().decompress(self.frames[i])

    def stream(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes of a range, frame by frame; no other frame is touched."""
        i = bisect_right(self.sizes, start)
        while start < stop:
            begin = self.sizes[i - 1] if i else 0
            yield self.frame(i)[start - begin : stop - begin]
            start, i = self.sizes[i], i + 1

    def after_lines(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first ``k`` lines: only the frame in which the last of them ends is opened."""
        if not k:
            return 0, 0
        if k >= self.n_lines:
            return self.size, self.chars[-1]
        i = bisect_left(self.lines, k)
        lines, chars, size = (x[i - 1] if i else 0 for x in (self.lines, self.chars, self.sizes))
        data = self.frame(i)
        end = int(np.flatnonzero(np.frombuffer(data, np.uint8) == 10)[k - lines - 1]) + 1
        return size + end, chars + code_points(data[:end])

    def find(self, mark: bytes, start: int) -> int:
        """Where a mark begins, at or after ``start`` (bytes)."""
        tail, at = b"", start
        for data in self.stream(start, self.size):
            here = (tail + data).find(mark)
            if here >= 0:
                return at - len(tail) + here
            at += len(data)
            tail = (tail + data)[1 - len(mark) :]
        raise ValueError("the output lacks a mark")


def draws(id: int | str | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    return tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4))


@dataclass
class Plan:
    """How a text is rearranged: its form, the ends of prefix and middle, and the output as marks and ranges."""

    form: str
    prefix_chars: int | None = None
    middle_chars: int | None = None
    parts: list[bytes | tuple[int, int]] = field(default_factory=list)

    @classmethod
    def of(cls, text: Frames, marked: bool, numbers: tuple[int, int, int, int], changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> Plan:
        n, whole = text.n_lines, (0, text.size)
        if not text.size or marked or numbers[2] % 100 >= changed:
            return cls("plain", parts=[whole])
        (a, a_chars), (b, b_chars) = (text.after_lines(k) for k in sorted((numbers[0] % (n + 1), numbers[1] % (n + 1))))
        prefix, middle, suffix = (0, a), (a, b), (b, text.size)
        if numbers[3] % 100 < suffix_first:
            return cls("spm", a_chars, b_chars - a_chars, [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
        return cls("psm", a_chars, b_chars - a_chars, [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])

    def stream(self, text: Frames) -> Iterator[bytes]:
        for part in self.parts:
            if isinstance(part, bytes):
                yield part
            else:
                yield from text.stream(*part)


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The text that an output was made of, from its frames and its form."""
    if form == "plain":
        yield from output.stream(0, output.size)
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    starts, at = [], 0
    for mark in order:
        starts.append(output.find(mark, at))
        at = starts[-1] + len(mark)
    ranges = {mark: (start + len(mark), end) for mark, start, end in zip(order, starts, [*starts[1:], output.size])}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(*ranges[mark])


def digest(pieces: Iterable[bytes]) -> str:
    out = hashlib.sha256()
    for x in pieces:
        out.update(x)
    return out.hexdigest()


def store(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """All rows and columns but the text, with its frames and counts (``STORED``).  Write it before reading it more than once."""
    keep = [f for f in documents.schema if f.name not in (text, *STORED.names)]
    schema = T.StructType([*keep, *STORED])
    arrow = batches_to(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(len(keep)))
            held = [Frames.of([x]) for x in texts]
            marked = [any(m in x for m in MARKS) for x in texts]
            new = [[x.frames for x in held], [x.lines for x in held], [x.chars for x in held], [x.sizes for x in held], [x.open_line for x in held], marked]
            columns = [*batch.columns[:-1], *(pa.array(x, arrow.field(len(keep) + i).type) for i, x in enumerate(new))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return documents.select(*[col(f.name) for f in keep], col(text).alias("_text")).mapInArrow(run, schema)


def _stored(batch: pa.RecordBatch, first: int) -> Iterator[tuple[Frames, bool]]:
    """The frames of a batch's rows, from its columns ``first`` on."""
    columns = [batch.column(first + i).to_pylist() for i in range(len(STORED))]
    for frames, lines, chars, sizes, open_line, marked in zip(*columns):
        yield Frames(frames, lines, chars, sizes, open_line), marked


def _mapped(stored: DataFrame, id: str, fields: T.StructType, of) -> DataFrame:
    """The rows and columns of a store without its frames, with new columns made by ``of(frames, marked, id)``."""
    keep = [f for f in stored.schema if f.name not in (*STORED.names, *fields.names)]
    schema = T.StructType([*keep, *fields])
    arrow = batches_to(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [of(*x, name) for x, name in zip(_stored(batch, len(keep) + 1), batch.column(len(keep)).to_pylist())]
            columns = [pa.array(x, arrow.field(len(keep) + i).type) for i, x in enumerate(zip(*rows))] if rows else [pa.array([], f.type) for f in list(arrow)[len(keep) :]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], schema=arrow)

    return stored.select(*[col(f.name) for f in keep], col(id).cast("string").alias("_id"), *STORED.names).mapInArrow(run, schema)


def digests(stored: DataFrame, *, id: str = "doc_id", seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Of each document n, form, prefix_chars, middle_chars and the digests of the output and of the text restored from it."""

    def of(text: Frames, marked: bool, name: str | None) -> tuple:
        plan = Plan.of(text, marked, draws(name, seed), changed, suffix_first)
        output = Frames.of(plan.stream(text))
        return text.n_lines, plan.form, plan.prefix_chars, plan.middle_chars, digest(output.stream(0, output.size)), digest(restored(output, plan.form))

    return _mapped(stored, id, DIGESTS, of)


def rearranged(stored: DataFrame, *, id: str = "doc_id", seed: int = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Of each document the output's form and the output itself, for training (columns ``form`` and ``output``)."""
    fields = T.StructType([T.StructField("form", T.StringType()), T.StructField("output", T.StringType())])

    def of(text: Frames, marked: bool, name: str | None) -> tuple:
        plan = Plan.of(text, marked, draws(name, seed), changed, suffix_first)
        return plan.form, b"".join(plan.stream(text)).decode(errors="replace")

    return _mapped(stored, id, fields, of)


def restore(rows: DataFrame, *, output: str = "output", form: str = "form", name: str = "text") -> DataFrame:
    """All rows and columns, with the text that each output was made of in a column ``name``."""

    @F.udf("string", useArrow=True)
    def of(whole: str | None, form: str) -> str:
        return b"".join(restored(Frames.of([(whole or "").encode()]), form)).decode()

    return rows.withColumn(name, of(col(output), col(form)))
