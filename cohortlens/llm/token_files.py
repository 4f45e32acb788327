"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of a range of documents, one after the other, in blocks
of ``BLOCK`` ids.  Of each block the minimum is subtracted; the rest is packed
at the width, in bits, that ``PERCENTILE`` of the block's numbers fit in; the
high bits of the others go to an exception list.  Layout, little-endian:

    magic "PFR1", block size u32
    blocks: minimum u32, width u8, exceptions u16, packed numbers,
            exception places u16 each, their bits above the width u32 each
    document ids i64 each, nulls u8 each, lengths u64 each
    index: byte offset of each block u64, and of the end
    n documents u64, n ids u64, offset of the document ids u64, offset of the index u64, magic

so the ids of any document are read through the index without the rest.

Scale: texts shuffle once, by ranges of (id, hash of the text), so even an id
that many rows share is cut; each task streams its range into one file in the
shared folder and returns one manifest row.  The manifest is a written table:
a file counts only if the task that wrote it was committed, so files of lost
or repeated attempts are never read.  The driver holds one row a file.

Cases: null and empty texts hold the end id alone; null ids come first; rows
that repeat an id are ordered by a hash of the text; an empty table has no
file and gives an empty result; ids of another kind than integers are refused.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import chunks, col, encoded, shared_path, written
from cohortlens.llm.tokens import ENCODE_CHARS, encoder

MAGIC = b"PFR1"
BLOCK = 512
PERCENTILE = 90
#: Blocks that are encoded or decoded in one pass.
PASS = 512
_HEAD = struct.Struct("<IBH")
_TAIL = struct.Struct("<QQQQ4s")
#: Bit lengths of the numbers that ids of a usual vocabulary come to.
_LENGTH = np.frexp(np.arange(1 << 17, dtype=np.float64))[1].astype(np.uint8)
MANIFEST = "part int, path string, n_documents long, n_ids long"


# ---- blocks


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned numbers below 2 ** width as rows of packed bytes: eight numbers take ``width`` bytes."""
    n = -(-values.shape[1] // 8)
    eights = np.zeros((len(values), n * 8), np.uint64)
    eights[:, : values.shape[1]] = values
    eights = np.ascontiguousarray(eights.reshape(len(values), n, 8).transpose(2, 0, 1))
    out = np.zeros((len(values), n, width), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * width, 8)
        shifted = eights[k] << np.uint64(shift)
        for t in range((shift + width + 7) // 8):
            out[:, :, byte + t] |= (shifted >> np.uint64(8 * t)).astype(np.uint8)
    return out.reshape(len(values), -1)


def unpack_bits(data: np.ndarray, n: int, width: int) -> np.ndarray:
    """The inverse: ``n`` numbers of each row of bytes."""
    groups = np.ascontiguousarray(data.reshape(len(data), -1, width).transpose(2, 0, 1)).astype(np.uint64)
    out = np.empty((len(data), groups.shape[2], 8), np.uint32)
    for k in range(8):
        byte, shift = divmod(k * width, 8)
        value = groups[byte] >> np.uint64(shift)
        for t in range(1, (shift + width + 7) // 8):
            value |= groups[byte + t] << np.uint64(8 * t - shift)
        out[:, :, k] = value & np.uint64((1 << width) - 1)
    return out.reshape(len(data), -1)[:, :n]


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Rows of ids (uint32), each as an encoded block."""
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    bits = _LENGTH[rest] if rest.max(initial=0) < len(_LENGTH) else np.frexp(rest.astype(np.float64))[1].astype(np.uint8)
    at = -(-ids.shape[1] * PERCENTILE // 100) - 1
    width = np.partition(bits, at, axis=1)[:, at]
    packed: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            for i, data in zip(rows, pack_bits(rest[rows] & np.uint32((1 << int(w)) - 1), int(w))):
                packed[i] = data.tobytes()
    row, place = np.nonzero(bits > width[:, None])
    high = (rest[row, place].astype(np.uint64) >> width[row].astype(np.uint64)).astype("<u4")
    cuts = np.searchsorted(row, np.arange(len(ids) + 1))
    place = place.astype("<u2")
    return [
        _HEAD.pack(int(low[i]), int(width[i]), int(b - a)) + packed[i] + place[a:b].tobytes() + high[a:b].tobytes()
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]


def decode_blocks(data: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
    """Blocks of ``n`` ids that begin at these offsets, as rows."""
    out = np.zeros((len(offsets), n), np.uint32)
    heads = [_HEAD.unpack_from(data, int(x)) for x in offsets]
    width = np.array([h[1] for h in heads])
    for w in np.unique(width):
        if w:
            size = -(-n // 8) * int(w)
            rows = np.flatnonzero(width == w)
            packed = np.frombuffer(b"".join([data[offsets[i] + _HEAD.size : offsets[i] + _HEAD.size + size] for i in rows]), np.uint8)
            out[rows] = unpack_bits(packed.reshape(len(rows), size), n, int(w))
    for i, (low, w, exceptions) in enumerate(heads):
        if exceptions:
            at = int(offsets[i]) + _HEAD.size + -(-n // 8) * w
            place = np.frombuffer(data, "<u2", exceptions, at)
            out[i, place] |= np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions) << np.uint32(w)
        out[i] += np.uint32(low)
    return out


# ---- files


class Writer:
    """Streams documents' ids into one file."""

    def __init__(self, out):
        self.out, self.at, self.offsets, self.n_ids = out, 0, [], 0
        self.ids, self.nulls, self.lengths = [], [], []
        self.held: list[bytes] = []
        self.n_held = 0
        self._put(MAGIC + struct.pack("<I", BLOCK))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _blocks(self, blocks: list[bytes]) -> None:
        for x in blocks:
            self.offsets.append(self.at)
            self.at += len(x)
        self.out.write(b"".join(blocks))

    def add(self, id: int | None, ids: bytes) -> None:
        self.ids.append(id or 0)
        self.nulls.append(id is None)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= BLOCK * PASS:
            self._flush()

    def _flush(self) -> None:
        data = np.frombuffer(b"".join(self.held), "<u4")
        whole = len(data) // BLOCK * BLOCK
        for a in range(0, whole, BLOCK * PASS):
            self._blocks(encode_blocks(data[a : min(whole, a + BLOCK * PASS)].reshape(-1, BLOCK)))
        self.n_ids += whole
        self.held, self.n_held = [data[whole:].tobytes()], len(data) - whole

    def close(self) -> tuple[int, int]:
        self._flush()
        if self.n_held:
            self._blocks(encode_blocks(np.frombuffer(self.held[0], "<u4").reshape(1, -1)))
            self.n_ids += self.n_held
        documents = self.at
        self._put(np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes() + np.array(self.lengths, "<u8").tobytes())
        index = self.at
        self._put(np.array([*self.offsets, documents], "<u8").tobytes())
        self._put(_TAIL.pack(len(self.ids), self.n_ids, documents, index, MAGIC))
        self.out.close()
        return len(self.ids), self.n_ids


class Reader:
    """Reads documents' ids from one file (a seekable binary file)."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        n, self.n_ids, documents, index, magic = _TAIL.unpack(self._read(size - _TAIL.size, _TAIL.size))
        head = self._read(0, 8)
        if magic != MAGIC or head[:4] != MAGIC:
            raise ValueError("not a token file, or not a whole one")
        self.block = struct.unpack("<I", head[4:])[0]
        data = self._read(documents, 17 * n)
        self.ids = np.frombuffer(data, "<i8", n)
        self.nulls = np.frombuffer(data, np.uint8, n, 8 * n).astype(bool)
        self.lengths = np.frombuffer(data, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.offsets = np.frombuffer(self._read(index, size - _TAIL.size - index), "<u8").astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The file's ids from start to stop, through the index."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block + 1
        base = int(self.offsets[first])
        data = self._read(base, int(self.offsets[last]) - base)
        at = self.offsets[first:last] - base
        short = self.n_ids - (last - 1) * self.block if last == len(self.offsets) - 1 else self.block
        out = decode_blocks(data, at[:-1], self.block).reshape(-1)
        out = np.concatenate([out, decode_blocks(data, at[-1:], short).reshape(-1)])
        return out[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """Of each document in order: id, start in the file, length, crc32 of its ids."""
        step = self.block * PASS
        have, base = np.empty(0, np.uint32), 0
        for id, null, start, length in zip(self.ids.tolist(), self.nulls.tolist(), self.starts.tolist(), self.lengths.tolist()):
            crc, at = 0, start
            while True:
                part = have[at - base : start + length - base]
                crc = zlib.crc32(part.astype("<u4", copy=False).tobytes(), crc)
                at += len(part)
                if at == start + length:
                    break
                base, have = at // step * step, self.slice(at // step * step, min(self.n_ids, at // step * step + step))
            yield None if null else id, start, length, crc


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(documents: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text", end: int = 0, folder: str | None = None) -> DataFrame:
    """Write the files; returns the manifest (part, path, n_documents, n_ids), parts in ascending id order."""
    spark = documents.sparkSession
    folder = folder or f"{shared_path(spark)}/token-files-{uuid.uuid4().hex}"
    filesystem, base = _filesystem(folder)
    filesystem.create_dir(base, recursive=True)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, writer, part = encoder(vocabulary), None, TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.pfr"
        for batch in batches:
            if writer is None:
                filesystem, name = _filesystem(path)
                writer = Writer(filesystem.open_output_stream(name))
            names, texts = batch.column(0).to_pylist(), encoded(batch.column(1))
            for a, b in chunks(texts, ENCODE_CHARS):
                for x, ids in zip(names[a:b], own.encode(texts[a:b])):
                    writer.add(x, ids + last)
        if writer is not None:
            n, n_ids = writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([n]), pa.array([n_ids])], names=["part", "path", "n_documents", "n_ids"])

    kind = documents.schema[id].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"ids are stored as 64-bit integers; {id} is {kind.simpleString()}")
    rows = documents.select(col(id).cast("long").alias("_id"), col(text).alias("_text"))
    rows = rows.repartitionByRange(F.col("_id"), F.xxhash64("_text")).sortWithinPartitions(F.col("_id"), F.xxhash64("_text"))
    return written(rows.mapInArrow(run, MANIFEST), "token-files-manifest")


def read(spark: SparkSession, manifest: DataFrame, *, id: str = "doc_id") -> DataFrame:
    """Of each document in the files: ``id``, start (ids of all documents before it), n_tokens, ids_crc32."""
    files, start = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r["part"]):
        files.append((row["path"], start))
        start += row["n_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(x.to_pylist() for x in batch.columns)):
                filesystem, name = _filesystem(path)
                with filesystem.open_input_file(name) as file:
                    rows = list(zip(*Reader(file).documents()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(np.array(rows[1]) + before), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())],
                    names=[id, "start", "n_tokens", "ids_crc32"],
                )

    listed = spark.createDataFrame(files, "path string, before long").repartition(max(1, len(files)))
    return listed.mapInArrow(run, f"`{id}` long, start long, n_tokens long, ids_crc32 long")
