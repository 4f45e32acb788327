"""Token ids of whole texts by a public tokenizer, remembering words that recur.

A byte-level BPE vocabulary first splits a text by a fixed pattern; merges
never cross the pieces.  A space before a visible character always begins a
piece, so does a line feed between two visible ones, and so does a mark after
a letter that ends a word, so a text may be cut there and its parts encoded in
any company that keeps those cuts.  Words recur: texts are cut in one numpy
pass over their bytes, equal parts become one, each worker remembers the ids
of recent parts, and only new ones go to the tokenizer, many in one text.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

#: Parts that one generation of the memory holds (about 130 MB); the memory is two generations.
REMEMBERED = 800_000
#: Bytes of texts that callers encode in one call: enough for many new parts at once.
ENCODE_CHARS = 1 << 22
#: New parts that are encoded in one text.
TOGETHER = 4_000
_SPACE, _LINE, _TWO_BYTES = 0x20, 0x0A, 0xC3
_MARKS = b".,;:!?"


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


#: Bytes that begin a character which is surely not white space (of others nobody asks: no cut there).
_VISIBLE = _class((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF4))
_ASCII_VISIBLE, _ASCII_LETTER = _class((0x21, 0x7E)), _class((0x41, 0x5A), (0x61, 0x7A))
#: After 0xC3, bytes that end a letter (U+00C0 to U+00FF without the signs of multiplication and division).
_LATIN = _class((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
_MARK = _class(*[(x, x) for x in _MARKS])


def cuts(data: np.ndarray, ends: np.ndarray, visible: np.ndarray = _VISIBLE) -> np.ndarray:
    """Where a part begins (by byte), within texts that each end in a byte 0 of their own at ``ends``."""
    before, two_before, after = np.zeros_like(data), np.zeros_like(data), np.zeros_like(data)
    before[1:], two_before[2:], after[:-1] = data[:-1], data[:-2], data[1:]
    at_end = np.zeros(len(data), bool)
    at_end[ends] = True
    latin = (two_before == _TWO_BYTES) & _LATIN[before]
    begins = ((data == _SPACE) | (data == _LINE) & (_ASCII_VISIBLE[before] | latin)) & visible[after] & ~at_end
    word_ends = np.zeros(len(data), bool)
    word_ends[:-1] = (begins | at_end)[1:]
    return begins | _MARK[data] & (_ASCII_LETTER[before] | latin) & word_ends & ~at_end


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.  A remembered part is named by its bytes, the space or line feed before it included."""

    def __init__(self, path: str, remembered: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self._bytes[i] = len(token)  # a character stands for a byte; added tokens are ASCII
        # white space before an added token ends where the token begins, so nothing is cut there
        self._visible = _VISIBLE.copy()
        self._visible[[x.content.encode()[0] for x in self._tokenizer.get_added_tokens_decoder().values()]] = False
        self._marks = {bytes([x]): self._ids([chr(x)])[0] for x in _MARKS}
        self._first = len(self._ids([" a"])[0]) // 4
        self._remembered = remembered or REMEMBERED
        self._young: dict[bytes, bytes] = dict(self._marks)
        self._old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, parts: list[bytes]) -> None:
        for i in range(0, len(parts), TOGETHER):
            some = parts[i : i + TOGETHER]
            data = self._ids([(b" a" + b"".join(some)).decode()])[0][4 * self._first :]
            ends = np.cumsum(self._bytes[np.frombuffer(data, "<u4")])
            stops = 4 * (np.searchsorted(ends, np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))) + 1)
            a = 0
            for part, b in zip(some, stops.tolist()):
                self._young[part] = data[a:b]
                a = b

    def _ids_of(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts; those of new ones are remembered."""
        ids = list(map(self._young.get, parts))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if not gaps:
            return ids
        if len(self._young) + len(gaps) > self._remembered:
            self._old, self._young = self._young, dict(self._marks)
        young, old, new = self._young, self._old, []
        for i in gaps:
            part = parts[i]
            found = old.get(part)
            if found is None:
                new.append(i)
            else:
                ids[i] = young[part] = found
        self._encode_new([parts[i] for i in new])
        for i in new:
            ids[i] = young[parts[i]]
        return ids

    def encode(self, texts: list[str] | list[bytes]) -> list[bytes]:
        """The ids of each text; words that several texts have are looked up once."""
        if not texts:
            return []
        texts = [x.encode() if isinstance(x, str) else x for x in texts]
        joined = b"\0".join([*texts, b""])
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        begins = cuts(data, ends, self._visible)
        is_head = np.zeros(len(data), bool)
        is_head[starts] = ~begins[starts]  # a text's first part, if no space begins it
        is_head[ends] = False
        begins[starts] = begins[ends] = True
        places = np.flatnonzero(begins)
        offsets = np.append(places, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        head, plain = is_head[places], ~is_head
        plain[ends] = False
        plain = plain[places]
        heads = dict(zip(np.flatnonzero(head).tolist(), self._ids([x.decode() for x in parts.filter(pa.array(head)).to_pylist()])))
        words = parts.filter(pa.array(plain)).dictionary_encode()
        ids = self._ids_of(words.dictionary.to_pylist())
        # every word's ids from those of the different words, one after the other
        known = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        which = words.indices.to_numpy(zero_copy_only=False)
        n = lengths[which]
        stops = np.cumsum(n)
        total = int(stops[-1]) if len(n) else 0
        flat = known[np.repeat((np.cumsum(lengths) - lengths)[which] - (stops - n), n) + np.arange(total)].tobytes()
        up_to = np.zeros(len(places) + 1, np.int64)
        up_to[1:][plain] = n
        np.cumsum(up_to, out=up_to)
        first = np.searchsorted(places, starts)
        cut = 4 * up_to[np.append(first, len(places))]
        return [heads.get(i, b"") + flat[a:b] for i, a, b in zip(first.tolist(), cut.tolist(), cut[1:].tolist())]


@functools.lru_cache(maxsize=4)
def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file, kept from task to task."""
    return Encoder(path, remembered)


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed package of public tokenizers has a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
