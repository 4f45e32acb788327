"""Tokens, token files and packing: exact round trips."""

import io
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import packing, token_files
from cohortlens.llm.tokens import Encoder, public_vocabulary
from tests.llm.util import CLASHES, documents, empty, rows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_vocabulary())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    rng = random.Random(3)
    alphabet = " \n\t.,;a'b1é\xa0ⅷ²ſ\x1c日😀"
    texts = ["", " ", "a  b", "x\n \ny", "don't stop. it's", "<|endoftext|> a<|endoftext|>b .", "1.5, 2. 3 x2. y_2.", "of.\nThe the, the. the\nof."]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [r[1] or "" for r in rows()]
    for remembered in (500, 10**6):
        monkeypatch.setattr("cohortlens.llm.tokens.REMEMBERED", remembered)
        own = Encoder(public_vocabulary())
        for a in range(0, len(texts), 700):
            for text, ids in zip(texts[a : a + 700], own.encode(texts[a : a + 700])):
                assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text), text


@pytest.mark.parametrize("width", [1, 2, 7, 8, 9, 15, 16, 17, 31, 32])
def test_bits(width):
    rng = np.random.default_rng(width)
    values = rng.integers(0, 2**width, (5, 513), dtype=np.uint64).astype(np.uint32)
    assert np.array_equal(token_files.unpack_bits(token_files.pack_bits(values, width), 513, width), values)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 512 * 512 + 7, 600_000])
def test_file_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50257, n).astype("<u4")
    if n > 600:
        ids[:300], ids[600:640] = 7, 2**32 - 1  # one block of equal ids, one with far outliers
    parts = np.split(ids, np.sort(rng.integers(0, n + 1, 6)))
    out = io.BytesIO()
    out.close = lambda: None
    writer = token_files.Writer(out)
    for i, x in enumerate(parts):
        writer.add(None if i == 2 else i, x.tobytes())
    assert writer.close() == (len(parts), n)
    reader = token_files.Reader(io.BytesIO(out.getvalue()))
    found = list(reader.documents())
    assert [x[0] for x in found] == [None if i == 2 else i for i in range(len(parts))]
    assert [x[2:] for x in found] == [(len(x), zlib.crc32(x.tobytes())) for x in parts]
    for a, b in ((0, n), (n // 3, n), (n // 3, n // 2)):  # any range, through the index
        assert np.array_equal(reader.slice(a, b), ids[a:b])
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(out.getvalue()[:-1] + b"?"))


def test_outliers_go_to_the_exception_list():
    ids = np.full((1, 512), 5, np.uint32)
    ids[0, :20] = 60_000
    plain = len(token_files.encode_blocks(np.arange(512, dtype=np.uint32)[None])[0])
    assert len(token_files.encode_blocks(ids)[0]) < plain


def test_files_of_documents(spark, tokenizer):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        manifest = token_files.write(documents(spark, **CLASHES).repartition(6), public_vocabulary(), end=0)
    finally:
        spark.conf.set(key, old)
    found = token_files.read(spark, manifest).collect()
    wanted, start = [], 0
    # ids in ascending order, null first; rows that share an id in any order
    got = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows()), key=lambda x: (x is not None, x or 0))
    for r in got:
        assert r.start == start
        start += r.n_tokens
    for r in rows():
        ids = [*ids_of(tokenizer, r[1]), 0]
        wanted.append((r[0], len(ids), crc(ids)))
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in got))) == sorted(map(str, wanted))
    assert manifest.count() > 1


def test_no_files_of_no_documents(spark):
    manifest = token_files.write(empty(spark), public_vocabulary())
    assert manifest.count() == 0 and token_files.read(spark, manifest).count() == 0
    assert packing.pack(packing.tokenize(empty(spark), public_vocabulary())).count() == 0


# ---- packing


def check_bins(lengths, of, at, capacity):
    fill = {}
    for n, b, offset in sorted(zip(lengths, of, at), key=lambda x: (x[1], x[2])):
        assert fill.get(b, 0) == offset
        fill[b] = offset + n
    assert max(fill.values()) <= capacity
    return len(fill)


def test_shards_are_packed_without_gaps():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50, 700):
        for low, high in ((1, 1024), (300, 700), (1, 60), (342, 512), (1023, 1024)):
            lengths = rng.integers(low, high, n).tolist()
            of, at = packing.pack_shard(lengths, 1024)
            bins = check_bins(lengths, of, at, 1024)
            assert -(-sum(lengths) // 1024) <= bins <= len(packing.best_fit(lengths, 1024))


def test_local_search_empties_bins_that_best_fit_leaves():
    capacity = 100
    for lengths in ([60, 50, 30, 20, 20, 20], [51, 27, 26, 23, 23, 25, 25], [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 20]):
        first = packing.best_fit(lengths, capacity)
        of, at = packing.pack_shard(lengths, capacity)
        assert check_bins(lengths, of, at, capacity) <= len(first)
    assert len(packing.best_fit([60, 50, 30, 20, 20, 20], capacity)) == 3
    of, at = packing.pack_shard([60, 50, 30, 20, 20, 20], capacity)
    assert check_bins([60, 50, 30, 20, 20, 20], of, at, capacity) == 2


def test_each_step_of_the_search():
    # one for one: 6 goes to the bin with 5 (room 2), which gives 5
    search = packing.LocalSearch([6, 5, 3], [[0], [1, 2]], 10)
    assert search.give(0) and search.room == {0: 5, 1: 1}
    # one for two, if that fills the other bin more
    search = packing.LocalSearch([7, 3, 3, 2], [[0], [1, 2, 3]], 10)
    assert search.give(0) and sum((10 - r) ** 2 for r in search.room.values()) > 7**2 + 8**2
    # two for one, if neither alone fits
    search = packing.LocalSearch([5, 5, 9, 8], [[0, 1], [2, 3]], 18)
    assert search.give(0) and search.room == {0: 9, 1: 0}


def step_left(search):
    """Whether brute force finds a step between two underfull bins."""
    for d, mine in search.items.items():
        ones = [x for x, _ in mine]
        twos = [a + b for j, a in enumerate(ones) for b in ones[j + 1 :]]
        for t, theirs in search.items.items():
            if t != d and search.room[t] <= search.room[d]:
                single = [0] + [x for x, _ in theirs]
                pairs = [a + b for j, a in enumerate(single[1:]) for b in single[j + 2 :]]
                if any(0 < s - y <= search.room[t] for s in ones for y in single + pairs) or any(0 < s - y <= search.room[t] for s in twos for y in single[1:]):
                    return True
    return False


def test_search_ends_when_no_bin_has_a_step():
    rng = np.random.default_rng(3)
    for low, high, n in ((256, 600, 300), (300, 700, 300), (400, 1023, 150), (200, 420, 400), (1, 1024, 300)):
        for _ in range(3):
            lengths = rng.integers(low, high, n).tolist()
            search = packing.LocalSearch(lengths, packing.best_fit(lengths, 1024), 1024)
            bins = search.run()
            assert sorted(i for b in bins for i in b) == list(range(n)) and max(sum(lengths[i] for i in b) for b in bins) <= 1024
            assert len(bins) == -(-sum(lengths) // 1024) or not step_left(search)


def test_bins_after_the_emptiest_sixteen_may_give():
    # twenty bins that can give nothing, then a pair that has a step
    lengths = [51] * 20 + [60, 30, 58, 33]
    search = packing.LocalSearch(lengths, [[i] for i in range(20)] + [[20, 21], [22, 23]], 100)
    before = {b: r for b, r in search.room.items() if b >= 20}
    search.run()
    assert before == {20: 10, 21: 9} and search.room != {**dict.fromkeys(range(20), 49), **before}


@pytest.mark.parametrize("tasks", [10_000, 3])
def test_leftovers_of_shards_are_packed_together(spark, monkeypatch, tasks):
    monkeypatch.setattr(packing, "TASKS", tasks)
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 500, 4000).tolist() + [1024, 1024]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").repartition(3)
    packed = packing.pack(pieces, shard_pieces=200).cache()
    found = packed.collect()
    bins = check_bins([r.length for r in found], [r.sequence_id for r in found], [r.offset for r in found], 1024)
    assert sorted((r.doc_id, r.length) for r in found) == list(enumerate(lengths))
    least = -(-sum(lengths) // 1024)
    assert packing.report(packed).collect() == [(bins, least)]
    assert bins <= least + 8  # 20 shards, each of which alone leaves part of a sequence


def test_each_shard_has_a_task_of_its_own(spark):
    pieces = spark.range(2000).selectExpr("id AS doc_id", "1 + id % 700 AS length")
    plan = packing.pack(pieces, shard_pieces=200)._jdf.queryExecution().toString()
    assert "shufflepartitionidpassthrough" in plan and "FlatMapGroupsInPandas" in plan


def test_search_effort_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "PROBES", 0)
    lengths = [60, 50, 30, 20, 20, 20]
    of, at = packing.pack_shard(lengths, 100)
    assert check_bins(lengths, of, at, 100) == 3


def test_packing_of_documents(spark, tokenizer):
    pieces = packing.tokenize(documents(spark, **CLASHES).repartition(4), public_vocabulary(), end=2, keep_ids=True)
    packed = packing.pack(pieces, shard_pieces=30).cache()
    wanted = []
    for r in rows():
        ids, start = [*ids_of(tokenizer, r[1]), 2], 0
        for nth, n in enumerate(([len(ids) % 1024] if len(ids) % 1024 else []) + [1024] * (len(ids) // 1024)):
            wanted.append((r[0], nth, start, n, crc(ids[start : start + n])))
            start += n
    found = packed.collect()
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found))) == sorted(map(str, wanted))
    bins = check_bins([r.length for r in found], [r.sequence_id for r in found], [r.offset for r in found], 1024)
    whole = packing.sequences(packed).collect()
    assert len(whole) == bins and sum(len(r.input_ids) for r in whole) == sum(x[3] for x in wanted)
    again = {(r.sequence_id, r.offset): crc(next(w.input_ids for w in whole if w.sequence_id == r.sequence_id)[r.offset : r.offset + r.length]) for r in found[:40]}
    assert again == {(r.sequence_id, r.offset): r.ids_crc32 for r in found[:40]}
