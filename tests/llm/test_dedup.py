"""Exact, near and line duplicates against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlens.llm import exact_dedup, line_dedup, simhash
from tests.llm.util import CLASHES, WHITE, Groups, documents, empty, lower, rows, words


def squeezed(text):
    return "".join(c for c in text or "" if c not in WHITE)


def exact_groups():
    groups = {}
    for r in rows():
        groups.setdefault(squeezed(r[1]), []).append(r)
    return groups


def check_decisions(found):
    kept = {}
    for r in found:
        kept.setdefault(r.text_sha256, []).append(r)
    groups = exact_groups()
    assert len(kept) == len(groups) and len(found) == len(rows())
    for text, own in groups.items():
        mine = kept[hashlib.sha256(text.encode()).hexdigest()]
        best = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        assert sorted(str(r.doc_id) for r in mine) == sorted(str(r[0]) for r in own)
        assert {r.keep_id for r in mine} == {best[0]} and {r.group_size for r in mine} == {len(own)}
        assert [r.doc_id for r in mine if r.kept] == [best[0]]


def test_exact_decisions(spark):
    check_decisions(exact_dedup.decide(documents(spark, **CLASHES).repartition(5)).collect())


def small_filters(monkeypatch):
    """A filter of several blocks that is above what is sent out."""
    monkeypatch.setattr(exact_dedup, "blocks_for", lambda n, *a: 3)
    monkeypatch.setattr(exact_dedup, "RANGE_BITS", 1 << 16)


def test_exact_decisions_with_the_filter_on_spark(spark, monkeypatch):
    small_filters(monkeypatch)
    check_decisions(exact_dedup.decide(documents(spark).repartition(3), range_bits=1 << 16).collect())


def test_text_ids(spark):
    docs = documents(spark).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    kept = exact_dedup.deduplicate(docs)
    assert sorted(squeezed(r.text) for r in kept.collect()) == sorted(exact_groups())
    assert {r.keep_id for r in exact_dedup.decide(docs).collect()} == {r.doc_id for r in kept.collect()}
    assert simhash.representatives(docs).count() == len(set(brute_components([brute_print(r[1]) for r in rows()])))


def test_hashes_that_meet_their_filter_block(spark, monkeypatch):
    """Every repeated hash is found, few others, and a hash that a third of all rows have is one row where blocks meet."""
    rng = np.random.default_rng(11)
    values = [int(x) for x in rng.integers(-(2**62), 2**62, 30_000)]
    values += values[:5000] + [values[7]] * 15_000
    hashes = spark.createDataFrame([(x,) for x in values], "_hash long").repartition(6)
    monkeypatch.setattr(exact_dedup, "blocks_for", lambda n, *a: 40)
    found = [r[0] for r in exact_dedup.suspect_hashes(hashes, len(values)).collect()]
    assert len(found) == len(set(found)) and set(values[:5000]) <= set(found) and len(found) < 5600


def test_filter_on_the_driver_is_packed(spark):
    assert exact_dedup.RANGE_BITS // 8 == 32 << 20 and not exact_dedup.fits(10_000_000) and exact_dedup.fits(5_000_000)
    assert exact_dedup.packed_block(np.array([0, 9, 65535], np.uint16).tobytes()).nbytes == exact_dedup.BLOCK_BITS // 8


@pytest.mark.parametrize("range_bits", [1 << 28, 1 << 16])
def test_exact_copies_go(spark, monkeypatch, range_bits):
    monkeypatch.setattr(exact_dedup, "blocks_for", lambda n, *a: 3)
    docs = documents(spark, **CLASHES).repartition(4)
    out = exact_dedup.deduplicate(docs, range_bits=range_bits)
    assert out.dtypes == docs.dtypes
    found = out.collect()
    texts = [squeezed(r.text) for r in found]
    assert sorted(texts) == sorted(exact_groups()) and {r.score for r in found} == {7.5}
    best = {t: min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for t, own in exact_groups().items()}
    assert {squeezed(r.text): r.doc_id for r in found} == best


def test_bloom_filter_has_no_false_negative(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(-(2**62), 2**62, 20_000)
    values[:4000] = values[4000:8000]
    hashes = spark.createDataFrame([(int(x),) for x in values], "h long").repartition(7)
    test = exact_dedup.prober(hashes, "h", exact_dedup.blocks_for(len(values)))
    assert test(values[:8000]).all()
    assert test(values[8000:]).mean() < 0.01


def test_empty_tables(spark):
    docs = empty(spark)
    assert exact_dedup.decide(docs).count() == exact_dedup.deduplicate(docs).count() == 0
    assert simhash.cluster(docs).count() == simhash.representatives(docs).count() == 0
    assert line_dedup.drop_repeated_lines(docs).count() == 0


# ---- near duplicates


def brute_print(text, width=3):
    own = words(lower(text or ""))
    if not own:
        return 0
    shingles = [" ".join(own)] if len(own) < width else [" ".join(own[i : i + width]) for i in range(len(own) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=3):
    groups = Groups()
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                groups.link(i, j)
    return [groups.find(i) for i in range(len(prints))]


def test_comparison_equals_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    prints = []
    for _ in range(700):
        x = base[rng.integers(20)]
        for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False):
            x ^= np.uint64(1) << np.uint64(bit)
        prints.append(x)
    prints = np.unique(np.array(prints, np.uint64))
    rng.shuffle(prints)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for radius in (1, 2, 3, 5):
        label = simhash.forest(len(prints), *np.nonzero(near <= radius))
        assert np.array_equal(simhash.link_large(prints, radius), label)
        assert np.array_equal(simhash.link_runs(prints, np.full(len(prints), len(prints)), radius), label)


def test_every_pair_within_the_radius_shares_a_bucket(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for i in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, 3, replace=False):
            b ^= 1 << int(bit)
        pairs.append((a - 2**63, (b - 2**63 if b < 2**64 else b)))
    pairs = [(int(np.uint64(a % 2**64).astype(np.int64)), int(np.uint64(b % 2**64).astype(np.int64))) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a long, b long")
    shared = df.select(F.size(F.array_intersect(simhash.bucket_keys("a", 3), simhash.bucket_keys("b", 3))).alias("n"))
    assert shared.agg(F.min("n")).first()[0] >= 1


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 4])
def test_links_with_hot_buckets_cut_into_parts(spark, bucket):
    rng = np.random.default_rng(2)
    prints = {int(np.int64(0x1234567812345678)) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))} | set(range(0, 2**40, 2**37))
    df = spark.createDataFrame([(p,) for p in sorted(prints)], "_print long")
    groups = Groups()
    for r in simhash.links(df, 3, bucket=bucket).collect():
        groups.link(r.a, r.b)
    order = sorted(prints)
    wanted = brute_components([p % 2**64 for p in order])
    got = [groups.find(p) for p in order]
    assert len(set(zip(got, wanted))) == len(set(got)) == len(set(wanted))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(i, 2000) for i in range(1000, 1100)] + [(5, 5)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(links).collect()}
    assert {x: found.get(x, x) for x in range(301)} == dict.fromkeys(range(301), 0)
    assert {found.get(x, x) for x in [*range(1000, 1100), 2000]} == {1000}


def test_near_duplicates(spark):
    data = rows()
    found = simhash.cluster(documents(spark, **CLASHES)).collect()
    prints = [brute_print(r[1]) for r in data]
    smallest = {}
    for r, c in zip(data, brute_components(prints)):
        if r[0] is not None:
            smallest[c] = min(smallest.get(c, r[0]), r[0])
    wanted = sorted((r[0] is None, r[0] or 0, f"{p:016x}", smallest.get(c)) for r, p, c in zip(data, prints, brute_components(prints)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in found) == wanted
    docs = documents(spark, **CLASHES)
    kept = simhash.representatives(docs)
    assert kept.dtypes == docs.dtypes
    ids = {smallest.get(c) for c in brute_components(prints)}  # a group without any id stays, too
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, ids))


# ---- lines


def brute_lines(data):
    def key(line):
        return lower(line.strip(WHITE))

    holders = {}
    for r in data:
        for k in {key(x) for x in (r[1] or "").split("\n")}:
            holders.setdefault(k, []).append(r[0])
    gone = {k: max((-1 if x is None else x) for x in v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    out = []
    for r in data:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), -1 if r[0] is None else r[0]) == (-1 if r[0] is None else r[0])]
        out.append((-1 if r[0] is None else r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("range_bits", [1 << 28, 1 << 16])
def test_repeated_lines(spark, monkeypatch, range_bits):
    for module in (exact_dedup, line_dedup):
        monkeypatch.setattr(module, "blocks_for", lambda n, *a: 3)
    out = line_dedup.drop_repeated_lines(documents(spark, **CLASHES).repartition(4), range_bits=range_bits)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect())
    assert got == brute_lines(rows()) and sum(x[2] for x in got) > 0
