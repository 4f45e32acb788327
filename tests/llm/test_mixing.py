"""Mixing: apportionment against the plain procedure, words taken, pieces of texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import mixing
from tests.llm.util import CLASHES, documents, empty, prose, rows, words


def plain_seats(weights, n, most):
    out = [0] * len(weights)
    for _ in range(n):
        open_ = [(w / (2 * out[i] + 1), -i) for i, w in enumerate(weights) if out[i] < most[i] and w > 0]
        if not open_:
            break
        out[-max(open_)[1]] += 1
    return out


def test_seats_go_to_the_highest_quotients():
    rng = random.Random(4)
    for _ in range(300):
        k, n = rng.randint(1, 6), rng.randint(0, 25)
        weights = [rng.choice([0, 0.7, 1, 2, 3, 5.5, 100]) * rng.random() for _ in range(k)]
        most = [rng.randint(0, 9) for _ in range(k)]
        assert mixing.seats(np.array(weights), n, np.array(most)).tolist() == plain_seats(weights, n, most)
    tied = mixing.seats(np.array([2.0, 2.0, 2.0]), 4, np.array([9, 9, 9]))
    assert tied.sum() == 4 and tied.max() == 2


def test_targets():
    assert mixing.targets(np.array([100, 100, 100]), np.array([1, 2, 3])).tolist() == [50, 100, 150]
    found = mixing.targets(np.array([10, 1000, 10]), np.array([1, 2, 3]))
    assert found.tolist() == [30, 960, 30]  # the small ones stop at 3 times their size
    assert mixing.targets(np.array([0, 0]), np.array([1, 2])).tolist() == [0, 0]


def data(n=3000):
    rng = random.Random(8)
    out = [(i, prose(rng, rng.choice([5, 40, 200])), "en", rng.choice(["hot"] * 6 + ["a", "b", "B", "é", None]), 0) for i in range(n)]
    return out + [(9000, prose(rng, 4000), "en", "a", 0), (9001, None, "en", "zero", None)]


def test_plan(spark):
    docs = documents(spark, data(), **CLASHES).repartition(5)
    found = mixing.plan(docs).collect()
    by_id = {r[0]: r for r in data()}
    sizes, sums, taken, wanted = {}, {}, {}, {}
    for r in found:
        source = by_id[r["_id"]][3]
        assert r["size"] == len(words(by_id[r["_id"]][1])) and 0 <= r["taken"] <= 3 * r["size"]
        sums[source] = sums.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        sizes.setdefault(source, set()).add(r["source_size"])
        wanted.setdefault(source, set()).add(r["target"])
    assert len(found) == len(data()) and all(sizes[s] == {sums[s]} for s in sums)
    order = sorted((s for s in sums if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    total, weights = sum(sums.values()), [(1, 2, 3)[i % 3] for i in range(len(order))]
    target, free, left = {}, set(range(len(order))), float(total)
    while free:  # as the contract says it
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 3 * sums[order[i]]}
        for i in over or free:
            target[order[i]] = 3.0 * sums[order[i]] if over else share[i]
        if not over:
            break
        left -= sum(target[order[i]] for i in over)
        free -= over
    for s in order:
        assert len(wanted[s]) == 1 and abs(next(iter(wanted[s])) - target[s]) < 1e-6 * max(1, target[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 5, s
    again = mixing.plan(documents(spark, data()).repartition(11)).collect()
    assert sorted((r["_id"], r["taken"]) for r in again) == sorted((r["_id"], r["taken"]) for r in found)
    assert {r["_id"]: r["taken"] for r in mixing.plan(docs, seed=7).collect()} != {r["_id"]: r["taken"] for r in found}


def test_mix_holds_the_words_that_are_taken(spark):
    docs = documents(spark, data(600), **CLASHES)
    placed = {r["_id"]: r for r in mixing.plan(docs).collect()}
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes
    got, texts = {}, {r[0]: r[1] for r in data(600)}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text) and r.score == 7.5
    assert got == {i: r["taken"] for i, r in placed.items() if r["taken"]}


def test_pieces_of_a_text():
    draw = {"_len": 10, "_n": 4, "_phase": 3, "_base": 1, "_more": 2}  # blocks 3 and 0 once more
    assert mixing.pieces(5, 20, draw) == [(0, 20), (0, 5)]
    assert mixing.pieces(25, 15, draw) == [(0, 15), (5, 15)]
    assert mixing.pieces(0, 0, draw) == []
    assert mixing.cut("a  b\nc d", [(0, 4), (1, 3)]) == ["a  b\nc d", "b\nc"]


def test_odd_rows(spark):
    found = mixing.plan(documents(spark, **CLASHES)).collect()
    assert len(found) == len(rows())
    assert {r["size"] for r in found if r["_id"] in (1000, 1001, 1002)} == {0}
    assert mixing.plan(empty(spark)).count() == mixing.mix(empty(spark)).count() == 0
    nothing = documents(spark, [(1, None, None, None, None), (2, " ", None, "a", 1)])
    assert [(r["target"], r["taken"]) for r in mixing.plan(nothing).collect()] == [(0.0, 0), (0.0, 0)]
    with pytest.raises(ValueError, match="max_sources"):
        mixing.plan(documents(spark).withColumn("source", F.col("doc_id").cast("string")), max_sources=3)
