"""Benchmark decontamination against plain-Python brute force."""

import re

import pytest

from cohortlens.llm import decontamination
from tests.llm.util import CLASHES, documents, empty, lower, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def split(text):
    return WORD.findall(lower(text or ""))


def brute(texts, items, size=10):
    windows = {}
    for name, text in items:
        own = split(text)
        n = min(len(own), size)
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i : i + n]), set()).add("" if name is None else str(name))
    out = []
    for text in texts:
        own, hit, names = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                found = windows.get(tuple(own[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out.append((len(own), len(hit), sorted(names)))
    return out


def planted():
    data = rows()
    long = next(r[1] for r in data if r[0] == 1003)
    own = long.split()
    items = [
        (1, " ".join(own[100:140])),  # inside the long document
        (2, "Three SHORT words"), (3, "three short"), (4, ""), (5, None), (None, " ".join(own[130:150])),
        (6, " ".join(own[:9])), (7, " ".join(own[:10])), (7, " ".join(own[:10])), (8, "--- !!"), (9, "größe Ärger ÉTÉ"), (10, "x1"),
        (11, "again and again and again and again and again and again and again"),
    ]
    data += [
        (2000, "so (three) Short, words; three short x1", "en", "a", 0),
        (2001, "THREE short", "en", "a", 0),
        (2002, " ".join(own[105:114]), "en", "a", 0),  # nine words of an item: no window
        (2003, "before " + ", ".join(own[105:116]).upper() + " after", "en", "a", 0),
        (2004, "größe ärger été größe Ärger ÉTÉ", "en", "a", 0),  # only A-Z are lowered
        (2005, "and " + "again and " * 30 + "x1\x00x1", "en", "a", 0),
        (2005, "and " + "again and " * 30 + "x1\x00x1", "en", "a", 0),
    ]
    return data, items


@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 0])
def test_marks_match_brute_force(spark, broadcast_bytes):
    data, items = planted()
    docs = documents(spark, data, **CLASHES, items="i", n_hit="h")
    marked = decontamination.mark(docs, spark.createDataFrame(items, ITEM), broadcast_bytes=broadcast_bytes)
    assert marked.columns == [c for c in docs.columns if c not in ("items", "n_hit", "spans")] + ["n_words", "n_hit", "spans", "items"]
    got = sorted((str(r.doc_id), r.text or "", r.n_words, r.n_hit, r["items"]) for r in marked.collect())
    want = sorted((str(r[0]), r[1] or "", *x) for r, x in zip(data, brute([r[1] for r in data], items)))
    assert got == want
    assert sum(x[3] > 0 for x in want) >= 7


def test_short_windows_and_no_items(spark):
    data, items = planted()
    docs = documents(spark, data)
    got = decontamination.mark(docs, spark.createDataFrame(items, ITEM), window=3, keep=["doc_id"]).collect()
    want = brute([r[1] for r in data], items, 3)
    assert sorted((str(r.doc_id), r.n_hit, r["items"]) for r in got) == sorted((str(r[0]), *x[1:]) for r, x in zip(data, want))
    none = decontamination.mark(docs, spark.createDataFrame([], ITEM))
    assert none.count() == len(data) and none.where("n_hit > 0 OR size(items) > 0 OR size(spans) > 0").count() == 0
    assert decontamination.mark(empty(spark), spark.createDataFrame(items, ITEM)).count() == 0


def test_spans_are_cut_or_documents_dropped(spark):
    data, items = planted()
    docs, tests = documents(spark, data, **CLASHES), spark.createDataFrame(items, ITEM)
    want = brute([r[1] for r in data], items)
    kept = decontamination.decontaminate(docs, tests, remove="documents")
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r, x in zip(data, want) if not x[1])
    cut = decontamination.decontaminate(docs, tests)
    assert cut.dtypes == docs.dtypes and cut.count() == len(data)
    texts = {r.doc_id: r.text for r in cut.where("doc_id >= 2000").collect()}
    assert texts[2000] == "so (" and texts[2001] == "" and texts[2003] == "before after" and texts[2004] == "größe ärger été "
    whole = {r[0]: r[1] for r, x in zip(data, want) if not x[1] and r[0] is not None}
    assert all(r.text == whole[r.doc_id] for r in cut.collect() if r.doc_id in whole)
    # what is left of a text has its other words, in order
    by_text = sorted(len(split(r.text)) for r in cut.collect())
    assert by_text == sorted(n - hit for n, hit, _ in want)
    with pytest.raises(ValueError, match="remove"):
        decontamination.decontaminate(docs, tests, remove="lines")


def test_plan_has_no_python_and_shuffles_only_hits(spark):
    data, items = planted()
    marked = decontamination.mark(documents(spark, data), spark.createDataFrame(items, ITEM), keep=["doc_id"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    assert not re.search(r"\b_words", plan.split("Exchange hashpartitioning")[0])  # words stay where they are
