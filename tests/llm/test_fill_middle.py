"""Fill-in-the-middle: round trips through frames, and brute force in plain Python."""

import hashlib
import random
import re

import pytest

from cohortlens.llm import fill_middle
from cohortlens.llm.common import written
from cohortlens.llm.fill_middle import Frames
from tests.llm.util import CLASHES, documents, empty, prose, rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(id, text, changed=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(units), sha(f"7:{'' if id is None else id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= changed:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    data = rows()
    lines = lambda n: "\n".join(prose(rng, rng.randint(0, 12)) for _ in range(n))
    data += [(3000 + i, lines(i) + "\n" * (i % 3), "en", "a", 0) for i in range(40)]
    data += [(3100 + i, x, "en", "a", 0) for i, x in enumerate(["<P>", "a <S> b\n", "<M\n>", "<P\n>\n<S", "<\n<\n<\n<", "\n", "\n\n", "é\nö\n", "日本\n" * 30_000, lines(9000), "<" * 70_000])]
    return data


def test_digests_match_brute_force(spark):
    data = texts()
    docs = documents(spark, data, **CLASHES, frames="f", n="n")
    got = fill_middle.digests(written(fill_middle.store(docs), "test-frames"))
    assert "text" not in got.columns and set(CLASHES) <= set(got.columns)
    found = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars or 0, r.middle_chars or 0, r.output_sha256, r.restored_sha256) for r in got.collect())
    want = []
    for r in data:
        n, form, p, m, out = brute(r[0], r[1])
        want.append((str(r[0]), n, form, p or 0, m or 0, sha(out), sha(r[1] or "")))
    assert found == sorted(want)
    assert {x[2] for x in want} == {"plain", "psm", "spm"}
    assert got.where("form = 'plain' AND prefix_chars IS NULL AND middle_chars IS NULL").count() == sum(x[2] == "plain" for x in want)


@pytest.mark.parametrize("changed,suffix_first", [(50, 50), (100, 0), (0, 100)])
def test_outputs_and_restored_texts(spark, changed, suffix_first):
    data = [r for r in texts() if r[0] is not None]
    stored = fill_middle.store(documents(spark, data))
    out = fill_middle.rearranged(stored, changed=changed, suffix_first=suffix_first)
    found = sorted((r.doc_id, r.form, r.output) for r in out.collect())
    assert found == sorted((r[0], x[1], x[4]) for r in data for x in [brute(r[0], r[1], changed, suffix_first)])
    back = fill_middle.restore(out)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r[0], r[1] or "") for r in data)


def test_empty_table(spark):
    assert fill_middle.digests(fill_middle.store(empty(spark))).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 16])
def test_frames_of_any_size(size):
    rng = random.Random(size)
    for text in ("", "\n", "a", "é\n", "a\nb\n\nç 日本\n" * 5, "".join(rng.choices("ab\né日", k=300))):
        data = text.encode()
        held = Frames.of([data[: len(data) // 2], b"", data[len(data) // 2 :]], size)
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert held.n_lines == len(units) and held.size == len(data) and sum(map(len, map(held.frame, range(len(held.frames))))) == len(data)
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert held.after_lines(k) == (len(head.encode()), len(head))
        for _ in range(20):
            a, b = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
            assert b"".join(held.stream(a, b)) == data[a:b]


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_marks_are_found_across_frames(size):
    data = b"<<P<P><S><<S>><M>"
    held = Frames.of([data], size)
    for mark in (b"<P>", b"<S>", b"<M>"):
        for start in range(len(data)):
            if data.find(mark, start) >= 0:
                assert held.find(mark, start) == data.find(mark, start)
            else:
                with pytest.raises(ValueError):
                    held.find(mark, start)


def test_only_the_cut_frame_is_opened(monkeypatch):
    text = b"line\n" * 100_000
    held, opened = Frames.of([text], 4096), []
    whole = Frames.frame
    monkeypatch.setattr(Frames, "frame", lambda self, i: opened.append(i) or whole(self, i))
    assert held.after_lines(60_000) == (300_000, 300_000) and len(opened) == 1
    opened.clear()
    assert b"".join(held.stream(4096 * 3, 4096 * 3 + 10)) == text[:10][2:] + text[:2] or len(opened) == 1
    assert len(opened) == 1
