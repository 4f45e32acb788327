"""Secrets, toxicity, language and top-k search against brute force and held-out accuracy."""

import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from cohortlens.llm import common, langid, secret_scan, topk, toxicity
from tests.llm.util import CLASHES, documents, empty, prose, rows

# ---- secrets


@pytest.mark.parametrize(
    "text, literals",
    [
        ('db_pwd = "hunter2!xyzZ"', ["hunter2!xyzZ"]),
        ('const k = "a8f7s9d8f7a9"; x = k; connect(clientKey = x)', ["a8f7s9d8f7a9"]),  # carried forward
        ('pw = "abc"\nother = "plain words"\ndb_pass = pw + "DEF123"', ["abc", "DEF123"]),  # put together
        ("auth.key: abc123def456", ["abc123def456"]),
        ('He said: "hello there" and key: value', []),
        ('private_key = "changeme"', []),
        ('api = "https"; name = "Zx81kLmn2"', []),
        ('credential = load("Zx81kLmn2")', []),
    ],
)
def test_lexer(text, literals):
    assert [text[a:b] for a, b, kind, _ in secret_scan.spans(text) if kind == "lexed"] == literals


@pytest.mark.parametrize(
    "text, literals",
    [
        ('private_key            = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),  # aligned, more than 8 blanks
        ("db_pwd" + "\t" * 300 + ': "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('config["db_pwd"] = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ("$cfg['a']['clientPwd'] = 'Zx81kLmn2QpR';", ["Zx81kLmn2QpR"]),
        ('config["color"] = "Zx81kLmn2QpR"', []),
        ('dbPwd: str = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('const clientPwd: string = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('db_pwd: Optional[Dict[str, str]] | None = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('let db_pwd: &str = "Zx81kLmn2QpR";', ["Zx81kLmn2QpR"]),
        ('var dbPwd string = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('char db_pwd[] = "Zx81kLmn2QpR"; char db_pwd[32] = "Yx81kLmn2QpR";', ["Zx81kLmn2QpR", "Yx81kLmn2QpR"]),
        ('color: str = "Zx81kLmn2QpR"', []),
        ('note: the db_pwd = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),  # words aren't a type
        ('mode: db_pwd = "Zx81kLmn2QpR"', ["Zx81kLmn2QpR"]),
        ('db_pwd = "Correct horse battery staple"', ["Correct horse battery staple"]),
        ('backup_passphrase: "over the hills and 7 seas"', ["over the hills and 7 seas"]),
        ('db_pwd = "Please enter your password"', []),
        ('title = "Correct horse battery staple"', []),
    ],
)
def test_assignment_syntax(text, literals):
    assert [text[a:b] for a, b, kind, _ in secret_scan.spans(text) if kind == "lexed"] == literals


def test_gate_and_types_are_linear_on_long_texts():
    for text in ("key" * 100_000 + "\n=", "key " * 80_000 + "\n:", "pwd: a<" * 40_000, "pwd[" * 80_000 + "=", "pwd: " + "a|" * 100_000, "pwd" + " " * 300_000 + "\n="):
        secret_scan.spans(text)


def test_lexer_is_linear_on_long_texts():
    for text in ("key = " * 40_000, "pass='" * 40_000, 'token: "' + "a" * 300_000, "\\'" * 100_000 + " pwd="):
        secret_scan.spans(text)


def brute_base(text):
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    ]
    return sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, g, n) in enumerate(kinds) for m in p.finditer(text) if len(m.group(g)) >= n)


def test_base_spans_on_random_texts(spark):
    rng = random.Random(6)
    bits = ["password", "PassWd", "secret", "token", "apikey", "API_KEY", "=", ":", " ", '"', "'", "abc", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "é", "\n", "-", "x1"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(1500)]
    for text in texts:
        found = [x for x in secret_scan.spans(text) if x[2] != "lexed"]
        assert [f"{k}:{a}:{b}" for a, b, k, _ in found] == [x[2] for x in brute_base(text)]
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts[:200])] + rows(), **{k: v for k, v in CLASHES.items() if k != "spans"})
    out = secret_scan.scan(docs)
    assert out.columns == [*docs.columns, "spans"] and out.count() == docs.count()
    listed = out.select("text", secret_scan.listed("spans", secret_scan.KINDS[:3]).alias("l"), secret_scan.counted("spans", "hex").alias("n"))
    for r in listed.collect():
        base = brute_base(r.text or "")
        assert r.l == ",".join(x[2] for x in base) and r.n == sum(x[1] == 2 for x in base)
    assert secret_scan.scan(empty(spark)).count() == 0


def test_masked(spark):
    docs = documents(spark, [(1, 'a token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" b', "en", "a", 0), (2, None, "en", "a", 0)])
    found = {r.doc_id: r.text for r in secret_scan.masked(secret_scan.scan(docs)).collect()}
    assert found == {1: 'a [secret]" b', 2: None}


# ---- toxicity


def toxic_rows(n=700):
    rng = random.Random(11)
    data, labels = [], []
    for i in range(n):
        own, bad = prose(rng, rng.randint(10, 300)).split(), rng.random() < 0.25
        for _ in range(rng.randint(1, 4) if bad else 0):
            own.insert(rng.randrange(len(own)), rng.choice(["Gromplak", "vuzzik", "drekk" + prose(rng, 1)]))
        data.append((i, " ".join(own), "en", "a", 0))
        labels.append((i, 1, int(bad)))
    return data, labels


def test_event_model_equals_plain_counts(spark):
    texts = [("ab abc", 0), ("abd ab", 1), ("b ab", 1), ("ca", 0)]
    training = spark.createDataFrame(texts, "text string, toxic int")
    found = {r.key: r for r in toxicity.log_ratios(toxicity.count_events(training, "text", "toxic")).collect()}
    counts = {}
    for text, y in texts:
        for word in text.split():
            spelled = " " + word + " "
            for i in range(1, len(spelled)):
                event = spelled[max(0, i - toxicity.ORDER + 1) : i + 1]
                counts.setdefault(event, [0, 0])[y] += 1
    key = lambda e: int.from_bytes(e.encode(), "big")
    assert set(found) == {key(e) for e in counts}

    def short(e):
        return e[1:] if len(e) == toxicity.ORDER else e[-(toxicity.ORDER - 2) :]

    d = toxicity.DISCOUNT
    follows, tails = {}, {}
    for e in counts:
        follows[short(e)] = follows.get(short(e), 0) + 1
    for e in counts:
        tails.setdefault(short(e)[:-1], []).append(short(e))
    for event, own in counts.items():
        s = short(event)
        total, kinds = len(tails[s[:-1]]), len(set(tails[s[:-1]]))
        shared = (follows[s] - min(d, follows[s])) / total + d * kinds / total / 256
        p, left = [], []
        for y in (0, 1):
            same = [c[y] for e, c in counts.items() if e[:-1] == event[:-1]]
            n = sum(same)
            left.append(d * sum(x > 0 for x in same) / n if n else 1.0)
            p.append((max(own[y] - d, 0) / n if n else 0) + left[y] * shared)
        row = found[key(event)]
        assert row.n == sum(own)
        assert math.isclose(row.event, math.log(p[1] / p[0]), abs_tol=1e-9)
        assert math.isclose(row.unseen, math.log(left[1] / left[0]), abs_tol=1e-9)


def test_toxic_documents_are_found(spark):
    data, labels = toxic_rows()
    docs = documents(spark, data + rows(), **{k: v for k, v in CLASHES.items() if k != "score"})
    marks = spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1), (1004, 0, 0), (labels[0][0], 1, labels[0][2])], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    found = scored.select("doc_id", "score", (toxicity.remainder("doc_id", 5) == 0).alias("held_out")).collect()
    assert len(found) == len(data) + len(rows()) and all(0 <= r.score <= 1 for r in found)
    truth = {i: y for i, _, y in labels}
    held_out = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth and r.doc_id < 700 and r.doc_id > 70]
    assert len(held_out) > 80 and np.mean(held_out) > 0.95
    odd = {r.doc_id: r.score for r in found if r.doc_id in (1000, 1001)}
    assert all(s < 0.5 for s in odd.values())


def test_no_labels_no_texts(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(documents(spark), marks)
    assert max(r.score for r in toxicity.score(documents(spark), model).collect()) < 1e-300
    assert toxicity.score(empty(spark), toxicity.train(empty(spark), marks)).count() == 0


class Sent:
    """A part that was sent out."""

    def __init__(self, value):
        self.value = value


def made_up_model(n_parts=1, seed=1):
    """Ratios for the events of the fixture's texts, in parts by context."""
    keys = np.unique(toxicity.events([(r[1] or "").lower().encode() for r in rows()])[0])[::2]
    rng = np.random.default_rng(seed)
    event, contexts = rng.normal(size=len(keys)), np.unique(keys >> np.uint64(8))
    context = rng.normal(size=len(contexts))
    part, of = (toxicity.part_of(x, n_parts) for x in (contexts, keys >> np.uint64(8)))
    parts = [Sent((toxicity.Table.of(keys[of == i], event[of == i]), toxicity.Table.of(contexts[part == i], context[part == i]))) for i in range(n_parts)]
    return toxicity.Model(parts)


def test_passes_tiles_and_parts_do_not_change_features(monkeypatch):
    values = pa.array([r[1] for r in rows()])
    whole = made_up_model().features(values)
    assert whole[60].tolist() == [0, 0, 0] and np.abs(whole).max() > 0  # a null text
    assert np.array_equal(made_up_model(5).features(values), whole)
    for size in (1 << 19, 64, 7, 1):
        monkeypatch.setattr(toxicity, "CHUNK_BYTES", size)
        monkeypatch.setattr(toxicity, "tiles", lambda text, overlap, size=size: common.tiles(text, overlap, size))
        monkeypatch.setattr(toxicity, "chunks", lambda texts: [(i, i + 1) for i in range(len(texts))])
        few = values.take(pa.array([i for i, x in enumerate(values.to_pylist()) if len(x or "") < (10**9 if size > 64 else 300)]))
        want = made_up_model().features(few) if size > 64 else whole[[i for i, x in enumerate(values.to_pylist()) if len(x or "") < 300]]
        for n_parts in (1, 3):
            assert np.allclose(made_up_model(n_parts).features(few), want, rtol=1e-6)


def test_long_texts_take_little_room():
    """Texts of 20 MB, of words and of one word, in a process of their own."""
    code = """
import resource, numpy as np, pyarrow as pa
from cohortlens.llm import langid, toxicity
class Sent: pass
sent = Sent(); sent.value = tuple(toxicity.Table.of(np.arange(1000, dtype=np.uint64), np.ones(1000)) for _ in range(2))
tox = toxicity.Model([sent])
lang = langid.Model(["a", "b"], langid.codewords(2), np.ones((1 << langid.SLOT_BITS, 1), np.float32))
texts = [pa.array(["some words " * 2_000_000]), pa.array(["x" * 20_000_000])]
for text in texts:
    tox.features(text.slice(0, 0)), lang.margins(text.slice(0, 0))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for text in texts:
    assert np.isfinite(tox.features(text)).all() and np.isfinite(lang.margins(text)).all()
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    import pathlib
    import subprocess
    import sys

    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=pathlib.Path(__file__).parents[2])
    assert int(out.stdout) < 500


def test_most_toxic_passage_starts_at_any_word():
    rng = np.random.default_rng(5)
    words = np.array([0, 1, 31, 32, 33, 200, 0, 90, 0])
    word = rng.normal(size=words.sum())
    of = np.repeat(np.arange(len(words)), words)
    found = toxicity.measures(word, of, words)
    for i, n in enumerate(words):
        own = word[of == i]
        wanted = [own[j : j + toxicity.PASSAGE_WORDS] for j in range(n)]
        assert np.isclose(found[i, 1], max((x.sum() / (len(x) + toxicity.PRIOR_WORDS) for x in wanted), default=0.0))
        assert np.isclose(found[i, 0], own.mean() if n else 0.0) and np.isclose(found[i, 2], own.max(initial=-np.inf) if n else 0.0)
    # ordinary words before a toxic passage don't change what it counts
    passage = np.r_[np.full(16, 2.0), np.full(300, -0.1)]
    for before in (0, 1, 16, 24, 31):
        own = np.r_[np.full(before, -0.1), np.full(64, -0.1), passage]
        assert np.isclose(toxicity.measures(own, np.zeros(len(own), int), np.array([len(own)]))[0, 1], (16 * 2.0 - 16 * 0.1) / 40)


@pytest.mark.parametrize("n_parts", [1, 3])
def test_every_event_keeps_its_own_ratio(spark, n_parts):
    """Rare and frequent spellings alike, and no unseen event gets a stranger's ratio."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    texts = [(i, " ".join("".join(rng.choices(letters, k=9)) for _ in range(30)), i % 2) for i in range(400)]
    training = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    wanted = toxicity.log_ratios(toxicity.count_events(training, "text", "toxic")).toPandas()
    model = toxicity.fit(training, n_rows=len(texts), part_events=-(-len(wanted) // n_parts))
    assert len(model.parts) == n_parts and len(wanted) > 50_000

    def found(keys):
        return model.ratios([keys])[0]

    keys = wanted["key"].to_numpy(np.uint64)
    assert np.allclose(found(keys), wanted["event"], atol=1e-5)
    contexts = wanted.groupby("context")["unseen"].first()
    other = np.setdiff1d(contexts.index.to_numpy(np.uint64) << np.uint64(8) | np.uint64(255), keys)  # no text has this byte
    assert np.allclose(found(other), contexts[(other >> np.uint64(8)).astype(np.int64)], atol=1e-5)
    strangers = np.array([int.from_bytes(bytes(rng.choices(range(128, 255), k=6)), "big") for _ in range(5000)], np.uint64)
    assert not found(strangers).any()


def test_parts_of_a_model_do_not_change_scores(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "GROUP_BYTES", 20_000)
    data, labels = toxic_rows(120)
    docs = documents(spark, data + rows()).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    training = toxicity.labelled(docs, marks)
    whole, parted = (toxicity.fit(training, n_rows=120, part_events=n) for n in (1 << 22, 500))
    assert len(whole.parts) == 1 and len(parted.parts) > 3
    assert whole.weights == parted.weights
    a, b = (sorted((str(r.doc_id), r.score) for r in toxicity.score(docs, m).collect()) for m in (whole, parted))
    assert a == b  # to the bit


# ---- secrets, long chains


def test_chains_of_constants_are_linear():
    """Doubling chains, appended literals and long texts: what they find, in time in proportion to the text."""
    import time

    chain = 'x0 = "aB3$"\n' + "".join(f"x{i + 1} = x{i} + x{i}\n" for i in range(200)) + "password_key = x200\n"
    found = secret_scan.lexed(chain)
    assert [(a, b) for a, b, _ in found] == [(6, 10)]
    text = 'x0 = "aB"\nx1 = x0 + x0\nx2 = x1 + x1 + "9$"\ntoken = x2 + "zz"'
    assert [text[a:b] for a, b, _ in secret_scan.lexed(text)] == ["aB", "9$", "zz"]

    def seconds(text):
        start = time.process_time()
        secret_scan.spans(text)
        return time.process_time() - start

    appended = lambda n: 'token = "q1"\n' + 'token = token + "aB3$x9"\n' * n
    text = appended(2000)
    assert len(secret_scan.lexed(text)) == 2001
    for make, n in ((appended, 20_000), (lambda n: "key = 1\n" + "a = b; " * n, 100_000), (lambda n: "secret: " + '"k", ' * n, 100_000), (lambda n: 'password = "Zx81kLmn2Qp"; h="0123456789abcdef01234567"\n' * n, 8_000)):
        short, long = seconds(make(n)), seconds(make(4 * n))
        assert long < 8 * short + 0.5, (make(3), short, long)


def test_tokens_of_a_long_text_are_not_held():
    tokens = secret_scan.Tokens("a = b; " * 200_000)
    for i in range(0, 790_000):
        assert tokens[i + 3][0]
        tokens.forget(i - 1)
        assert len(tokens._held) < 5000


# ---- language


def test_codewords_are_far_apart():
    for n in (2, 3, 5, 6, 30, 120):
        code = langid.codewords(n)
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + 1000 * np.eye(n, dtype=int)
        assert len({tuple(x) for x in code}) == n and apart.min() >= (2 ** (n - 2) if n <= 5 else 10)


def test_languages(spark):
    rng = random.Random(2)
    sounds = {"xa": "an the er on re", "xb": "schu der ung keit ein", "xc": "ción que do de los", "xd": "eau oi la un è", "xe": "kaa ii tuu", "xf": "wo zh ji"}
    texts = []
    for i in range(900):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choices(sounds[lang].split(), k=rng.randint(1, 3))) for _ in range(rng.randint(4, 60)))
        texts.append((i, text, lang if rng.random() < 0.9 else None, "a", 0))
    truth = {r[0]: r[2] for r in texts}
    extra = [(5000, None, "xa", "a", 0), (5001, "123 $$ \n", "xa", "a", 0), (5002, "", None, "a", 0), (None, "an the er", "xa", "a", 0), (5003, sounds["xa"] + " " + sounds["xb"], None, "a", 0)]
    docs = documents(spark, texts + extra, **CLASHES)
    found = langid.identify(docs, langid.train(docs)).select("doc_id", "language.*", (langid.remainder("doc_id", 4) == 2).alias("held_out")).collect()
    right = [r.language == truth[r.doc_id] for r in found if r.held_out and truth.get(r.doc_id)]
    assert len(right) > 100 and np.mean(right) > 0.98
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].language == "und" and by_id[i].score == 0 for i in (5000, 5001, 5002))
    assert all(0 <= r.score <= 1 for r in found)


def test_few_languages(spark):
    one = documents(spark, [(i, "some words here", "en", "a", 0) for i in range(8)] + [(9, "12", "en", "a", 0)])
    assert {r.language.language for r in langid.identify(one, langid.train(one)).collect()} == {"en", "und"}
    none = documents(spark, [(i, "some words here", None, "a", 0) for i in range(8)])
    assert {r.language.language for r in langid.identify(none, langid.train(none)).collect()} == {"und"}
    assert langid.identify(empty(spark), langid.train(empty(spark))).count() == 0


def plain_margin(model, text):
    """The mean weight of each bit, by loops over the letters of one text."""
    data = b" " + "".join(c.lower() for c in text or "").encode() + b" "
    shown = bytes(c if c in b"abcdefghijklmnopqrstuvwxyz'" or c >= 128 else 32 for c in data)
    slots = []
    for at in range(len(shown)):
        if at >= 1 + langid.GRAM - 2 and (shown[at] != 32 or shown[at - 1] != 32):
            key = sum(shown[at - j] << 8 * j for j in range(langid.GRAM))
            slots.append((key * 0x9E3779B1 % 2**32) >> (32 - langid.SLOT_BITS))
    return slots, sum((model.weights[x] for x in slots), np.zeros(model.weights.shape[1])) / math.sqrt(len(slots) + 1)


def test_counts_weights_and_decoding_against_plain_python(spark):
    texts = [(i, x, y, "a", 0) for i, (x, y) in enumerate([("an", "xa"), ("the an", "xa"), ("die der ü", "xb"), ("de la", "xc"), ("n", "xb"), ("An'the!! on", "xc"), (None, "xa"), ("", "xb"), ("12", "xc"), ("zzzz", "xb")] * 3)]
    training = documents(spark, texts).repartition(3)
    model = langid.fit(training, n_rows=len(texts))
    counts = {}
    for _, x, y, *_ in texts:
        for slot in plain_margin(model, x)[0]:
            counts.setdefault(y, {}).setdefault(slot, 0)
            counts[y][slot] += 1
    assert {(r.lang, r.slot): r.n for r in langid.count_grams(training, "text", "lang").collect()} == {(y, s): n for y, own in counts.items() for s, n in own.items()}
    size = 1 << langid.SLOT_BITS
    p = {y: [(counts[y].get(s, 0) + langid.SMOOTHING) / (sum(counts[y].values()) + langid.SMOOTHING * size) for s in range(size)] for y in model.languages}
    for bit in range(model.code.shape[1]):
        on, off = ([y for y, word in zip(model.languages, model.code) if word[bit] == v] for v in (1, 0))
        for s in (plain_margin(model, "the an")[0] + [5]):
            assert np.isclose(model.weights[s, bit], math.log(np.mean([p[y][s] for y in on]) / np.mean([p[y][s] for y in off])), rtol=1e-4)
    found = model.predict(pd.Series([x for _, x, *_ in texts], dtype=object))
    for i, (_, x, *_) in enumerate(texts):
        margin = np.clip(plain_margin(model, x)[1], -30, 30)
        loss = [sum(r * math.log1p(math.exp(-m * (1 if b else -1))) for r, m, b in zip(model.reliability, margin, word)) for word in model.code]
        known = x is not None and any(map(str.isalpha, x))
        best = min(range(len(loss)), key=loss.__getitem__)
        share = 1 / sum(math.exp(loss[best] - z) for z in loss)
        assert found["language"][i] == (model.languages[best] if known else "und") and np.isclose(found["score"][i], share if known else 0.0)


def test_an_answer_does_not_depend_on_neighbours(spark, monkeypatch):
    training = documents(spark, [(i, x, y, "a", 0) for i, (x, y) in enumerate([("an the on", "en"), ("der die das", "de"), ("zz top", "de")] * 4)])
    model = langid.fit(training, n_rows=12)
    texts = ["an", "on", "zzzz", "n", "", "der an", "x" * 40, "the die das on an " * 9]
    alone = pd.concat([model.predict(pd.Series([x])) for x in texts], ignore_index=True)
    for order in (range(8), range(7, -1, -1), (2, 0, 1, 3, 4, 5, 6, 7)):
        together = model.predict(pd.Series([texts[i] for i in order]))
        assert together.equals(alone.iloc[list(order)].reset_index(drop=True))
    for size in (64, 16, 5):
        monkeypatch.setattr(langid, "CHUNK_BYTES", size)
        monkeypatch.setattr(langid, "tiles", lambda text, overlap, size=size: common.tiles(text, overlap, size))
        monkeypatch.setattr(langid, "chunks", lambda texts: [(i, i + 1) for i in range(len(texts))])
        tiled = model.predict(pd.Series(texts))
        assert list(tiled["language"]) == list(alone["language"]) and np.allclose(tiled["score"], alone["score"])


# ---- top-k


def vectors(n=900, d=10):
    rng = np.random.default_rng(9)
    center = rng.normal(size=(6, d))
    out = [(int(i), [float(np.float32(x)) for x in center[i % 6] + rng.normal(size=d) * 0.2]) for i in rng.permutation(n)]
    out += [(950 + i, out[0][1]) for i in range(8)]  # ties
    return out


def brute_top(data, k, every):
    scaled = [(i, [math.floor(256 * x) for x in v]) for i, v in data]
    out = []
    for n, (q, v) in enumerate(scaled):
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for m, (c, w) in enumerate(scaled) if m != n)[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("group, visits", [(1024, 256), (2, 1), (1024, 2)])
def test_top_k(spark, monkeypatch, group, visits):
    monkeypatch.setattr(topk, "SHARD", 150)
    monkeypatch.setattr(topk, "BLOCK", 20)
    monkeypatch.setattr(topk, "GROUP", group)
    monkeypatch.setattr(topk, "VISITS", visits)
    good = vectors()
    good += [good[5], good[5], (good[5][0], good[6][1]), (100, good[7][1]), (100, good[8][1])]  # ids that repeat, with one vector and with others
    odd = [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 10), (2150, [float("inf")] * 10), (None, [1.0] * 10), (2200, [])]
    df = spark.createDataFrame([(*r, "c") for r in good + odd], "vec_id long, embedding array<float>, score string").repartition(5)
    found = topk.top_k(df, k=5, every=50)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(good, 5, 50)
    few = spark.createDataFrame(good[:3] + [(50, [0.5] * 10)], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(few, k=5, every=50).collect()) == brute_top([*good[:3], (50, [0.5] * 10)], 5, 50)
    assert topk.top_k(few.limit(0)).count() == 0


def test_large_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "BLOCK", 8)
    rng = np.random.default_rng(3)
    data = [(i, [(1e7 if i % 3 else -1.0) * (-1) ** i, *[float(x) for x in rng.normal(size=3)]]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(tuple(r) for r in topk.top_k(df, k=5, every=50).collect()) == brute_top(data, 5, 50)
    huge = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(huge, k=5, every=50).orderBy("rank").collect()
    assert [(r.vec_id, r.score > 0) for r in got] == [(1, True), (3, True), (2, False)]  # clipped, not an error


def test_blocks_are_left_out():
    rng = np.random.default_rng(1)
    blocks = [(np.arange(20) + 20 * b, np.arange(20) + 20 * b, rng.integers(b, b + 3, (20, 8)).astype(np.int32)) for b in range(30)]
    low, high = (np.stack([f(v, axis=0) for *_, v in blocks]) for f in (np.min, np.max))
    queries = rng.integers(1, 5, (7, 8)).astype(np.int32)
    best = topk.Best(7, 5)
    scored = topk.search(best, np.full(7, -1), queries, blocks, low, high)
    assert scored < 7 * 30 / 4
    whole = queries.astype(int) @ np.concatenate([v for *_, v in blocks]).T
    assert np.array_equal(best.scores, -np.sort(-whole, axis=1)[:, :5])
