"""Small fixtures: documents with nulls, copies, long texts, repeated rows and clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an the er on re ed tion ing ha st le ou wh ble".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(n)]
    out = []
    for i, text in enumerate(texts):
        if i % 10 == 3:
            text = texts[i - 3].replace(" ", "\n\t", 2) + "  "  # an exact copy but for white space
        if i % 10 == 5:
            words = texts[i - 1].split()
            text = " ".join([*words[:-1], "changed"])  # a near copy
        if i % 10 == 7:
            text = text + "\nA line that many of the documents share, in full.\nshort"
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "hot", "hot", "hot", None]), len(text)))
    out += [
        (1000, None, None, None, None), (1001, "", "en", "a", 0), (1002, " \t\r\n", "en", "b", 4), (None, "no id here at all", "en", "a", 17),
        (1003, prose(rng, 9000), "en", "hot", None), (1004, "one", "en", "b", 3), (1004, "one", "en", "b", 3), (1005, "ONE", "de", "b", 3),
        (1006, "x" * 70_000, "en", "a", 70_000), (1007, "$$$ 123 !!", "en", "b", 10), (None, None, None, None, None),
    ]
    return out


def documents(spark, data: list[tuple] | None = None, **extra):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


#: Extra columns with names that operators use inside or return.
CLASHES = dict(score=7.5, kept="k", component_id="c", taken="t", size="s", spans="x", _salt="q", _row="r")
WHITE = " \t\n\x0b\x0c\r"


def words(text: str | None) -> list[str]:
    for c in WHITE:
        text = (text or "").replace(c, " ")
    return [x for x in text.split(" ") if x]


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


class Groups:
    """Union-find over hashable nodes."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        self.parent[self.find(a)] = self.find(b)
