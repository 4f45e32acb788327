"""Secrets in text: fixed patterns, and assignments read by a small lexer.

The base patterns are those of the contract.  The lexer reads source and
configuration syntax (``name = "literal"``, ``name: literal``, ``"name":
"literal"``, ``name := 'literal'``, ``x["name"] = "literal"``, ``name: type =
"literal"``, ``name string = "literal"``, ``name[] = "literal"``,
concatenations) into pairs of a target name and a literal.  Constants are carried forward: a literal that is given to
a harmless name and from there to a sensitive one is found where it stands.  A
literal's score is the sensitivity of the target's name times how much the
literal looks like a secret (variety of characters, no placeholder).  Several
words count as a passphrase unless they read like a message; the target of a
name that ends in "passphrase" may hold any words.

Scale: one pass over whole texts, no shuffle.  The lexer runs only on texts
in which a sensitive word has an assignment sign somewhere after it in its
line, which all that it can find has.  It reads tokens as a stream and holds a
few at a time.  A constant is its parts, each a literal or another constant,
so chains of constants take no more room or time than their text: what a
sensitive name was given is passed down to the literals once, at the end.  A
value is judged by its first ``JUDGED`` characters.  Time is linear in the text.

Cases: a null text counts as empty and has no span; positions are code points
of the whole text, ends exclusive; rows are independent, so repeats and null
ids don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import col

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 0.5
MIN_LITERAL = 6
#: Characters by which a literal, or what several are joined to, is judged.
JUDGED = 4096

# The contract's patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs end where they end: the same spans as dropping shorter runs
_ASSIGN_HINT = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", re.IGNORECASE | re.ASCII)

#: Sensitivity of the parts of a target's name.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "authorization": 0.7, "key": 0.5, "pin": 0.4, "salt": 0.5, "signature": 0.5,
}
#: Parts that make "key" (or "auth") a secret one.
STRENGTHEN = {"api", "access", "private", "secret", "signing", "encryption", "account", "storage", "client", "master"}
#: From a sensitive word to the next sign, or to the end of the line: matches don't overlap, so all of them take one pass.
_SENSITIVE_HINT = re.compile(r"(?:pass|pwd|secret|token|key|credential|bearer|auth|salt|signature|pin)[^\n:=]*+(?P<sign>[:=])?", re.IGNORECASE)
_PLACEHOLDER = re.compile(r"example|sample|change.?me|placeholder|your[_\-.]|dummy|redacted|xxxx|\*\*\*|\.\.\.|^[<{$%]|^(?:true|false|none|null|undefined|password|secret|token)$", re.IGNORECASE)
#: Words of messages and labels, and ends of sentences: not a passphrase.
_MESSAGE = re.compile(
    r"\b(?:the|an?|is|are|was|be|to|of|in|on|at|for|from|with|and|or|not|no|this|that|it|has|have|you|your|please|enter|type|choose|must|should|can|cannot|"
    r"forgot(?:ten)?|reset|change|confirm|repeat|new|old|invalid|incorrect|wrong|missing|required|expired|password|passphrase|secret|token|key|field|value)\b|[.?:,;]\s|[.?:]$",
    re.IGNORECASE,
)
#: A string in these quotes; if nothing closes it, the rest of its line, and an empty group.
_STRINGS = {'"': r'"(?:[^"\\\n]|\\.)*+(?:"|(?P<open_double>))', "'": r"(?<!\w)'(?:[^'\\\n]|\\.)*+(?:'|(?P<open_single>))"}


def _lexer(quotes: str) -> re.Pattern:
    """Tokens, with strings in these quotes (and between backquotes)."""
    return re.compile(
        rf"(?P<string>{'|'.join([*[_STRINGS[q] for q in quotes], r'`[^`\n]*`'])})"
        r"|(?P<name>[A-Za-z_$][\w$]*(?:[.\-][\w$]+)*)"
        r"|(?P<bare>[0-9][\w+/=.\-]*)"
        r"|(?P<sign>:=|=>|[=!<>]=|=|:|\+|\()"
        r"|(?P<line>\n|;)"
        r"|(?P<other>[^\s])"
    )


_LEXERS = {quotes: _lexer(quotes) for quotes in ("\"'", '"', "'", "")}
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.\-]*\Z")
_SIGNS = ("=", ":", ":=", "=>")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@functools.lru_cache(maxsize=4096)
def sensitivity(name: str) -> float:
    """0 to 1: how likely a literal given to this name is a secret."""
    parts = [x.lower() for x in _PARTS.findall(name)]
    best = max((SENSITIVE.get(x, 0.0) for x in parts), default=0.0)
    joined = "".join(parts)
    if "apikey" in joined or "privatekey" in joined or "accesskey" in joined:
        return 1.0
    return 1.0 if best and STRENGTHEN & set(parts) else best


def secrecy(literal: str, phrase: bool = False) -> float:
    """0 to 1: how much a literal looks like a secret; ``phrase``: words of any kind are expected."""
    if len(literal) < MIN_LITERAL or _PLACEHOLDER.search(literal):
        return 0.0
    words = literal.split()
    if not words or len(words) > 1 and not phrase and _MESSAGE.search(literal):
        return 0.0
    if len(words) == 1 and len(words[0]) < len(literal):
        return 0.0  # white space around one word
    n = len(literal)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(literal).values())
    kinds = sum(any(t(c) for c in literal) for t in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, entropy / 3.5) * (0.55 if kinds == 1 else 1.0 if len(words) == 1 else 0.8)


Token = tuple[str, str, int, int]
_END: Token = ("", "", 0, 0)


class Tokens:
    """The tokens of a text by number: (kind, word, start, end).  Those before ``forget`` are gone, those ahead are read when asked for."""

    def __init__(self, text: str):
        self._source = self._read(text)
        self._held: list[Token] = []
        self._first = 0

    @staticmethod
    def _read(text: str) -> Iterator[Token]:
        """A quote that nothing closes is a character; so are, without a look, those of its kind up to the end of its line, all escaped."""
        at, dead = 0, {'"': 0, "'": 0}
        while m := _LEXERS["".join(q for q in "\"'" if dead[q] <= at)].search(text, at):
            kind, start, end = m.lastgroup, m.start(), m.end()
            if kind == "string" and any(m[x] is not None for x in m.re.groupindex if x.startswith("open")):
                dead[text[start]] = end
                kind, end = "other", start + 1
            yield kind, text[start:end], start, end
            at = end

    def __getitem__(self, i: int) -> Token:
        while i - self._first >= len(self._held):
            token = next(self._source, None)
            if token is None:
                return _END
            self._held.append(token)
        return self._held[i - self._first] if i >= self._first else _END

    def forget(self, before: int) -> None:
        if before - self._first > 4096:
            del self._held[: before - self._first]
            self._first = before


def typed(tokens: Tokens, at: int) -> int:
    """Where the sign stands that ends a type which starts here (``str =``, ``Optional[str] =``, ``&str =``); 0: no such type."""
    depth, before, j = 0, "", at
    while True:
        kind, word = tokens[j][:2]
        if word == "=" and not depth:
            return j if before and j > at else 0
        if word in ("[", "<"):
            depth += 1
        elif word in ("]", ">"):
            depth -= 1
        elif kind == "name":
            if before == "name" and not depth:
                return 0
        elif not (word in ("|", "?", "&", "*") or depth > 0 and (kind in ("string", "bare") or word == ",")):
            return 0
        if depth < 0:
            return 0
        before, j = kind, j + 1


def assigned(tokens: Tokens, i: int) -> tuple[list[str], int]:
    """Names that the token here gives to an assignment, the target first, and where its expression starts (0: there is none)."""

    def word(j: int) -> str:
        return tokens[j][1]

    kind, name = tokens[i][:2]
    target = name if kind == "name" else name[1:-1] if kind == "string" else ""
    if not target or not _IDENTIFIER.match(target):
        return [], 0
    if i and word(i - 1) == "[" and word(i + 1) == "]" and word(i + 2) in _SIGNS:
        return [target], i + 3
    if kind == "name" and word(i + 1) == "[":
        end = i + 2 + (tokens[i + 2][0] == "bare")
        return ([target], end + 2) if word(end) == "]" and word(end + 1) == "=" else ([], 0)
    if word(i + 1) not in _SIGNS:
        return [], 0
    if word(i + 1) == ":" and (sign := typed(tokens, i + 2)):
        return [target, *[tokens[j][1] for j in range(i + 2, sign) if tokens[j][0] == "name"]], sign + 1
    if kind == "name" and i and tokens[i - 1][0] == "name" and target in ("string", "str", "String"):
        return [word(i - 1), target], i + 2
    return [target], i + 2


class Value:
    """What an expression comes to: its parts (literals as (start, end), or values), and its first characters."""

    __slots__ = ("head", "parts", "score", "_rated")

    def __init__(self, parts: list[tuple[int, int] | Value], heads: list[str]):
        self.parts, self.score = parts, 0.0
        first = parts[0]
        if isinstance(first, Value) and (len(first.head) >= JUDGED or len(parts) == 1):
            self.head, self._rated = first.head, first._rated  # judged already, or to be judged once for both
        else:
            self.head, self._rated = "".join(heads)[:JUDGED], {}

    def secrecy(self, phrase: bool) -> float:
        if phrase not in self._rated:
            self._rated[phrase] = secrecy(self.head, phrase)
        return self._rated[phrase]


def lexed(text: str) -> list[tuple[int, int, float]]:
    """Literals (start, end, score) whose target names are sensitive enough."""
    tokens = Tokens(text)
    constants: dict[str, Value] = {}
    values: list[Value] = []
    i = 0
    while tokens[i + 2][0]:
        tokens.forget(i - 1)
        names, j = assigned(tokens, i)
        if not j:
            i += 1
            continue
        # the expression: literals and names joined by plus signs
        parts: list[tuple[int, int] | Value] = []
        heads: list[str] = []
        room = JUDGED
        while tokens[j][0]:
            kind, word, start, end = tokens[j]
            after = tokens[j + 1][1]
            if kind == "string":
                part, head = (start + 1, end - 1), word[1:-1]
            elif kind == "name" and after == "(":
                break  # a call: its result isn't known
            elif kind == "name" and word in constants:
                part = constants[word]
                head = part.head
            elif kind == "bare" or kind == "name" and any(c.isdigit() for c in word):
                part, head = (start, end), word
            else:
                break
            parts.append(part)
            if room > 0:
                heads.append(head[:room])
                room -= len(head)
            j += 1
            if after != "+":
                break
            j += 1
        if parts:
            value = constants[names[0]] = Value(parts, heads)
            values.append(value)
            if weight := max(map(sensitivity, names)):
                score = weight * value.secrecy(any(x.lower().endswith("passphrase") for x in names))
                value.score = score if score >= THRESHOLD else 0.0
        i = max(j, i + 1) if parts else i + 1
    found: dict[tuple[int, int], float] = {}
    for value in reversed(values):  # a value's parts are older than it
        if value.score:
            for part in value.parts:
                if isinstance(part, Value):
                    part.score = max(part.score, value.score)
                elif part[1] > part[0]:
                    found[part] = max(value.score, found.get(part, 0.0))
    return [(a, b, s) for (a, b), s in sorted(found.items())]


def spans(text: str) -> list[tuple[int, int, str, float]]:
    """All spans (start, end, kind, score) of a text, by start, then kind as listed."""
    out = []
    if _ASSIGN_HINT.search(text):
        out += [(m.start(), m.end(), "assign", 1.0) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex", 1.0) for m in _HEX.finditer(text)]
    if ("=" in text or ":" in text) and any(m["sign"] for m in _SENSITIVE_HINT.finditer(text)):
        known = sorted(x[:2] for x in out)
        starts, reach = [a for a, _ in known], list(accumulate((b for _, b in known), max))
        out += [(a, b, "lexed", s) for a, b, s in lexed(text) if not (n := bisect_right(starts, a)) or reach[n - 1] < b]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan(documents: DataFrame, *, text: str = "text", name: str = "spans") -> DataFrame:
    """All rows and columns, with the spans of the text in a column ``name`` (in place of one of that name): array of (start, end, kind, score)."""

    @F.pandas_udf("array<struct<start:long,end:long,kind:string,score:double>>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("start", "end", "kind", "score"), x)) for x in spans(t or "")] for t in texts], dtype=object)

    return documents.withColumn(name, of(col(text)))


def listed(found: str | Column, kinds: tuple[str, ...]) -> Column:
    """Spans of these kinds as text: kind:start:end, comma-joined, in the order of the array."""
    wanted = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def counted(found: str | Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def masked(documents: DataFrame, *, text: str = "text", found: str = "spans", mark: str = "[secret]") -> DataFrame:
    """The rows with every span of the text replaced by a mark; overlapping spans share one."""

    @F.pandas_udf("string")
    def of(texts: pd.Series, rows: pd.Series) -> pd.Series:
        out = []
        for whole, own in zip(texts, rows):
            if whole is None or own is None or not len(own):
                out.append(whole)
                continue
            parts, at = [], 0
            for x in own:
                if x["start"] >= at:
                    parts += [whole[at : x["start"]], mark]
                at = max(at, x["end"])
            out.append("".join([*parts, whole[at:]]))
        return pd.Series(out, dtype=object)

    return documents.withColumn(text, of(col(text), col(found)))
