"""Secret scan: fixed patterns, and literals assigned to sensitive names.

Patterns find passwords and tokens that are written next to their name, access keys and hexadecimal runs. Beside them
a small lexer reads source and configuration syntax: for every assignment operator it takes the target name before it
and the expression behind it. An expression is a literal, a name that an earlier assignment of the same text gave a
value (constants are propagated), or a sum of these. The literals of an expression are scored by how sensitive the
target name is and by how much they look like a secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lapstar.llm.common import map_strings, texts_of

Span = tuple[str, int, int]

# The patterns, their least lengths and the order of their kinds.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16


def _either_case(pattern: str) -> str:
    """ASCII letters in either case, and no others (the flag would also take a long s)."""
    return re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", pattern)


ASSIGN = re.compile(
    "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile(f"[0-9a-f]{{{HEX_LEAST},}}")

OPERATOR = re.compile(r":=|=>|(?<![=!<>~])=(?![=~])|(?<!:):(?![:/])")
LITERAL = re.compile(r'"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\'|`([^`\n]*)`')
BARE = re.compile(r"""[^\s,;"'`(){}\[\]<>]+""")
NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.\-][A-Za-z0-9_$]+)*")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|change.?me|(?:example|your)(?:[-_. ][a-z]+)*|none|null|true|false|test|todo|<.*>|\[.*\]|\$\{.*\}|\{\{.*\}\})$"
)
NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_$.-")

SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "pass": 0.8, "pin": 0.5,
    "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.4, "signing": 0.5, "encryption": 0.5, "client": 0.1,
    "session": 0.4, "cookie": 0.4, "dsn": 0.6, "salt": 0.5,
}
LEAST_LENGTH = 8
THRESHOLD = 0.5
# A quoted literal of blanks or few letters counts less, and only for names that leave no doubt.
CERTAIN, LEAST_QUOTED, DOUBT = 0.9, 5, 0.7


@dataclass(frozen=True)
class Pair:
    """A target name with the value of its expression and the literals that make it up."""

    name: str
    value: str
    spans: tuple[tuple[int, int], ...]
    quoted: bool = True


def _target(text: str, at: int) -> str:
    """The name that ends before position ``at``; of ``name: type`` the name."""
    while at and text[at - 1] in " \t":
        at -= 1
    if at and text[at - 1] in "\"'`]":
        at -= 1
        if at and text[at - 1] in "\"'":
            at -= 1
    begin = at
    while begin and text[begin - 1] in NAME_CHARS:
        begin -= 1
    return text[begin:at].strip(".-")


def _expression(text: str, at: int, known: dict[str, Pair]) -> tuple[str, tuple[tuple[int, int], ...], bool] | None:
    """Value and literals of the expression at ``at``, and whether all are quoted; None if it is none of literals and
    known names."""
    value, spans, quoted, n = [], [], True, len(text)
    while True:
        while at < n and text[at] in " \t":
            at += 1
        if found := LITERAL.match(text, at):
            group = found.lastindex
            value.append(found[group])
            spans.append(found.span(group))
            at = found.end()
        elif found := BARE.match(text, at):
            word = found[0].rstrip(".")
            name = word.split("+")[0]
            if name in known:
                value.append(known[name].value)
                spans.extend(known[name].spans)
                quoted = quoted and known[name].quoted
                at = found.start() + len(name)
            elif not value:
                return (word, ((found.start(), found.start() + len(word)),), False) if word else None
            else:
                return None
        else:
            return None
        while at < n and text[at] in " \t":
            at += 1
        if at < n and text[at] == "+":
            at += 1
        else:
            return "".join(value), tuple(spans), quoted


def pairs(text: str) -> Iterator[Pair]:
    """Name-literal pairs in the order of the text, with constants propagated."""
    known: dict[str, Pair] = {}
    annotated, annotated_at = "", 0
    behind = 0  # operators inside a literal that has been read are no operators
    for operator in OPERATOR.finditer(text):
        if operator.start() < behind:
            continue
        name = _target(text, operator.start())
        if operator[0] == "=" and annotated and text[annotated_at : operator.start()].strip(" \t") == name:
            name = annotated  # "name: type = literal"
        annotated, annotated_at = (name, operator.end()) if operator[0] == ":" else ("", 0)
        if not name:
            continue
        found = _expression(text, operator.end(), known)
        if found is None:
            known.pop(name, None)
            continue
        pair = Pair(name, *found)
        known[name] = pair
        own = [end for begin, end in pair.spans if begin >= operator.end()]
        if own and text[own[-1] : own[-1] + 1] in ('"', "'", "`"):
            behind = own[-1] + 1
        yield pair


def name_score(name: str) -> float:
    """How sensitive a target name is: the sum of its parts, 1 at most."""
    parts = [x.lower() for x in PARTS.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return min(1.0, sum(SENSITIVE.get(x, 0.0) for x in [*parts, *joined]))


def value_score(value: str, certain: bool = False) -> float:
    """How much a literal looks like a secret: length, entropy of its letters, and kinds of letters.

    With blanks or few letters it only does if it is quoted and its name is ``certain`` to be a secret's, and then less.
    """
    if PLACEHOLDER.match(value.strip()):
        return 0.0
    if len(value) < LEAST_LENGTH or any(x.isspace() for x in value):
        if not certain or len(value.strip()) < LEAST_QUOTED:
            return 0.0
        return DOUBT * _letters_score(value)
    return _letters_score(value)


def _letters_score(value: str) -> float:
    entropy = -sum(k / len(value) * math.log2(k / len(value)) for k in Counter(value).values())
    kinds = sum((any(x.isdigit() for x in value), any(x.islower() for x in value), any(x.isupper() for x in value),
                 any(not x.isalnum() for x in value)))
    return min(1.0, entropy / 3.0) * (1.0 if kinds > 1 else 0.5)


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns, by start and then by kind."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def literal_spans(text: str) -> list[Span]:
    """Literals whose score, name times value, reaches the threshold."""
    found = set()
    if "=" in text or ":" in text:
        for pair in pairs(text):
            weight = name_score(pair.name)
            if weight and weight * value_score(pair.value, pair.quoted and weight >= CERTAIN) >= THRESHOLD:
                found |= {("literal", *span) for span in pair.spans if span[1] > span[0]}
    return sorted(found, key=lambda x: x[1:])


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The patterns' spans; and these with the literals that none of them holds."""
    base = base_spans(text)
    more = [x for x in literal_spans(text) if not any(b <= x[1] and x[2] <= e for _, b, e in base)]
    return base, sorted([*base, *more], key=lambda x: (x[1], KINDS.index(x[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with each run of covered letters replaced by the mark."""
    out, at = [], 0
    spans = sorted((b, e) for _, b, e in all_spans(text)[1])
    while spans:
        begin, end = spans.pop(0)
        while spans and spans[0][0] <= end:
            end = max(end, spans.pop(0)[1])
        out += [text[at:begin], mark]
        at = end
    return "".join(out) + text[at:]


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts by kind, digest of the patterns' spans, all spans.

    Positions are code points, ends exclusive. Null and empty texts have no spans; the digest is then that of the
    empty string. Repeated rows are scanned each. Columns other than ``doc_id`` and the text are left out.
    """

    def find(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {x: [] for x in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in texts:
            base, spans = all_spans(text)
            kinds = Counter(x[0] for x in base)
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(kinds[kind])
            out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            out["spans"].append(written(spans))
        return out

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_strings(texts_of(docs, text_col=text_col), find, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with their secrets replaced by ``mark`` and ``n_chars`` brought in line; no row goes.

    A null text stays null. Every other column is kept as it is.
    """

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else redacted(x, mark) for x in batch.column("text").to_pylist()]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                own = columns["n_chars"]
                counted = pa.array([None if x is None else len(x) for x in texts], pa.int64()).cast(own.type)
                columns["n_chars"] = pc.coalesce(counted, own)
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(clean, docs.schema)
