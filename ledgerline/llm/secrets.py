"""Secret scans by assignment-aware lexing.

Base spans are three fixed patterns.  The method then lexes assignments of
source and configuration syntax:

* ``name = literal``, ``name: literal``, ``name := literal``, ``name => literal``,
  with the name quoted or indexed, and typed declarations ``name: Type = literal``;
* literals in single, double, triple or back quotes, with prefixes (``b"..."``),
  bare words, and joins of them (``a + "b"``);
* indented blocks (``name: |``) and elements (``<name>literal</name>``).

A right-hand side may name constants.  They are followed back to the literals
they hold: the last definition before the use or, if there is none, the first
one after it.  Each literal is scored by how sensitive the name is that it ends
up in and how random the value looks; literals at or above ``MIN_SCORE`` become
spans of kind ``literal``.

Values are not written out: a constant keeps length, shares of characters and
the ends of its value, and refers to the constants it is made of, so that text
which doubles a constant again and again costs no more than other text.  Only
what ends up in a sensitive name is followed, each definition once.

Each text is lexed on its own in one pass; rows never meet, so skew cannot arise.

Defined results: a null or empty text has no spans; an empty table gives an
empty result; repeated rows give repeated results; ids may be null; very long
texts, names and runs of blanks are read whole in time linear in them; a
constant that is defined by itself alone is taken as a word; extra columns are
ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy from the left: the runs of 24 and more
KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGN, MIN_ACCESS = 6, 20

MIN_SCORE = 0.5
MASK = "[SECRET]"

# Parts of names and how sensitive a name with that part is.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "credential": 0.9, "credentials": 0.9,
             "auth": 0.6, "bearer": 0.8, "signingkey": 0.9, "encryptionkey": 0.9, "connectionstring": 0.7}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|none|null|true|false|todo|example\w*|change_?me|your[\w-]*)$")

# A run of name characters and what assigns to it; the runs are taken whole, so that none is tried from its middle.
_ASSIGNED = re.compile(r"""(?<![\w.$-])([\w.$-]++)["'`]?\]?[ \t]*+(:=|=>|=(?![=>~])|:(?![=:/]))""", re.ASCII)
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*+)(?:\s[^<>]*+)?>([^<>]++)</", re.ASCII)
_NOT_FIRST = "0123456789.-"  # characters that begin no name
_TYPE = re.compile(r"[ \t]*+[A-Za-z_&*][\w.<>\[\]|?&*]*+[ \t]*+=(?![=>~])", re.ASCII)
_BLOCK = re.compile(r"[ \t]*+[|>][+-]?[0-9]?[ \t]*+\r?\n")
_LINE = re.compile(r"([ \t]*+)([^\r\n]*+)\r?(?:\n|\Z)")
_STRING = re.compile(r'''[bBrRuUfF]{0,2}(?:"""(.*?)"""|\'\'\'(.*?)\'\'\'|"((?:[^"\\\n]|\\.)*+)"|\'((?:[^\'\\\n]|\\.)*+)\'|`([^`\n]*+)`)''', re.DOTALL)
_IDENT = re.compile(r"\$?\{?([A-Za-z_][\w.]*+)\}?(?![\w/+=@%-])", re.ASCII)
_CALL = re.compile(r"[A-Za-z_][\w.]*+\(", re.ASCII)
_BARE = re.compile(r"""[^\s,;"'`#(){}\[\]]+""")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*")
_BLANK = re.compile(r"[ \t]*+")
#: Values up to this length are kept as text beside their shares.
SHORT = 1000

Span = tuple[int, int, str]


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """The base spans (start, end, kind) and the places of the values in them."""
    spans: list[Span] = []
    values: list[tuple[int, int]] = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                spans.append((m.start(), m.end(), "assign"))
                values.append(m.span(2))
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    values += [(s, e) for s, e, kind in spans if kind != "assign"]
    return spans, values


@lru_cache(maxsize=100_000)
def sensitivity(name: str) -> float:
    """0 to 1: how much a target name promises a secret."""
    parts = [p for p in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()) if p]
    pairs = ["".join(x) for x in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


class Value(NamedTuple):
    """A value that may be longer than can be written down: its ends, the share of each character and, if short, the text."""
    length: float
    share: dict[str, float]
    text: str | None
    head: str
    tail: str


def literal(text: str) -> Value:
    share = {c: n / len(text) for c, n in Counter(text).items()}
    return Value(len(text), share, text if len(text) <= SHORT else None, text[:16], text[-2:])


def joined(parts: list[Value]) -> Value:
    if len(parts) == 1:
        return parts[0]
    total = sum(v.length for v in parts)
    share: dict[str, float] = {}
    for v in parts:
        for c, s in v.share.items():
            share[c] = share.get(c, 0.0) + s * v.length / total
    text = "".join(v.text for v in parts) if total <= SHORT else None
    head = tail = ""
    for v in parts:
        head += v.head if len(head) < 16 else ""
        if v.length < 16 and len(head) < 16:
            continue
        break
    for v in reversed(parts):
        tail = v.tail + tail if len(tail) < 2 else tail
    return Value(min(total, 1e200), share, text, head[:16], tail[-2:])


def _placeholder(v: Value) -> bool:
    if v.text is not None:
        return bool(PLACEHOLDER.match(v.text))
    if v.share.keys() <= {"x", "X"} or v.share.keys() in ({"*"}, {"."}):
        return True
    if v.head[0] == "<" and v.tail[-1] == ">" or v.head.startswith("${") and v.tail[-1] == "}" or v.head.startswith("{{") and v.tail == "}}":
        return True
    start = v.head.lower()
    return (start.startswith(("example", "your")) and all(c.isalnum() or c == "_" or c == "-" and start[0] == "y" for c in v.share))


def score(name: str, v: Value) -> float:
    """Sensitivity of the name, scaled by the entropy of the value; 0 for placeholders and short values."""
    if v.length < MIN_ASSIGN or any(c.isspace() for c in v.share) or _placeholder(v):
        return 0.0
    return sensitivity(name) * min(1.0, 0.4 - sum(s * math.log2(s) for s in v.share.values() if s) / 5)


def literal_score(name: str, value: str) -> float:
    return score(name, literal(value)) if value else 0.0


class Part(NamedTuple):
    """A literal's place, or that of a word that may name a constant."""
    start: int
    end: int
    name: str | None = None


def _expression(text: str, at: int) -> tuple[list[Part], int, bool]:
    """The parts of the expression at ``at``, where it ends, and whether it begins with a quote."""
    parts: list[Part] = []
    quoted = False
    while True:
        at = _BLANK.match(text, at).end()
        if m := _STRING.match(text, at):
            parts.append(Part(*m.span(m.lastindex)))
            quoted = quoted or len(parts) == 1
        elif _CALL.match(text, at):
            return parts, at, quoted
        elif m := _IDENT.match(text, at):
            parts.append(Part(*m.span(), m[1]))
        elif m := _BARE.match(text, at):
            parts.append(Part(*m.span()))
        else:
            return parts, at, quoted
        at = m.end()
        following = _JOIN.match(text, at)
        if not following:
            return parts, at, quoted
        at = following.end()


def _indented(text: str, start: int, at: int) -> tuple[list[Part], int]:
    """The lines from ``at`` on that are indented deeper than the line of ``start``."""
    line = text.rfind("\n", 0, start) + 1
    depth = _BLANK.match(text, line).end() - line
    parts: list[Part] = []
    while at < len(text):
        m = _LINE.match(text, at)
        if m[2].strip():
            if len(m[1]) <= depth:
                break
            parts.append(Part(m.start(2), m.start(2) + len(m[2].rstrip())))
        at = m.end()
    return parts, at


def assignments(text: str) -> list[tuple[str, list[Part]]]:
    """(name, parts) of every assignment, in order."""
    found: list[tuple[int, str, list[Part]]] = []
    done = 0
    for m in _ASSIGNED.finditer(text):
        name, start = m[1].lstrip(_NOT_FIRST), m.end()
        if m.start(2) < done or not name:  # inside a literal that was read
            continue
        if m[2] == ":":
            if t := _TYPE.match(text, start):
                start = t.end()
            elif t := _BLOCK.match(text, start):
                parts, done = _indented(text, m.start(), t.end())
                found.append((m.start(), name, parts))
                continue
        parts, end, quoted = _expression(text, start)
        done = end if quoted else start
        found.append((m.start(), name, parts))
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            lead = len(m[2]) - len(m[2].lstrip())
            found.append((m.start(), m[1], [Part(m.start(2) + lead, m.start(2) + len(m[2].rstrip()))] if m[2].strip() else []))
        found.sort(key=lambda x: x[0])
    return [(name, [p for p in parts if p.start < p.end]) for _, name, parts in found if parts]


def literal_spans(text: str) -> list[Span]:
    """Literals that end up in a sensitive name, directly or through constants."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    known = assignments(text)
    first: dict[str, int] = {}
    for i, (name, _) in enumerate(known):
        first.setdefault(name, i)
    latest: dict[str, int] = {}
    meant: list[list[int | None]] = []  # of each part the definition that its name stands for
    for i, (name, parts) in enumerate(known):
        use = [None if p.name is None else latest.get(p.name, first.get(p.name)) for p in parts]
        meant.append([None if d == i else d for d in use])
        latest[name] = i

    values: dict[int, Value] = {}

    def evaluate(target: int) -> Value:
        open_, stack = set(), [target]
        while stack:
            i = stack[-1]
            if i in values:
                stack.pop()
                continue
            needed = [d for d in meant[i] if d is not None and d not in values]
            if i not in open_:
                open_.add(i)
                waiting = [d for d in needed if d not in open_]
                meant[i] = [None if d in open_ and d not in values else d for d in meant[i]]  # a circle ends here
                stack += waiting
                if waiting:
                    continue
            else:
                meant[i] = [None if d in needed else d for d in meant[i]]
            values[i] = joined([literal(text[p.start:p.end]) if d is None else values[d] for p, d in zip(known[i][1], meant[i])])
            stack.pop()
        return values[target]

    spans: set[tuple[int, int]] = set()
    listed: set[int] = set()
    for i, (name, _) in enumerate(known):
        if not sensitivity(name) or score(name, evaluate(i)) < MIN_SCORE:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j in listed:
                continue
            listed.add(j)
            for p, d in zip(known[j][1], meant[j]):
                if d is None:
                    spans.add((p.start, p.end))
                else:
                    todo.append(d)
    return [(s, e, "literal") for s, e in spans]


def _line(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of the base spans and all spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in b.column(1):
                t = text.as_py() or ""
                base, _ = base_spans(t)
                n = Counter(k for _, _, k in base)
                for k in KINDS[:3]:
                    out[f"n_{k}"].append(n[k])
                out["base_sha256"].append(hashlib.sha256(_line(base).encode()).hexdigest())
                out["spans"].append(_line(base + literal_spans(t)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array(v, pa.int64() if k[0] == "n" else pa.string()) for k, v in out.items()],
                names=["doc_id", *out])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _masked(text: str) -> str:
    places = base_spans(text)[1] + [(s, e) for s, e, _ in literal_spans(text)]
    out, at = [], 0
    merged: list[list[int]] = []
    for s, e in sorted(places):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], MASK]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret value replaced by a mask; all columns stay, ``n_chars`` follows the text."""
    schema, k = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t.as_py() is None else _masked(t.as_py()) for t in b.column(k)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == k else c for i, c in enumerate(b.columns)],
                                             names=b.schema.names)
    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
