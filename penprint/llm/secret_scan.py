"""Secrets in texts: a trigram index narrows each rule down before its pattern runs.

From the parse tree of a rule's pattern follows a Boolean query of trigrams that every
match must contain (ands of ors). For each segment of documents the postings of those
trigrams are built from the raw bytes; the query of a rule intersects and unites them,
and the pattern is run on the candidates that remain. A rule whose pattern requires no
trigram scans all documents.

Segments are slices of the Arrow batches of a task; nothing is shuffled. Trigrams are
taken from the text with A-Z in lower case, so rules in either case share them.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from re import _constants as sre
from re import _parser as sre_parse

from penprint.llm.common import joined_bytes, slices

SEGMENT_BYTES = 4 << 20
_MOST_STRINGS = 64
_MOST_CLASS = 4


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and what a match must meet besides."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group


# The first three are the base rules; their order is that of the result.
RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # a run of hexadecimal digits of 16 and more is the whole of its maximal run
    Rule("hex", r"[0-9a-f]{16,}", least=16),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")


# --- queries from patterns --------------------------------------------------

# A query is True (no condition), a trigram (3 bytes), or ("and" | "or", queries).


def _both(*queries):
    parts = [q for q in queries if q is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(queries):
    queries = list(dict.fromkeys(queries))
    if not queries or True in queries:
        return True
    return queries[0] if len(queries) == 1 else ("or", tuple(queries))


def _strings_query(strings: set[bytes]):
    """Condition that one of the strings occurs."""
    return _any(
        _both(*dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2))) if len(s) >= 3 else True for s in sorted(strings)
    )


def _class_strings(items) -> set[bytes] | None:
    """The characters of a class in lower case, if there are few."""
    found: set[bytes] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(chr(value).encode().lower())
        elif kind is sre.RANGE and value[1] - value[0] < _MOST_CLASS:
            found.update(chr(c).encode().lower() for c in range(value[0], value[1] + 1))
        else:
            return None
        if len(found) > _MOST_CLASS:
            return None
    return found


def _node(kind, value) -> tuple[set[bytes] | None, object]:
    """All strings that a node of the parse tree can match, if they are few, and its query otherwise."""
    if kind is sre.LITERAL:
        return {chr(value).encode().lower()}, True
    if kind is sre.IN:
        return _class_strings(value), True
    if kind is sre.AT or kind in (sre.ASSERT, sre.ASSERT_NOT):
        return {b""}, True
    if kind is sre.SUBPATTERN:
        return _sequence(value[-1])
    if kind is sre.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        strings: set[bytes] | None = set()
        for own, _ in parts:
            strings = strings | own if strings is not None and own is not None else None
        if strings is not None and len(strings) <= _MOST_STRINGS:
            return strings, True
        return None, _any(_both(query, _strings_query(own) if own is not None else True) for own, query in parts)
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, inner = value
        own, query = _sequence(inner)
        if least == 0:
            return (own | {b""} if most == 1 and own is not None else None), True
        if most == 1 or least == most == 1:
            return own, query
        return None, _both(query, _strings_query(own) if own is not None else True)
    return None, True


def _sequence(nodes) -> tuple[set[bytes] | None, object]:
    """As ``_node`` for nodes that follow each other."""
    strings: set[bytes] = {b""}
    query, whole = True, True
    for kind, value in nodes:
        own, inner = _node(kind, value)
        if own is not None and len(strings) * len(own) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in own}
            query = _both(query, inner)
            continue
        whole = False
        query = _both(query, _strings_query(strings), inner, _strings_query(own) if own is not None else True)
        strings = {b""}
    if whole:
        return strings, query
    return None, _both(query, _strings_query(strings))


def trigram_query(pattern: str):
    """Trigrams, in lower case, that every match of a pattern contains. Case-insensitive flags are not used."""
    strings, query = _sequence(sre_parse.parse(pattern))
    return _both(query, _strings_query(strings)) if strings is not None else query


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


# --- postings ---------------------------------------------------------------


class TrigramTable:
    """Finds the trigrams of some queries in bytes."""

    def __init__(self, trigrams: set[bytes]):
        self.number = {t: k for k, t in enumerate(sorted(trigrams))}
        letters = sorted({b for t in trigrams for b in t})
        self.letter = np.zeros(256, np.int32)
        for k, b in enumerate(letters, 1):
            self.letter[b] = k
            if 97 <= b <= 122:
                self.letter[b - 32] = k
        self.base = len(letters) + 1
        self.lookup = np.full(self.base**3, -1, np.int32)
        for t, k in self.number.items():
            a, b, c = (int(self.letter[x]) for x in t)
            self.lookup[(a * self.base + b) * self.base + c] = k

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """Documents, in order, that contain each trigram."""
        empty = np.zeros(0, np.int64)
        if len(data) < 3 or not self.number:
            return dict.fromkeys(self.number, empty)
        own = self.letter[data]
        code = (own[:-2] * self.base + own[1:-1]) * self.base + own[2:]
        found = self.lookup[code]
        place = np.flatnonzero(found >= 0)
        doc = np.searchsorted(offsets, place, side="right") - 1
        inside = place + 3 <= offsets[doc + 1]
        pairs = np.unique(found[place[inside]].astype(np.int64) * (len(offsets) + 1) + doc[inside])
        number, doc = np.divmod(pairs, len(offsets) + 1)
        edges = np.searchsorted(number, np.arange(len(self.number) + 1))
        return {t: doc[edges[k] : edges[k + 1]] for t, k in self.number.items()}


def candidates(query, postings: dict[bytes, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """Documents that meet a query."""
    if query is True:
        return everything
    if isinstance(query, bytes):
        return postings[query]
    parts = [candidates(q, postings, everything) for q in query[1]]
    if query[0] == "and":
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))
    return reduce(np.union1d, parts)


class Scanner:
    """All rules with their queries and postings."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern), trigram_query(r.pattern)) for r in rules]
        self.table = TrigramTable(set().union(*[trigrams_of(q) for _, _, q in self.rules]))

    def segment(self, data: np.ndarray, offsets: np.ndarray, text: Callable[[int], str]) -> list[list[tuple]]:
        """(start, order of the rule, kind, end) of the matches of each document, sorted."""
        postings = self.table.postings(data, offsets)
        everything = np.arange(len(offsets) - 1)
        found: list[list[tuple]] = [[] for _ in everything]
        for order, (rule, pattern, query) in enumerate(self.rules):
            for doc in candidates(query, postings, everything).tolist():
                for m in pattern.finditer(text(doc)):
                    if len(m[rule.group]) >= rule.least:
                        found[doc].append((m.start(), order, rule.kind, m.end()))
        for spans in found:
            spans.sort()
        return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
SPANS = "array<struct<kind: string, start: bigint, stop: bigint>>"


def _spans_udf(rules: tuple[Rule, ...]):
    @arrow_udf(SPANS)
    def scan(text: pa.Array) -> pa.Array:
        scanner = Scanner(rules)
        found = []
        for part in slices(pa.RecordBatch.from_arrays([text], ["text"]), "text", SEGMENT_BYTES):
            texts = part.column(0).to_pylist()
            data, offsets = joined_bytes(part)
            found += scanner.segment(data, offsets, texts.__getitem__)
        return pa.array(
            [[{"kind": kind, "start": start, "stop": stop} for start, _, kind, stop in spans] for spans in found],
            pa.list_(SPAN),
        )

    return scan


def with_secrets(docs: DataFrame, name: str = "secrets", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the spans of all rules: kind, start and stop in code points, by start and then rule.

    ``docs`` needs ``text``; null counts as empty and has none. Matches of one rule do
    not overlap; those of different rules may.
    """
    return docs.withColumn(name, _spans_udf(rules)(F.coalesce("text", F.lit(""))))
