"""Personal data: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find what has a strict form. The field labels words around every word that
has a digit or an at sign: word shapes of a word and its neighbours give the scores of
its tags, and Viterbi decoding, for all stretches of a batch at once, gives the best tags.
Its entities that pass a check of their form and overlap no pattern match are added.

The field is trained on the small table ``LABELLED``, in which ``[kind:text]`` marks an
entity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from penprint.llm.optimise import minimise

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 3
PENALTY = 5.0
STEPS = 80
_KEPT_TOKENS = 200_000
_LANES = 4096

LABELLED = (
    "Please call me at [phone:(743) 555-3824] after lunch .",
    "Our office line is [phone:(212) 555-0143] and the shop opens late .",
    "Reach the desk under [phone:555-867-5309] or write a letter .",
    "fax [phone:030 1234567] for the Berlin branch",
    "ring [phone:0161 496 0123] before noon",
    "Téléphone [phone:01 42 68 53 00] le matin",
    "llame al [phone:91 123 45 67] por la tarde",
    "Tel. [phone:089/1234567] werktags",
    "mobile [phone:07700 900123] , home unknown",
    "her number [phone:212.555.0199] was on the card",
    "dial [phone:+1 (523) 555-1055] now",
    "the host [ip:10.20.30.40] did not answer",
    "from [ip:192.168.1.254] port 8080",
    "ping [ip:227.5.221.1] lost packets",
    "write to [email:ann.lee@mail.example.com] today",
    "contact [email:bo_99@example.org] for details",
    "mail [email:thinhe.19@mail5.example.com] soon",
    "paid with [card:4111 1111 1111 1111] on Monday",
    "card [card:5500-0000-0000-0004] was declined",
    "number [card:378282246310005] expires soon",
    "In 1999 there were 300 cases in 12 towns .",
    "See page 12 of 300 in the 2nd volume .",
    "Licensed under the Apache License, Version 2.0.",
    "GNU General Public License, version 3.",
    "The meeting is at 10:30 on 2021-05-06 in room 4 .",
    "It costs $1,200.50 or 15% less than in 2020 .",
    "order 123456 was shipped on 03/04/2019",
    "ISBN 978-3-16-148410-0 second edition 1987",
    "build 4.15.0-72 passed 1024 tests in 3.5 s",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" was found',
    "key = f0ddae3b09ae356cbefecdd3232fa5489bb400d6 end",
    "follow @example_user on the site since 2012",
    "the years 1914-1918 and 1939-1945 were hard",
    "chapter 7 , verse 21 , line 3",
    "temperature of 21.5 degrees at 1013 hPa",
    "serial 8837 2291 in the log of 2018-11-30 12:00:05",
    "about 1,000,000 people and 40,000 houses",
    "tracking id 99213847561023 from the depot",
    "row 17 | 42 | 3.14 | 2,718 | total 65",
    "a ratio of 3:2 or 16:9 in 4k",
)

# --- patterns ---------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match that fails inside a run of digits fails from each place of the run
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARKED = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def digits_of(text: str) -> list[int]:
    return [int(c) for c in _DIGIT.findall(text)]


def luhn(digits: list[int]) -> bool:
    """Every second digit from the right is doubled; digit sums add up to a multiple of ten."""
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern; each at sign is tried with all that can stand before it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, stop) of all pattern matches, in order."""
    out = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if is_ip(m[0])]
        out += [(2, *m.span()) for m in _CARD.finditer(text) if is_card(m[0])]
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


# --- field ------------------------------------------------------------------

TAGS = ("O", *[f"{place}-{kind}" for kind in KINDS for place in "BI"])


def shape(token: str) -> str:
    """Letters by case and digits by number, in runs; other characters stay."""
    shaped = re.sub(r"[A-Z]+", "X", re.sub(r"[^\W\d_A-Z]+", "x", token))
    return re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 5)}", shaped)


def token_features(token: str) -> list[str]:
    core = token.strip(".,;:!?\"'*%#$&|")
    n = len(digits_of(core))
    found = [f"shape={shape(core)}", f"digits={0 if not n else 1 + min(n, 20) // 3}", f"dots={min(core.count('.'), 4)}"]
    if "@" in core:
        found.append("at" if 0 < core.find("@") < len(core) - 1 else "outer at")
    if core[:1] in "+(" and core:
        found.append(f"first={core[:1]}")
    if core.isalpha():
        found.append(f"word={core.lower()}")
    if core != token:
        found.append("marks")
    return found


def _parsed(line: str) -> tuple[list[str], list[int]]:
    """Words and tags of a labelled line."""
    words, tags = [], []
    for part in re.split(r"(\[(?:%s):[^\]]+\])" % "|".join(KINDS), line):
        m = re.fullmatch(r"\[(\w+):([^\]]+)\]", part)
        own = (m[2] if m else part).split()
        words += own
        tags += [TAGS.index(f"{'I' if i else 'B'}-{m[1]}") if m else 0 for i in range(len(own))]
    return words, tags


def _allowed() -> np.ndarray:
    """Minus infinity where a tag cannot follow another; the last row is the start."""
    out = np.zeros((len(TAGS) + 1, len(TAGS)))
    for b, tag in enumerate(TAGS):
        if tag.startswith("I"):
            out[:, b] = -1e9
            out[[TAGS.index("B" + tag[1:]), b], b] = 0
    return out


class Field:
    """Weights of features by place (own, before, after) and tag, and of tag pairs."""

    def __init__(self, number: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.number, self.weights, self.moves = number, weights, moves
        self.kept: dict[str, np.ndarray] = {}

    def token(self, token: str) -> np.ndarray:
        """Scores by place and tag that a word gives itself and its neighbours."""
        row = self.kept.get(token)
        if row is None:
            own = [self.number[f] for f in token_features(token) if f in self.number]
            row = self.weights[own].sum(0) if own else np.zeros(self.weights.shape[1:])
            if len(self.kept) < _KEPT_TOKENS:
                self.kept[token] = row
        return row

    def scores(self, words: list[str]) -> np.ndarray:
        rows = np.array([self.token(w) for w in words])
        out = rows[:, 0].copy()
        out[1:] += rows[:-1, 1]
        out[:-1] += rows[1:, 2]
        return out

    def decode(self, stretches: list[list[str]]) -> list[np.ndarray]:
        """Best tags of each stretch of words, all stretches step by step together."""
        result: list = [None] * len(stretches)
        order = sorted(range(len(stretches)), key=lambda i: -len(stretches[i]))
        for first in range(0, len(order), _LANES):
            own = order[first : first + _LANES]
            lengths = np.array([len(stretches[i]) for i in own])
            scores = np.zeros((int(lengths[0]), len(own), len(TAGS)))
            for lane, i in enumerate(own):
                scores[: lengths[lane], lane] = self.scores(stretches[i])
            best = scores[0] + self.moves[-1]
            back = np.zeros(scores.shape, np.int8)
            for t in range(1, len(scores)):
                lanes = int((lengths > t).sum())
                paths = best[:lanes, :, None] + self.moves[:-1]
                back[t, :lanes] = paths.argmax(1)
                best[:lanes] = paths.max(1) + scores[t, :lanes]
            tags = np.zeros((len(scores), len(own)), np.int64)
            tag = best.argmax(1)
            for t in range(len(scores) - 1, -1, -1):
                live = lengths > t
                tags[t, live] = tag[live]
                if t:
                    before = np.take_along_axis(back[t], tag[:, None], 1)[:, 0].astype(np.int64)
                    tag = np.where(live, before, tag)
            for lane, i in enumerate(own):
                result[i] = tags[: lengths[lane], lane]
        return result


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(lines: tuple[str, ...] = LABELLED, steps: int = STEPS) -> Field:
    """Fit the field by maximum likelihood with a Gaussian prior."""
    parsed = [_parsed(line) for line in lines]
    names = sorted({f for words, _ in parsed for w in words for f in token_features(w)})
    number = {f: k for k, f in enumerate(names)}
    n_tags, allowed = len(TAGS), _allowed()
    data = []
    for words, tags in parsed:
        # rows of (word, place, feature)
        rows = [
            (t + shift, place, number[f])
            for t, w in enumerate(words)
            for place, shift in ((0, 0), (1, 1), (2, -1))
            if 0 <= t + shift < len(words)
            for f in token_features(w)
        ]
        at, place, feature = np.array(rows).T
        data.append((len(words), at, feature * 3 + place, np.array(tags)))
    size = len(names) * 3 * n_tags

    def loss(x):
        w, moves = x[:size].reshape(-1, n_tags), x[size:].reshape(n_tags + 1, n_tags) + allowed
        gw, gm, total = w / PENALTY, x[size:].reshape(n_tags + 1, n_tags) / PENALTY, (x @ x) / 2 / PENALTY
        for length, at, column, tags in data:
            scores = np.zeros((length, n_tags))
            np.add.at(scores, at, w[column])
            ahead = np.zeros((length, n_tags))
            ahead[0] = moves[-1] + scores[0]
            for t in range(1, length):
                ahead[t] = _log_sum(ahead[t - 1][:, None] + moves[:-1], 0) + scores[t]
            behind = np.zeros((length, n_tags))
            for t in range(length - 2, -1, -1):
                behind[t] = _log_sum(moves[:-1] + scores[t + 1] + behind[t + 1], 1)
            whole = _log_sum(ahead[-1], 0)
            total += whole - scores[np.arange(length), tags].sum() - moves[np.r_[n_tags, tags[:-1]], tags].sum()
            error = np.exp(ahead + behind - whole)
            gm[-1] += error[0]
            for t in range(1, length):
                gm[:-1] += np.exp(ahead[t - 1][:, None] + moves[:-1] + scores[t] + behind[t] - whole)
            np.add.at(gm, (np.r_[n_tags, tags[:-1]], tags), -1)
            error[np.arange(length), tags] -= 1
            np.add.at(gw, column, error[at])
        return total, np.concatenate([gw.reshape(-1), gm.reshape(-1)])

    x = minimise(loss, np.zeros(size + (n_tags + 1) * n_tags), steps)
    return Field(number, x[:size].reshape(len(names), 3, n_tags), x[size:].reshape(n_tags + 1, n_tags) + allowed)


@cache
def trained() -> tuple:
    """Features, weights and moves of the field, fitted once in a session."""
    field = train()
    return field.number, field.weights, field.moves


def stretches(text: str, context: int = CONTEXT) -> list[list[tuple[int, int]]]:
    """Places of the words within ``context`` words of one that has a digit or an at sign."""
    if not _MARKED.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    out: list[list[tuple[int, int]]] = []
    stop = 0
    for i, (a, b) in enumerate(tokens):
        if _MARKED.search(text, a, b):
            start = max(i - context, 0)
            if start > stop or not out:
                out.append([])
            start, stop = max(start, stop), min(i + context + 1, len(tokens))
            out[-1] += tokens[start:stop]
    return out


def _entities(text: str, places: list[tuple[int, int]], tags: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, stop) of the tagged words, without marks at their ends, if their form holds."""
    t = 0
    while t < len(tags):
        if tags[t] == 0:
            t += 1
            continue
        kind, last = (int(tags[t]) - 1) // 2, t
        while last + 1 < len(tags) and tags[last + 1] == 2 * kind + 2:
            last += 1
        start, stop = places[t][0], places[last][1]
        while start < stop and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while stop > start and not text[stop - 1].isalnum():
            stop -= 1
        t = last + 1
        if form_holds(kind, text[start:stop]):
            yield kind, start, stop


def form_holds(kind: int, found: str) -> bool:
    if kind == 0:
        return re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", found) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", found) is not None and is_ip(found)
    if kind == 2:
        return re.fullmatch(r"[0-9][0-9\x20-]+", found) is not None and is_card(found)
    return re.fullmatch(r"[+(]?[0-9][0-9\x20()./-]*", found) is not None and 7 <= len(digits_of(found)) <= 15


def scan(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    """(kind number, start, stop, by pattern) of each text, by kind and then start."""
    found, owners, words, places = [], [], [], []
    for i, text in enumerate(texts):
        found.append([(*span, True) for span in pattern_spans(text)])
        for part in stretches(text):
            owners.append(i)
            places.append(part)
            words.append([text[a:b] for a, b in part])
    for i, part, tags in zip(owners, places, field.decode(words)):
        taken = [(a, b) for _, a, b, fixed in found[i] if fixed]
        for kind, start, stop in _entities(texts[i], part, tags):
            if all(stop <= a or start >= b for a, b in taken):
                found[i].append((kind, start, stop, False))
    return [sorted(spans) for spans in found]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("by_pattern", pa.bool_())])
SPANS = "array<struct<kind: string, start: bigint, stop: bigint, by_pattern: boolean>>"


def with_personal_data(docs: DataFrame, name: str = "personal", rows: int = 1000) -> DataFrame:
    """Add the spans of personal data: kind, start and stop in code points, and whether a pattern found it.

    ``docs`` needs ``text``; null counts as empty and has none. Spans are sorted by kind
    and then start; those of the field overlap no pattern match.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained())

    @arrow_udf(SPANS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = Field(*sent.value)
        for text in batches:
            found = []
            for start in range(0, len(text), rows):
                found += scan([t or "" for t in text.slice(start, rows).to_pylist()], field)
            yield pa.array(
                [
                    [{"kind": KINDS[k], "start": a, "stop": b, "by_pattern": fixed} for k, a, b, fixed in spans]
                    for spans in found
                ],
                pa.list_(SPAN),
            )

    return docs.withColumn(name, find(F.col("text")))
