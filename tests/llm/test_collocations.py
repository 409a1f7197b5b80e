"""Phrases and their scores against plain counting, over odd texts and many cuts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from penprint.llm import collocations as co

ROWS = [
    ("The cat sat. the cat\tsat, THE CAT sat", "en"), ("the cat sat the cat sat", "en"), ("the cat", None), ("", "en"),
    (None, "fr"), (None, None), ("a a a a a a a a a a a a", "de"), ("é ü é ü é ü é", "de"), ("x" * 3000 + " y", "de"),
    (",,;;\n\r\x0b\x0c!?", "en"), (" lead and trail ", "en"), ("one.two three:four", "en"), ("nul\x00byte nul\x00byte", ""),
] * 3


def expected(rows, support, longest, cover, top):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    wanted = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= support}
    out = {}
    for (lang, w), a in wanted.items():
        cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = [
            b for (other, v), b in wanted.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        ]
        if all(100 * b < cover * a for b in inside):
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def frame(spark, rows):
    return spark.createDataFrame([(t, g, "clash") for t, g in rows], "text string, lang string, phrase string")


@pytest.mark.parametrize(
    "support,longest,cover,top,shards", [(1, 3, 50, 2000, 4), (3, 3, 50, 2000, 1), (4, 2, 100, 3, 3), (2, 4, 80, 5, 16)]
)
def test_against_plain_counting(spark, support, longest, cover, top, shards):
    got = co.phrases_of(frame(spark, ROWS), support, longest, cover, top, shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected(ROWS, support, longest, cover, top)


def test_against_plain_counting_of_documents(spark, sf, monkeypatch):
    monkeypatch.setattr(co, "STRETCH", 700)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, co.phrases_of(docs).collect())) == expected(rows, 10, 3, 50, 2000)


def test_empty_table(spark):
    assert co.phrases_of(frame(spark, ROWS).limit(0)).count() == 0
    assert co.phrases_of(frame(spark, [(None, None), ("", "en")])).count() == 0


@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_stretches_cut_between_pieces(limit):
    batch = pa.record_batch([pa.array([t or "" for t, _ in ROWS])], ["_text"])
    words, whole = [], []
    for data, firsts, first in co.stretches(batch, limit):
        part = co.Words(data, firsts)
        text, opens, closes = part.phrases()
        said = [text.tobytes()[a:b] for a, b in zip(opens, closes)]
        joined = np.append(part.joined, False) if len(said) else []
        words += [(first + int(t), w, bool(j)) for t, w, j in zip(part.text, said, joined)]
    for i, (text, _) in enumerate(ROWS):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            own = re.findall(r"[^\x20\x09]+", piece)
            whole += [(i, w.encode(), j < len(own) - 1) for j, w in enumerate(own)]
    assert words == whole
