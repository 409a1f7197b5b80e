"""Phrases of a language by SON partitioning: mine every shard completely, then count all candidates exactly.

The texts are dealt to a few shards. A phrase with at least ``support`` occurrences in
all has at least its proportional part of them in some shard, where the part of a shard
is its share of all words. So each shard is mined for all phrases that reach its lowered
support, and the union over the shards holds every frequent phrase.

A shard is as large as the corpus over a fixed number, so Spark mines it, not a task: the
tasks send hashed phrases with their counts, which one shuffle adds up per shard. It goes
level by level: a phrase of three words is only looked at if both its parts of two
words reached the support in the shard. A phrase is a candidate if it reached the support
of a shard, and its counts where it did, with one less than the support for each other
shard, add up to the support of all. What a level finds is passed on as a bit table, which
has a bounded size. Equal hashes can only add candidates, never lose one.

The last pass counts all candidates, and the single words in them, over all shards by
their text, and everything that is reported comes from these counts.

Each pass reads whole texts in stretches of a few megabytes that end between pieces,
with array operations over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.llm.common import joined_bytes, run_sums
from penprint.session import staged

SHARDS = 4
SUPPORT = 10
LONGEST = 3
COVER_PERCENT = 50
TOP = 2000
NO_LANGUAGE = "und"
# bits of a table of phrases: so many for each of them, and these at least and at most (as powers of two)
LOCAL_BITS, CANDIDATE_BITS = 8, 32
LEAST_BITS, MOST_BITS = 16, 29
STRETCH = 2 << 20
_SHARD_BITS = 4
_SPREAD = 0x5BD1E995
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a stretch of texts in order, with what tells which of them stand together."""

    def __init__(self, data: np.ndarray, firsts: np.ndarray):
        """``data``: lower-cased bytes of texts that follow each other, ``firsts``: where they start."""
        kind = _KIND[data]
        inside = kind == 0
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        # a text that starts inside a run of word bytes starts a word
        own = firsts[firsts < len(data)]
        opens[own] = inside[own]
        before = own[own > 0] - 1
        closes[before] = inside[before]
        starts = np.flatnonzero(opens)
        self.lengths = np.flatnonzero(closes) + 1 - starts
        self.text = np.searchsorted(firsts, starts, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int64)[starts]
        self.joined = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        self.letters = data[inside]

    def hashes(self, salt: np.ndarray, base: int) -> np.ndarray:
        """Hash of each word and the salt of its text."""
        return _mixed(run_sums(self.letters, self.lengths, base) + salt[self.text])

    def runs(self, words: int) -> np.ndarray:
        """Where phrases of so many words start."""
        ok = np.ones(max(len(self.lengths) - words + 1, 0), bool)
        for k in range(words - 1):
            ok &= self.joined[k : k + len(ok)]
        return np.flatnonzero(ok)

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words, each followed by a blank, and where words start and end in that."""
        ends = np.cumsum(self.lengths + 1) - 1
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        blank = np.zeros(len(out), bool)
        blank[ends] = True
        out[~blank] = self.letters
        return out, ends - self.lengths, ends


def longer(hashes: np.ndarray, words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of ``k`` words at ``starts`` from those of one word less."""
    return _mixed(hashes * np.uint64(_BASES[0]) + words[starts + k - 1])


def stretches(batch: pa.RecordBatch, limit: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Lower-cased bytes, text starts in them, and number of the first text; cut between pieces only."""
    data, offsets = joined_bytes(batch, "_text")
    start, size = 0, len(data)
    while start < size:
        stop = start + limit
        # the first place from there on where a text or a piece ends
        while stop < size:
            ends = np.flatnonzero(_KIND[data[stop : stop + limit]] == 2)[:1] + stop
            text = offsets[np.searchsorted(offsets, stop)]
            stop_at = min(int(text), int(ends[0]) if len(ends) else size)
            if stop_at <= stop + limit or len(ends):
                stop = stop_at
                break
            stop += limit
        stop = min(stop, size)
        first = int(np.searchsorted(offsets, start, "right")) - 1
        last = int(np.searchsorted(offsets, stop, "left"))
        lowered = np.frombuffer(data[start:stop].tobytes().translate(_LOWER), np.uint8)
        yield lowered, np.maximum(offsets[first:last] - start, 0), first
        start = stop


def _salts(langs: list[str]) -> np.ndarray:
    known = {lang: xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 11) for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


def has(table: np.ndarray, hashes: np.ndarray, shard=0) -> np.ndarray:
    """Whether the table knows phrases, of a shard if it tells shards apart."""
    moved = (hashes >> np.uint64(_SHARD_BITS)) ^ (np.asarray(shard, np.uint64) * np.uint64(_SPREAD))
    place = (moved & np.uint64(8 * len(table) - 1)).astype(np.int64)
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _read(docs: DataFrame, each, schema: str) -> DataFrame:
    """``each(words, hashes, salts, shards, langs)`` of all stretches, where ``langs`` are those of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            salts, shards = _salts(langs), batch.column(2).to_numpy()
            for data, firsts, text in stretches(batch):
                words = Words(data, firsts)
                if len(words.lengths):
                    own = slice(text, text + len(firsts))
                    hashes = words.hashes(salts[own], _BASES[0])
                    yield from each(words, hashes, salts[own], shards[own], langs[own])

    return docs.mapInArrow(run, schema)


def _counted(keys: np.ndarray) -> pa.RecordBatch:
    found, n = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["key", "n"])


def _keyed(hashes: np.ndarray, shards: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << _SHARD_BITS) - 1)
    return (hashes & ~low) | shards.astype(np.uint64)


def _at(values: np.ndarray, size: int, places: np.ndarray) -> np.ndarray:
    """Values by the place of their phrase, zero elsewhere."""
    out = np.zeros(size, np.uint64)
    out[places] = values
    return out


def _local_counts(docs: DataFrame, level: int, tables: list) -> DataFrame:
    """``key, n`` of the phrases of so many words in each shard whose parts reached the support there."""

    def each(words, hashes, salts, shards, langs):
        shard = shards[words.text].astype(np.uint64)
        starts, below = np.arange(len(hashes)), hashes
        for k in range(2, level + 1):
            # phrases whose parts of one word less are frequent in the shard
            frequent = np.zeros(len(hashes), bool)
            frequent[starts] = has(tables[k - 2].value, below, shard[starts])
            before = _at(below, len(hashes), starts)
            starts = words.runs(k)
            starts = starts[frequent[starts] & frequent[starts + 1]]
            below = longer(before[starts], hashes, starts, k)
        yield _counted(_keyed(below, shard[starts]))

    counts = _read(docs, each, "key bigint, n bigint")
    return counts.groupBy("key").agg(F.sum("n").alias("n"))


def _shard() -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << _SHARD_BITS) - 1))


def _table_of(keys: DataFrame, per_key: int) -> np.ndarray:
    """Bit table of written ``key`` rows; the driver gets a long per 64 bits at most."""
    bits = min(max((per_key * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
    moved = F.shiftrightunsigned("key", _SHARD_BITS).bitwiseXOR(_shard() * F.lit(_SPREAD))
    rows = keys.select(moved.bitwiseAND(F.lit((1 << bits) - 1)).alias("place")).selectExpr(
        "shiftright(place, 6) AS at", "shiftleft(1L, cast(place & 63 AS int)) AS bit"
    )
    found = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint8)


def _candidates(frequent: DataFrame, parts: list[int], support: int) -> DataFrame:
    """``key`` (of shard 0) of the locally frequent phrases that may reach the support of all."""
    more = F.sum(F.col("n") - _least(parts) + 1) + sum(parts) - len(parts)
    own = frequent.groupBy(F.col("key").bitwiseAND(F.lit(-(1 << _SHARD_BITS))).alias("key"))
    return own.agg(more.alias("most"), F.count("*")).where(F.col("most") >= support).select("key")


def _least(parts: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in parts]), (_shard() + 1).cast("int"))


def _exact_counts(docs: DataFrame, tables: list) -> DataFrame:
    """``lang, words, phrase, n`` of all candidates and the words of such, and ``words`` = 0 for all words."""

    def each(words, hashes, salts, shards, langs):
        longest = len(tables)
        number = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        names = list(number)
        lang = np.array([number[x] for x in langs])[words.text]
        text, opens, closes = words.phrases()
        whole = text.tobytes()
        out_lang, out_words, out_phrase, out_n = [], [], [], []
        for i, n in enumerate(np.bincount(lang, minlength=len(names)).tolist()):
            out_lang.append(names[i])
            out_words.append(0)
            out_phrase.append(b"")
            out_n.append(n)
        first = [hashes, words.hashes(salts, _BASES[1])]
        below, starts = first, np.arange(len(hashes))
        for k in range(1, longest + 1):
            if k > 1:
                before = [_at(h, len(hashes), starts) for h in below]
                starts = words.runs(k)
                below = [longer(h[starts], own, starts, k) for h, own in zip(before, first)]
            wanted = has(tables[k - 1].value, below[0])
            one, two, found = below[0][wanted], below[1][wanted], starts[wanted]
            if not len(found):
                continue
            # both hashes together tell the phrases of a stretch apart
            order = np.lexsort((two, one))
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            heads = np.flatnonzero(new)
            n = np.diff(np.append(heads, len(order)))
            chosen = found[order[heads]]
            a, b = opens[chosen].tolist(), closes[chosen + k - 1].tolist()
            out_phrase += [whole[x:y] for x, y in zip(a, b)]
            out_lang += [names[i] for i in lang[chosen].tolist()]
            out_words += [k] * len(chosen)
            out_n += n.tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(out_lang, pa.string()),
                pa.array(out_words, pa.int32()),
                pa.array(out_phrase, pa.binary()).cast(pa.string()),
                pa.array(out_n, pa.int64()),
            ],
            ["lang", "words", "phrase", "n"],
        )

    counts = _read(docs, each, "lang string, words int, phrase string, n bigint")
    return counts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def counted(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, words, phrase, n``: all phrases of up to ``longest`` words with ``support`` occurrences, counted exactly.

    A row with ``words`` = 0 holds the number of all words of a language.
    """
    if not 1 <= shards <= 1 << _SHARD_BITS:
        raise ValueError(f"between 1 and {1 << _SHARD_BITS} shards")
    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("_lang"),
        F.pmod(F.xxhash64(F.col(text), F.lit(3)), F.lit(shards)).cast("int").alias("_shard"),
    )
    context, local, wanted, parts = docs.sparkSession.sparkContext, [], [], []
    for level in range(1, longest + 1):
        found = _local_counts(rows, level, local)
        if level == 1:
            found = staged(found, "words")
            sizes = dict(found.groupBy(_shard()).agg(F.sum("n")).collect())
            total = sum(sizes.values())
            # proportionally lowered, rounded up
            parts = [max(1, -(-support * sizes.get(k, 0) // total)) if total else 1 for k in range(shards)]
        frequent = staged(found.where(F.col("n") >= _least(parts)), f"phrases-{level}")
        if level < longest:
            local.append(context.broadcast(_table_of(frequent.select("key"), LOCAL_BITS)))
        candidates = staged(_candidates(frequent, parts, support), f"candidates-{level}")
        wanted.append(context.broadcast(_table_of(candidates, CANDIDATE_BITS)))
    counts = staged(_exact_counts(rows, wanted), "phrases")
    for table in [*local, *wanted]:
        table.destroy()
    return counts.where((F.col("words") == 0) | (F.col("n") >= support))


def phrases_of(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    cover_percent: int = COVER_PERCENT,
    top: int = TOP,
    shards: int = SHARDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of each language.

    ``docs`` needs ``text`` and ``lang``; other columns are not read. Null texts are empty,
    a null language is ``und``; repeated rows count each time. ``a`` is the number of
    occurrences of the phrase, ``l`` and ``r`` those of the parts before and after its
    weakest cut (ties: the first cut), ``n`` the words of the language. The score is
    floor(1000000 a a / (l r)) there, in whole numbers. A phrase that lies in a longer
    one with at least ``cover_percent`` of its occurrences is left out. Without texts the
    result is empty.
    """
    counts = counted(docs, support, longest, shards)
    candidates = counts.where("words > 1").select("lang", "phrase", F.split("phrase", " ").alias("w"), F.col("n").alias("a"))

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = F.transform(
        F.sequence(F.lit(1), F.size("w") - 1),
        lambda k: F.struct(
            k.cast("int").alias("cut"), part(F.lit(1), k).alias("left"), part(k + 1, F.size("w") - k).alias("right")
        ),
    )
    sides = counts.where("words > 0").select("lang", "phrase", "n")
    cut = candidates.select("lang", "phrase", "a", F.inline(cuts))
    cut = cut.join(sides.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cut = cut.join(sides.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # a is at most l and at most r, so the quotient is at most a million
    score = F.expr(
        "CAST((CAST(a AS decimal(19,0)) * CAST(a AS decimal(19,0)) * 1000000) DIV (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0))) AS bigint)"
    )
    weakest = cut.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest")
    )

    size = F.size("w")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: part(i, k)),
        )
    )
    covers = candidates.where(size > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score"
    )
