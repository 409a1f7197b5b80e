"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Every document gets a 64-bit fingerprint of its word shingles. Equal fingerprints are
put together first, so a group of copies is one entry however large it is. The
fingerprints are stored in one table per segment of 32 bits. Two fingerprints within
two bits have a segment that differs in one bit at most; so each fingerprint looks up
all values within one bit of each of its segments, and full distances are checked.

A segment value that very many fingerprints share would bring all their pairs
together. The table of such a value is split by the other segment: entries and
look-ups are spread over all values within one bit of it. Any two fingerprints whose
distance is two at most still meet there, and no cell holds more than 33 entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from penprint.llm.common import text_bytes
from penprint.llm.components import components
from penprint.llm.shingles import alike_links, checked_links, of_rows, shingle_hashes, with_prefixes
from penprint.session import staged

SHINGLE_WORDS = 3
DISTANCE = 2
CROWD = 64
_CHUNK = 1 << 16


def fingerprint_of(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of a text; zero without words."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        raw = hashes[i : i + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(raw, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > len(hashes))
    return int(bits.view(">i8")[0])


@arrow_udf(LongType())
def fingerprint(text: pa.Array) -> pa.Array:
    """Fingerprint of each text; null counts as empty."""
    batch = pa.RecordBatch.from_arrays([text], ["text"])
    return pa.array([fingerprint_of(t) for t in text_bytes(batch)], pa.int64())


def _segments(fp: Column) -> Column:
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(fp, 32)
    return F.array(
        F.struct(F.lit(0).alias("segment"), high.alias("value"), low.alias("other")),
        F.struct(F.lit(1).alias("segment"), low.alias("value"), high.alias("other")),
    )


def _ball(value: Column) -> Column:
    """All 32-bit values within one bit of ``value``."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(32)])
    return F.transform(flips, lambda flip: value.bitwiseXOR(flip))


def near_links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs ``a`` < ``b`` of fingerprints at most two bits apart. ``prints``: distinct ``fp``."""
    entries = staged(prints.select("fp", F.inline(_segments(F.col("fp")))), "mih-table")
    crowded = staged(
        entries.groupBy("segment", "value").count().where(F.col("count") > crowd).select("segment", "value"),
        "mih-crowded",
    )
    key = ["segment", "value"]
    probes = entries.select("fp", "segment", "other", F.explode(_ball(F.col("value"))).alias("value"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE

    def checked(looked_up: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
        looked_up = looked_up.withColumnRenamed("fp", "a")
        stored = stored.select(*on, F.col("fp").alias("b"))
        return looked_up.join(stored, on).where(near & (F.col("a") < F.col("b"))).select("a", "b")

    if crowded.isEmpty():
        return checked(probes, entries, key).distinct()
    plain = entries.join(crowded, key, "left_anti")
    cells = F.explode(_ball(F.col("other"))).alias("cell")
    stored = entries.join(crowded, key, "left_semi").select(*key, "fp", cells)
    looked_up = probes.join(crowded, key, "left_semi").select(*key, "fp", cells)
    links = checked(probes, plain, key).union(checked(looked_up, stored, [*key, "cell"]))
    return links.distinct()


def labelled(prints: DataFrame) -> DataFrame:
    """``fp`` and the smallest document id and row of its component. ``prints``: fp, doc_id, row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = staged(prints.groupBy("fp").agg(first), "fingerprints")
    roots = staged(components(near_links(classes.select("fp"))), "components")
    rooted = staged(
        classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "first"
        ),
        "rooted",
    )
    least = staged(rooted.groupBy("root").agg(F.min("first").alias("first")), "component-ids")
    return staged(
        rooted.select("fp", "root").join(least, "root").select(
            "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row")
        ),
        "labels",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null text is
    empty; texts without words have fingerprint zero and are linked like any others. A
    null id is never the smallest unless a component has no other. Repeated rows each
    give a row.
    """
    prints = staged(
        docs.select("doc_id", fingerprint("text").alias("fp"), F.monotonically_increasing_id().alias("row")),
        "prints",
    )
    return prints.join(labelled(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def fingerprint_links(texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` of rows that fingerprints bring together and whole sets of shingles confirm.

    ``texts``: a written table with ``row``, ``fp``, ``text`` and ``prefix`` (see ``shingles.with_prefixes``). Each text
    is compared with the first one of the group that fingerprints within two bits put it in.
    """
    prints = texts.select("fp", "row")
    roots = staged(components(near_links(prints.select("fp").distinct())), "components")
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left")
    rooted = staged(rooted.select("row", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("row").alias("a"))
    pairs = rooted.join(least, "root").where(F.col("row") != F.col("a")).select("a", F.col("row").alias("b"))
    return checked_links(pairs, texts)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, with all its columns.

    Near copies have sets of five-word shingles with a Jaccard index of 0.8 or more; a
    group is a chain of them. Fingerprints find the nearest of them first, and whole sets
    confirm these; the shingles find all other pairs, among texts that are not together yet.
    ``docs`` is as for ``near_duplicates``.
    """
    names = [f"_{n}{len(docs.columns)}" for n in ("prefix", "row", "fp")]
    while set(names) & set(docs.columns):
        names = ["_" + n for n in names]
    prefix, row, fp = names
    added = {row: F.monotonically_increasing_id(), fp: fingerprint("text")}
    marked = staged(with_prefixes(docs, prefix).withColumns(added), "marked")
    texts = marked.select("doc_id", "text", *[F.col(own).alias(name) for own, name in ((prefix, "prefix"), (row, "row"), (fp, "fp"))])
    known = staged(fingerprint_links(texts), "fingerprint-links")
    roots = staged(components(alike_links(texts, known)), "components")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("own")
    members = of_rows(texts.select("doc_id", "row"), roots.select(F.col("node").alias("row"), "root"), "inner")
    members = staged(members.select("root", "row", own), "members")
    least = members.groupBy("root").agg(F.min("own").alias("least"))
    others = members.join(least, "root").where(F.col("row") != F.col("least.row")).select(F.col("row").alias(row))
    return of_rows(marked, staged(others, "others"), "left_anti").select(*docs.columns)
