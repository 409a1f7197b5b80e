import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from penprint.functions import text as tx
from penprint.operators import catalog, chunks, grams, metrics, ordering, reports, split
from penprint.operators import vocabulary as vo
from penprint.operators import wordvectors as wv
from penprint.settings import Settings, sweep


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("group", [(), ("g",)])
def test_running_totals_in_ranges(spark, descending, group):
    rng = random.Random(1)
    data = [(rng.choice("aab"), float(k), rng.randint(0, 9)) for k in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, key double, v int")
    got = ordering.running_totals(df, "key", {"t": "v"}, group, descending, range_rows=50)
    totals = {}
    expected = {}
    for g, key, v in sorted(data, key=lambda r: r[1], reverse=descending):
        part = g if group else None
        totals[part] = totals.get(part, 0) + v
        expected[key] = totals[part]
    assert {r["key"]: r["t"] for r in got.collect()} == expected


def test_row_numbers_of_strings(spark):
    names = [f"src{i}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = ordering.row_numbers(df, "name", "n", start=0, range_rows=32)
    assert {r["name"]: r["n"] for r in got.collect()} == {n: i for i, n in enumerate(sorted(names))}


def test_one_large_group_is_cut(spark):
    rows = [("hot", i) for i in range(2000)] + [(f"a{i}", 0) for i in range(500)]
    df = spark.createDataFrame(rows, "author string, book long")
    got = ordering.row_numbers(df, "book", "n", ("author",), start=0, range_rows=300)
    assert sorted(map(tuple, got.collect())) == sorted((a, b, b) for a, b in rows)
    largest = df.repartitionByRange(9, "author", F.asc("book")).groupBy(F.spark_partition_id()).count()
    assert largest.agg(F.max("count")).first()[0] < 1000


def test_pivot_of_a_large_author(spark):
    rows = [("hot", i, 1) for i in range(3000)] + [(None, 5, 7), ("x", 1, 2)]
    counts = spark.createDataFrame(rows, "author string, book long, wc long")
    got = {r["author"]: tuple(r)[1:] for r in reports.author_book_pivot(counts, "author", "book").collect()}
    assert got == {"hot": (1, 1, 1, 1, 3000), None: (7, None, None, None, 7), "x": (2, None, None, None, 2)}


def test_split_skips_a_large_book(spark):
    rows = [("a", "big", 300), *[("b" if i % 2 else "c", f"k{i}", 10) for i in range(70)]]
    counts = spark.createDataFrame(rows, "author string, book string, n_rows long")
    n = {(a, b): k for a, b, k in rows}
    taken = {tuple(r) for r in split.choose_test_books(counts, "author", "book", 0.5).collect()}
    assert {a for a, _ in taken} == {"a", "b", "c"} and sum(n[t] for t in taken) == 500
    df = spark.createDataFrame([(a, b, "t") for a, b, k in rows for _ in range(k)], "author string, book string, text string")
    rows = split.split_by_book(df, "author", "book", test_share=0.4, margin=0.01)
    assert split.test_share(rows).first()[0] == pytest.approx(0.4)
    with pytest.raises(ValueError):
        split.split_by_book(df, "author", "book", test_share=0.1, margin=0.01)


def test_chunks_are_a_prefix_of_the_tokens(spark):
    df = spark.createDataFrame(
        [(i, [f"t{j}" for j in range(n)]) for i, n in enumerate([0, 1, 9, 10, 25])],
        "id int, w array<string>",
    )
    for drop_tail in (True, False):
        got = chunks.chunk_by_length(df, "w", ["id"], 10, drop_tail)
        rows = sorted((r["id"], r["chunk"], r["text"]) for r in got.collect())
        for row in df.collect():
            text = " ".join(t for i, _, t in rows if i == row["id"]).split()
            keep = len(row["w"]) // 10 * 10 if drop_tail else len(row["w"])
            assert text == row["w"][:keep]


def test_sweep_chunks_equal_single_runs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    runs = {k: v for k, v in sweep().items() if k in ("plain", "paragraph", "length_100", "best")}
    all_runs = chunks.sweep_chunks(docs, runs, "text", ["doc_id"], paragraph_separator="\n")
    for name, settings in runs.items():
        single = chunks.prepare_chunks(docs, settings, "text", ["doc_id"], paragraph_separator="\n")
        swept = all_runs.where(F.col("settings_id") == name).select("doc_id", "chunk", "text")
        assert single.exceptAll(swept).count() == 0 and swept.exceptAll(single).count() == 0


def test_sweep_has_the_ten_runs():
    runs = sweep()
    assert len(runs) == 10
    assert runs["best"] == Settings(False, False, True, True, 300, True, False)
    assert Settings.from_list([False, True, True, True, 500, False, False]).group_length == 500
    with pytest.raises(ValueError):
        Settings(group_by_length=True)


def test_catalog_ids_have_gaps(spark):
    rows = [
        ("PG3", "t", "Bee", "['en']", "Text"),
        ("PG1", "t", "Bee", "['en']", "Text"),
        ("PG2", "t", "Ant", "['en']", "Text"),
        ("PG4", "t", "Cow", "['en']", "Text"),
        ("PG9", "t", "Cow", "['en']", "Text"),
        ("PG5", "t", "Various", "['en']", "Text"),
        ("PG6", "t", None, "['en']", "Text"),
        ("PG7", None, "Cow", "['en']", "Text"),
        ("PG8", "t", "Cow", "['fr']", "Text"),
    ]
    df = spark.createDataFrame(rows, "id string, title string, author string, language string, type string")
    got = {(r["pg_code"], r["author_id"], r["book_id"]) for r in catalog.build_catalog(df).collect()}
    assert got == {(1, 1, 0), (3, 1, 1), (4, 2, 0), (9, 2, 1)}


def test_dataset_keeps_the_tail_and_reports_missing(spark):
    cat = spark.createDataFrame([(1, 0, 0), (2, 0, 1)], "pg_code int, author_id long, book_id long")
    books = spark.createDataFrame([(1, [f"w{i}" for i in range(1203)])], "pg_code int, tokens array<string>")
    rows = catalog.build_dataset(cat, books).collect()
    assert sorted(len(r["text"].split()) for r in rows) == [203, 500, 500]
    assert [r["pg_code"] for r in catalog.missing_books(cat, books).collect()] == [2]
    assert [r["pg_code"] for r in catalog.present_books(cat, books).collect()] == [1]


def test_book_split(spark):
    rng = random.Random(3)
    rows = [
        (a, b, f"text {i}")
        for a in range(8)
        for b in range(12)
        for i in range(rng.randint(1, 30))
    ]
    df = spark.createDataFrame(rows, "author_id int, book_id int, text string")
    got = split.split_by_book(df).cache()
    assert got.count() == len(rows)
    # a book is on one side only, and each author has a test book
    per_book = got.groupBy("author_id", "book_id").agg(F.countDistinct("is_train").alias("n"))
    assert per_book.where("n > 1").count() == 0
    assert got.where(~F.col("is_train")).select("author_id").distinct().count() == 8
    share = split.test_share(got).first()["test_share"]
    assert 0.2 - 30 / len(rows) <= share <= 0.2


def test_results_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    results = []
    for parts in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = split.split_by_book(docs.repartition(parts), "source", "doc_id")
        results.append(sorted((r["doc_id"], r["is_train"]) for r in rows.select("doc_id", "is_train").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_tfidf_rows_have_norm_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model, rows = vo.fit_tfidf(docs, max_features=500)
    entries = vo.tfidf_entries(docs, model, rows, ["doc_id"])
    norms = entries.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(0, "aa bb aa"), (1, "bb cc")], "id int, text string")
    model, rows = vo.fit_tfidf(docs, low=1, high=1, max_features=2)
    assert [r["term"] for r in rows] == ["aa", "bb"]
    got = {(r["id"], r["term"]): r["tfidf"] for r in vo.tfidf_entries(docs, model, rows, ["id"]).collect()}
    aa, bb = 2 * (math.log(3 / 2) + 1), math.log(3 / 3) + 1
    norm = math.hypot(aa, bb)
    assert got[0, "aa"] == pytest.approx(aa / norm) and got[0, "bb"] == pytest.approx(bb / norm)
    assert got[1, "bb"] == pytest.approx(1.0) and (1, "cc") not in got


def test_tfidf_without_terms_is_an_error(spark):
    for texts in ([], [(1, "a . b")]):
        with pytest.raises(ValueError, match="empty vocabulary"):
            vo.fit_tfidf(spark.createDataFrame(texts, "id int, text string"))
    with pytest.raises(ValueError, match="at most"):
        vo.fit_tfidf(spark.createDataFrame([], "text string"), max_features=10**9)


@pytest.fixture()
def tiny_vectors(spark):
    vectors = spark.createDataFrame(
        [("aa", [1.0, 0.0]), ("bb", [0.0, 2.0])], "word string, vec array<float>"
    )
    docs = spark.createDataFrame(
        [(0, "aa bb aa zz"), (1, "zz"), (2, "")], "id int, text string"
    ).withColumn("words", tx.terms(F.col("text")))
    return docs, vectors


def test_vectors_by_hand(spark, tiny_vectors):
    docs, vectors = tiny_vectors
    mean = wv.mean_vectors(docs, "words", vectors, "id", 2)
    got = {r["id"]: r["vector"] for r in mean.collect()}
    assert got[0] == pytest.approx([2 / 3, 2 / 3]) and got[1] == [0, 0] and got[2] == [0, 0]
    weighted = wv.weighted_vectors(docs, "words", vectors, "id", 2)
    got = {r["id"]: r["vector"] for r in weighted.collect()}
    idf = math.log(4 / 2) + 1
    aa, bb = 2 * 2 * idf, idf
    assert got[0] == pytest.approx([aa / (aa + bb), 2 * bb / (aa + bb)]) and got[1] == [0, 0]
    unknown = wv.unknown_occurrences(docs, "words", vectors, ["id"])
    assert sorted((r["id"], r["word"]) for r in unknown.collect()) == [(0, "zz"), (1, "zz")]


def test_remove_words_keeps_order_and_empty_texts(spark, tiny_vectors):
    docs, _ = tiny_vectors
    listed = spark.createDataFrame([("bb",), ("zz",)], "word string")
    got = {r["id"]: r["text"] for r in wv.remove_words(docs, "text", listed, "id").collect()}
    assert got == {0: "aa aa", 1: "", 2: ""}


def test_one_word_holds_half_of_all_rows(spark):
    docs = spark.range(2000).select("id", F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id") % 7)).alias("words"))
    rows = [("hot", [1.0, 3.0]), *[(f"w{i}", [float(i), 0.0]) for i in range(6)]]
    vectors = spark.createDataFrame(rows, "word string, vec array<float>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    results = []
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = wv.mean_vectors(docs, "words", vectors, "id", 2).collect()
            results.append({r["id"]: tuple(r["vector"]) for r in got})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1] and len(results[0]) == 2000
    assert results[0][3] == (2.0, 1.5) and results[0][6] == (1.0, 3.0)


def test_vector_file_is_read_once(spark, tmp_path):
    from penprint.sources import readers

    (tmp_path / "v.txt").write_text("aa 1 2\nbb 3 4\n")
    docs = spark.createDataFrame([(1, ["aa", "bb"])], "id int, words array<string>")
    vectors = readers.read_word_vectors(spark, str(tmp_path), 2)
    known = wv.known_counts(docs, "words", vectors, ["id"])
    assert known._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert known.count() == 2

def test_encode_fixed_length(spark, tiny_vectors):
    docs, _ = tiny_vectors
    vocabulary = spark.createDataFrame([("aa", 0), ("bb", 1)], "term string, idx int")
    rows = wv.encode_fixed_length(docs, "words", vocabulary, "id", 3).collect()
    got = {r["id"]: (r["input_ids"], r["attention_mask"]) for r in rows}
    assert got[0] == ([2, 3, 2], [1, 1, 1])
    assert got[1] == ([1, 0, 0], [1, 0, 0])
    assert got[2] == ([0, 0, 0], [0, 0, 0])


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 1)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    counts = metrics.confusion(df)
    scores = {r["class"]: r for r in metrics.class_scores(counts).collect()}
    assert scores[1]["precision"] == pytest.approx(0.5) and scores[1]["recall"] == 1.0
    assert scores[2]["precision"] == 0 and scores[2]["f1"] == 0 and scores[2]["support"] == 1
    report = {r["entry"]: r for r in metrics.report(counts).collect()}
    assert report["accuracy"]["f1"] == pytest.approx(8 / 11)
    assert report["macro avg"]["recall"] == pytest.approx((5 / 7 + 1 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(8 / 11)
    assert report["weighted avg"]["support"] == 11
    row = metrics.metrics_row(df, "m", "f", Settings(), average="binary").first()
    assert row["precision"] == pytest.approx(0.5) and row["support"] == 3
    assert row["accuracy"] == pytest.approx(8 / 11)


@pytest.mark.parametrize("range_rows", [4096, 20])
def test_curves_against_brute_force(spark, range_rows):
    rng = random.Random(7)
    data = [(round(rng.random(), 2), rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(data, "score double, label int")
    curve = metrics.pr_curve(df, "score", "label", range_rows=range_rows).collect()
    positives = sum(y for _, y in data)
    for r in curve:
        if r["threshold"] is None:
            assert (r["precision"], r["recall"]) == (1.0, 0.0)
            continue
        hits = [y for s, y in data if s >= r["threshold"]]
        assert r["precision"] == pytest.approx(sum(hits) / len(hits))
        assert r["recall"] == pytest.approx(sum(hits) / positives)
    assert len(curve) == len({s for s, _ in data}) + 1
    wins = sum(
        (a > b) + 0.5 * (a == b) for a, y in data if y for b, z in data if not z
    )
    area = metrics.roc_auc(df, "score", "label", range_rows=range_rows).first()["auc"]
    assert area == pytest.approx(wins / (positives * (len(data) - positives)))


def test_remove_words_from_a_long_text_with_many_listed(spark):
    # twenty thousand terms, five thousand of the distinct ones listed: one text, linear work
    words = [f"w{i % 9000:05d}" for i in range(20_000)]
    listed = {f"w{i:05d}" for i in range(0, 9000, 9)} | {f"w{i:05d}" for i in range(4000)}
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "w00000 w00009"), (3, None), (4, "")], "id int, text string")
    rows = spark.createDataFrame([(w,) for w in sorted(listed)], "word string")
    got = {r["id"]: r["text"] for r in wv.remove_words(docs, "text", rows, "id").collect()}
    assert got == {1: " ".join(w for w in words if w not in listed), 2: "", 3: "", 4: ""}


def nearest_by_hand(sizes, test, goal, margin):
    """The same search with all moves written out; rows reached at the end."""
    test = set(test)
    while True:
        total, reached = sum(sizes.values()), sum(sizes[b] for b in test)
        if abs(reached / total - goal) <= margin:
            return reached
        gap = round(total * goal) - reached
        alone = {b for b in test if sum(1 for c in test if c[0] == b[0]) == 1}
        moves = [(set(), {b}) for b in sizes if b not in test] + [({b}, set()) for b in test - alone]
        moves += [({a}, {b}) for a in test for b in sizes if b not in test and (a not in alone or a[0] == b[0])]
        left = [abs(gap - sum(sizes[b] for b in into) + sum(sizes[b] for b in out)) for out, into in moves]
        if not left or min(left) >= abs(gap):
            return reached
        out, into = moves[left.index(min(left))]
        test = (test - out) | into
        if min(left) == 0:
            return sum(sizes[b] for b in test)


@pytest.mark.parametrize("case", range(4))
def test_repair_of_the_book_split(spark, case):
    rng = random.Random(case)
    sizes = {(f"a{i}", f"b{j}"): rng.randrange(1, (20, 400, 5, 1)[case] + 1) for i in range(6) for j in range(rng.randrange(1, 5))}
    counts = spark.createDataFrame([(a, b, n) for (a, b), n in sizes.items()], "author string, book string, n_rows long")
    first = split.choose_test_books(counts, "author", "book", 0.3)
    before = {tuple(r) for r in first.collect()}
    chosen, share = split.repair_test_books(counts, first, "author", "book", 0.3, 0.0005)
    after, total = {tuple(r) for r in chosen.collect()}, sum(sizes.values())
    assert {a for a, _ in after} == {a for a, _ in sizes}
    assert share == pytest.approx(sum(sizes[b] for b in after) / total)
    # equal moves may be taken in another order, the first distance is the same
    by_hand = nearest_by_hand(sizes, before, 0.3, 0.0005)
    assert abs(share - 0.3) <= max(abs(by_hand / total - 0.3), 0.0005) + 1 / total


def test_best_exchange_is_the_nearest_of_all():
    rng = random.Random(3)
    for _ in range(200):
        out, into = (sorted(rng.sample(range(1, 60), rng.randrange(0, 8))) for _ in range(2))
        gap = rng.randrange(-40, 40)
        got = split.best_exchange(out, into, gap)
        expected = min(((abs(gap - (b - a)), a, b) for a in out for b in into), default=None)
        assert (got is None and expected is None) or got[0] == expected[0]


@pytest.mark.parametrize("by_idf", [False, True])
@pytest.mark.parametrize("block_pairs", [1, 7, 1000])
def test_means_by_blocks_of_texts(spark, by_idf, block_pairs):
    # repeated and null keys, a text without words, a word with two vectors
    texts = [(1, "a a b x"), (2, "c d"), (2, "c c"), (3, ""), (4, None), (None, "a"), *[(i, "a b c " * i) for i in range(5, 20)]]
    df = spark.createDataFrame(texts, "id long, text string").select("id", F.split("text", " ").alias("words"))
    known = [("a", [1.0, 0.0], 1.5), ("b", [0.0, 2.0], 0.5), ("b", [4.0, 2.0], 0.25), ("c", [8.0, -1.0], 2.0)]
    vectors = spark.createDataFrame(known, "word string, vec array<float>, idf double")
    counted = wv.counted_texts(df, "words", ["id"])
    got = wv.weighted_means(counted, vectors, ["id"], 2, by_idf, block_pairs).collect()
    expected = []
    for key, _ in texts:
        total, sums = 0.0, [0.0, 0.0]
        for own, text in texts:
            words = (text or "").split(" ")
            for word, vec, idf in known:
                n = words.count(word) if own == key and key is not None else 0
                weight = n * n * idf if by_idf else n
                total, sums = total + weight, [s + weight * v for s, v in zip(sums, vec)]
        expected.append((key, [round(s / total, 9) if total else 0.0 for s in sums]))
    assert sorted([(r.id, [round(x, 9) for x in r.vector]) for r in got], key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("by_idf", [False, True])
def test_means_do_not_depend_on_the_words_sent_to_the_tasks(spark, by_idf, monkeypatch):
    texts = [(i, "often " * (i % 3 + 1) + f"some{i % 4} " * 2 + f"own{i} none") for i in range(40)]
    df = spark.createDataFrame(texts, "id long, text string").select("id", F.split("text", " ").alias("words"))
    rows = [("often", [1.0, 0.0]), ("often", [0.5, 3.0]), *[(f"some{i}", [float(i), 1.0]) for i in range(3)]]
    rows += [(f"own{i}", [0.0, float(i)]) for i in range(30)]
    vectors = spark.createDataFrame(rows, "word string, vec array<float>")
    weights = spark.createDataFrame([(w, 1 + len(w) / 4) for w, _ in rows[1:]], "word string, idf double")
    counted = wv.counted_texts(df, "words", ["id"])
    joined = vectors.join(weights, "word") if by_idf else vectors
    got = []
    for frequent in (0, 1, 3, 100):
        means = [wv.weighted_means(counted, joined, ["id"], 2, by_idf, 30, frequent)]
        if by_idf:
            means.append(wv.weighted_means(counted, vectors, ["id"], 2, by_idf, 30, frequent, weights))
        got += [sorted((r["id"], *(round(x, 9) for x in r["vector"])) for r in m.collect()) for m in means]
    assert len(got[0]) == 40 and all(g == got[0] for g in got[1:])
    # vectors of words that most texts hold are not moved for each block
    listed, place, gain, values = wv._frequent_words(counted, vectors.withColumn("weight", F.lit(1.0)), None, 2, 2)
    assert listed.to_pylist()[0] == "none" and len(place) == 3 and len(values) == len(gain) <= 2


def _texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_ngrams_are_counted_by_parts_of_the_texts(spark):
    rows = _texts(spark, [(1, "ab cd ab cd"), (2, "cd ab"), (3, None), (4, ""), (5, "ab cd")]).coalesce(1)
    words = vo.with_terms(rows, "text", 1, 1)
    got = {r["term"]: (r["cf"], r["df"]) for r in vo.corpus_counts(words, low=1, high=3, with_total=True).collect()}
    assert got == {
        "": (5, 5), "ab": (4, 3), "cd": (4, 3), "ab cd": (3, 2), "cd ab": (2, 2), "ab cd ab": (1, 1), "cd ab cd": (1, 1)
    }
    # the rows that tasks hand on are terms of a part, not of a text
    handed = words.select("terms").mapInArrow(grams.counts_task(1, 1, False), "term string, cf long, df long")
    assert handed.count() == 2


def test_parts_hold_whole_lists_and_all_of_them():
    lists = pa.array([["a"] * n for n in (3, 1, 0, 7, 2, 0)], pa.list_(pa.string()))
    batches = [pa.record_batch([lists.slice(i, 3)], ["terms"]) for i in (0, 3)]
    got = [p.to_pylist() for p in grams.parts(iter(batches), most=4)]
    assert [x for p in got for x in p] == lists.to_pylist() and len(got) > 1


@pytest.mark.parametrize("block_words", [1_000_000, 3, 1])
def test_tfidf_by_blocks_is_that_of_joined_terms(spark, block_words):
    rows = _texts(
        spark, [(1, "ab cd ab ef"), (2, "cd ab"), (2, "gh gh"), (None, "ab cd"), (None, "ab"), (3, None), (4, ""), (5, "ab cd ef")]
    )
    joined = vo.joined_tfidf(rows, ["doc_id"], high=3, fit=rows)
    blocks = vo._block_tfidf(vo.with_terms(rows, "text", 1, 1).select("doc_id", "terms"), ["doc_id"], 1, 3, block_words)
    both = [sorted((str(r["doc_id"]), r["term"], round(r["tfidf"], 12)) for r in df.collect()) for df in (joined, blocks)]
    assert both[0] == both[1] and len(both[0]) > 20


def test_tfidf_of_all_terms_moves_no_row_per_text_and_term(spark):
    rows = _texts(spark, [(i, "ab cd ef") for i in range(40)])
    plan = vo.joined_tfidf(rows, ["doc_id"], high=3)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "Generate" not in plan and "Join" not in plan


@pytest.mark.parametrize("n", [1, 4, 9, 30])
def test_most_frequent_ngrams_without_counting_all(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, " ".join(f"w{min(int(x), 40):02d}" for x in rng.zipf(1.4, 30))) for i in range(60)] + [(60, None), (61, "")]
    texts = _texts(spark, rows).repartition(3)
    words = vo.with_terms(texts, "text", 1, 1)
    every = vo.corpus_counts(words, low=1, high=3, with_total=True)
    best = sorted(every.collect(), key=lambda r: (r["term"] != "", -r["cf"], r["term"]))[: n + 1]
    _, found = vo.fit_tfidf(texts, high=3, max_features=n)
    assert [(r["term"], r["cf"], r["df"]) for r in found] == sorted((r["term"], r["cf"], r["df"]) for r in best[1:])
    counted = vo.frequent_counts(words, 3, n)
    assert {(r["term"], r["cf"], r["df"]) for r in best} <= {tuple(r) for r in counted.collect()}
    if n <= 9:
        assert counted.count() < every.count() / 10
    # with fewer words than places all n-grams may be needed
    assert vo.frequent_counts(words, 3, 100) is None


def test_rate_of_unknown_ngrams_is_that_of_their_list(spark):
    rows = [(1, "ab cd ab cd ef"), (2, "cd ab"), (3, None), (4, ""), (5, "ef ef ef gh")]
    words = vo.with_terms(_texts(spark, rows), "text", 1, 1)
    listed = vo.with_terms(_texts(spark, rows), "text", 1, 3)
    # phrases have vectors too, as long as an n-gram or longer
    known = ["ab", "cd ab", "ef ef ef", "ab cd ab cd", "zz", "gh zz"]
    for some in (known, known[:1], known[3:]):
        vectors = spark.createDataFrame([(w,) for w in some], "word string")
        expected = wv.unknown_word_rate(listed, "terms", vectors).first()
        assert wv.unknown_word_rate(words, "terms", vectors, 1, 3).first() == expected
    # what tasks hand on: words, and phrases that have a vector; the others only as numbers
    handed = wv._sought_counts(words.coalesce(1), "terms", spark.createDataFrame([("cd ab",)], "word string"), 1, 3).collect()
    assert sorted(r["term"] for r in handed if r["term"]) == ["ab", "cd", "cd ab", "ef", "gh"]
    assert sum(r["cf"] for r in handed if r["term"] is None) == 11
