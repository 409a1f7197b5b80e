"""Readers and writers on small files."""

import pytest
from pyspark.sql import functions as F

from penprint.operators.rows import with_labels
from penprint.sources import readers, writers


def test_sources_with_quoted_commas(spark, tmp_path):
    path = tmp_path / "sources.csv"
    path.write_text('author,title,url\nA B,"One, Two",http://x\nC,"Say ""hi""",http://y\n')
    rows = readers.read_sources(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("A B", "One, Two", "http://x"), ("C", 'Say "hi"', "http://y")]


def test_raw_books(spark, tmp_path):
    folder = tmp_path / "agatha_christie"
    folder.mkdir()
    (folder / "raw_poirot.txt").write_text("line one\nline two\n")
    (folder / "other.txt").write_text("no")
    rows = readers.read_raw_books(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("agatha_christie", "poirot", "line one\nline two\n")]


def test_chapter_files(spark, tmp_path):
    folder = tmp_path / "author_a" / "book_b"
    folder.mkdir(parents=True)
    (folder / "data.csv").write_text(
        'section_num,chapter_num,name,text,wc\n0,0,Part,,0\n0,1,One,"a, b\nc",3\n'
    )
    rows = readers.read_chapter_files(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [(0, 1, "One", "a, b\nc", 3, "author_a", "book_b")]


def test_token_files(spark, tmp_path):
    (tmp_path / "PG7_tokens.txt").write_text("one\ntwo\nthree\n")
    (tmp_path / "PG8_tokens.txt").write_bytes(b"a\r\nb")
    rows = {r["pg_code"]: r["tokens"] for r in readers.read_token_files(spark, str(tmp_path)).collect()}
    assert rows == {7: ["one", "two", "three"], 8: ["a", "b"]}


def test_word_vectors(spark, tmp_path):
    path = tmp_path / "vectors.txt"
    path.write_text("the 1 2\nbad 1 x\nshort 1\nthe 3 4.5\n. . 5\n")
    rows = {r["word"]: r["vec"] for r in readers.read_word_vectors(spark, str(path), 2).collect()}
    assert rows == {"the": [3.0, 4.5]}


def test_word_list(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("The \nthe\n\nCat\n")
    assert {r["word"] for r in readers.read_word_list(spark, str(path)).collect()} == {"the", "cat"}


def test_writers(spark, tmp_path):
    words = spark.createDataFrame([("b",), ("a",), ("a",)], "word string")
    writers.write_word_list(words, str(tmp_path / "w"))
    assert spark.read.text(str(tmp_path / "w")).count() == 3

    vocabulary = spark.createDataFrame([("b", 1), ("a", 0)], "term string, idx int")
    writers.write_vocabulary(vocabulary, str(tmp_path / "v"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "v")).collect()] == ["a", "b"]

    metrics = spark.createDataFrame([("rf", 0.5)], "model string, accuracy double")
    target = str(tmp_path / "m")
    for fresh in (True, False, False):
        writers.append_metrics(metrics, target, fresh)
    rows = spark.read.schema(metrics.schema).option("header", True).csv(target)
    assert rows.count() == 3
    writers.append_metrics(metrics, target, fresh=True)
    assert spark.read.schema(metrics.schema).option("header", True).csv(target).count() == 1

    writers.write_predictions(metrics, str(tmp_path / "p"))
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).columns == ["model", "accuracy"]


def test_existing_output_is_kept(spark, tmp_path):
    target = str(tmp_path / "t")
    writers.write_table(spark.range(3), target)
    writers.write_table(spark.range(5), target, mode="ignore")
    assert spark.read.parquet(target).count() == 3


def test_chapters_by_author_and_book(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", "t1"), ("b", "y", "t2")], "author string, book string, text string")
    writers.write_chapters(rows, str(tmp_path / "c"))
    read = spark.read.parquet(str(tmp_path / "c")).where(F.col("author") == "b")
    assert [r["text"] for r in read.collect()] == ["t2"]
    assert "PartitionFilters: [isnotnull(author" in read._jdf.queryExecution().executedPlan().toString()
    writers.write_section_texts(
        rows.select("book", F.col("text").alias("value")), str(tmp_path / "s"), "book"
    )
    assert (tmp_path / "s" / "book=x").is_dir()
    writers.write_corpus(rows, str(tmp_path / "corpus"))
    assert spark.read.text(str(tmp_path / "corpus")).count() == 2


@pytest.mark.parametrize("schema", [readers.SOURCES, readers.CATALOG, readers.CHAPTERS])
def test_schemas_parse(spark, schema):
    assert spark.createDataFrame([], schema).columns


def test_vectors_and_dataset(spark, tmp_path):
    from pyspark.sql import types as T

    vectors = spark.createDataFrame([(1, [0.5, 1.0])], "chunk_id long, vector array<double>")
    writers.write_table(vectors, str(tmp_path / "vec"))
    read = readers.read_vectors(spark, str(tmp_path / "vec"), "chunk_id", T.LongType())
    assert read.collect() == vectors.collect()
    data = spark.createDataFrame(
        [(0, 1, 0, "a b")], "author_id long, book_id long, chunk int, text string"
    )
    writers.write_table(data, str(tmp_path / "d"))
    assert readers.read_dataset(spark, str(tmp_path / "d")).collect() == data.collect()


def test_half_written_output_is_written_again(spark, tmp_path):
    target = tmp_path / "half"
    (target / "_temporary" / "0").mkdir(parents=True)
    (target / "part-00000.parquet").write_bytes(b"broken")
    assert not writers.committed(spark, str(target)) and not writers.committed(spark, str(tmp_path / "none"))
    writers.write_table(spark.range(3), str(target), mode="ignore")
    assert spark.read.parquet(str(target)).count() == 3 and writers.committed(spark, str(target))
    writers.write_table(spark.range(9), str(target), mode="ignore")
    assert spark.read.parquet(str(target)).count() == 3


def test_large_catalogue_is_split(spark, tmp_path):
    header = "id,title,author,authoryearofbirth,authoryearofdeath,language,downloads,subjects,type\n"
    lines = "".join(f"PG{i},\"A title, {i}\",Someone,1800,1870,['en'],1,none,Text\n" for i in range(20_000))
    path = tmp_path / "catalogue.csv"
    path.write_text(header + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
        split, whole = (readers.read_catalog(spark, str(path), multi_line=m) for m in (False, True))
        assert whole.select(F.spark_partition_id()).distinct().count() == 1
        assert split.select(F.spark_partition_id()).distinct().count() > 4
        assert split.count() == whole.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_repeated_keys_are_an_error(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, x string")
    two = spark.createDataFrame([(1, 0.5), (3, 0.1), (None, 0.0)], "k int, y double")
    assert [tuple(r) for r in with_labels(one, two, "k").collect()] == [(1, "a", 0.5)]
    for a, b in ((one.unionAll(one), two), (one, two.unionAll(two))):
        with pytest.raises(Exception, match="repeated k"):
            with_labels(a, b, "k").collect()


@pytest.mark.parametrize("mounted", [True, False])
def test_a_file_for_each_text(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(writers, "_local_root", lambda spark, path: None)
    rows = [("7", "ä\n\nb"), ("8", ""), ("9", None), ("7", "ä\n\nb"), (None, "x"), (None, "x")]
    path = f"{tmp_path}/texts"
    writers.write_texts(spark.createDataFrame(rows, "name string, value string"), path)
    assert writers.committed(spark, path)
    read = readers.read_texts(spark, path)
    name = F.regexp_extract("file_path", r"/(?:name=)?([0-9]+)(?:\.txt|/[^/]*)$", 1)
    got = sorted(tuple(r) for r in read.select(name, "text").collect())
    assert got == [("", "x\nx\n"), ("7", "ä\n\nb\nä\n\nb\n"), ("8", "\n"), ("9", "\n")]


def test_files_of_texts_have_no_folders_of_their_own(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias("name"), F.lit("x").alias("value"))
    writers.write_texts(rows, f"{tmp_path}/texts")
    files = [f for f in (tmp_path / "texts").rglob("*") if f.is_file()]
    assert sorted(f.name for f in files) == sorted(["_SUCCESS", *[f"{i}.txt" for i in range(300)]])
    assert len([f for f in (tmp_path / "texts").rglob("*") if f.is_dir()]) <= 8
    with pytest.raises(FileExistsError):
        writers.write_texts(rows, f"{tmp_path}/texts")
