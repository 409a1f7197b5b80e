"""The pipeline against the same stages by brute force, and its stages on odd rows."""

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from penprint.llm import common, queries, toxicity
from tests.llm.test_operators import TEXTS, hits_expected, near_expected


def test_run_by_brute_force(spark, sf):
    docs = {r.doc_id: r for r in common.table(spark, sf, "documents").collect()}
    scores = {r.doc_id: r.score for r in queries.op3_toxicity(spark, sf).collect()}
    kept = [i for i in sorted(docs) if scores[i] < toxicity.THRESHOLD]
    last = {docs[i].text or "": i for i in kept}
    kept = sorted(last.values())
    kept = near_expected([(i, docs[i].text) for i in kept])
    items = [tuple(r) for r in common.table(spark, sf, "benchmark").select("item_id", "text").collect()]
    hits = hits_expected([(i, docs[i].text) for i in kept], items)
    kept = [i for i, n, hit, _ in hits if not (hit and 20 * hit >= n)]
    assert 0 < len(kept) < len(docs)

    con = duckdb.connect()
    columns = docs[0].asDict().keys()
    con.register("documents", pa.table({c: [docs[i][c] for i in kept] for c in columns}))
    mixed = con.execute(queries.OP8_SQL)
    names = [c[0] for c in mixed.description]
    got = corpus_pipeline.run(spark, sf)
    assert set(columns) <= set(got.columns)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, mixed.fetchall()))
    assert all(r.text == docs[r.doc_id].text for r in got.collect())


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_on_odd_rows(spark, sf, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, toxicity_score string"
    rows = [(i, t, lang, s, None, "r", "x") for i, t, lang, s in TEXTS]
    docs = spark.createDataFrame(rows, schema)
    function = corpus_pipeline.STAGES[stage][1]
    got, none = function(spark, docs, sf), function(spark, docs.limit(0), sf)
    assert none.count() == 0 and got.columns[: len(docs.columns)] == docs.columns
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert got.columns == docs.columns
    # nothing here is toxic or in the benchmark; copies go
    counts = [len(TEXTS), 6, 5, len(TEXTS)]
    if stage < 4:
        assert got.count() == counts[stage]


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
    ]
