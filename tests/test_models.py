"""Models, the whole workflow, scoring and the stream."""

import hashlib
import random
import threading

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from penprint.operators import chunks, vocabulary
from penprint.plans import gated, grid, importance, kernels, models, network, score, workflow
from penprint.plans import sweep as one_sweep
from penprint.settings import Settings, sweep
from penprint.streaming import scoring

AUTHORS = {
    "maurice_leblanc": "lupin thief jewel paris castle needle duke mask".split(),
    "agatha_christie": "poirot poison hastings village doctor murder cocoa affair".split(),
}
COMMON = "the door was open and night came over house with rain".split()
START = "*** START OF THE PROJECT GUTENBERG EBOOK B ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK B ***"


def raw_book(rng, own, chapters=6, words=240):
    toc = "\n".join(f"Chapter {i + 1}. Title {chr(65 + i)}" for i in range(chapters))
    body = ""
    for i in range(chapters):
        text = " ".join(rng.choice(own + COMMON) for _ in range(words))
        body += f"== Part {i + 1}: Title {chr(65 + i)} ==\n{text}\n"
    return f"x\n{START}\nContents\n{toc}\n\n\n\n{body}{END}\n"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    books = [
        (author, f"{author}_{i}", raw_book(rng, own)) for author, own in AUTHORS.items() for i in range(3)
    ]
    df = spark.createDataFrame(books, "author string, book string, raw string")
    patterns = spark.createDataFrame(
        [(b, r"^== Part \d+: {00} ==\n") for _, b, _ in books], "book string, pattern string"
    )
    vocabulary = sorted(set(COMMON).union(*AUTHORS.values()) - {"needle"})
    vectors = spark.createDataFrame(
        [(w, [rng.uniform(-1, 1) for _ in range(8)]) for w in vocabulary],
        "word string, vec array<float>",
    )
    return df, patterns, vectors


@pytest.fixture(scope="module")
def run(corpus):
    df, patterns, vectors = corpus
    settings = Settings(
        remove_stopwords=True, group_by_length=True, group_length=30, remove_out_of_vocab=True
    )
    result = workflow.run_workflow(df, patterns, vectors, 8, settings, max_features=200)
    return result, vectors, settings


def test_workflow_metrics(run):
    result, _, settings = run
    rows = result.metrics.collect()
    assert {(r["model"], r["embedding_type"]) for r in rows} == {
        (m, k) for m in models.MODELS for k in ("glove", "glove-tfidf", "tfidf")
    }
    assert all(r["accuracy"] > 0.8 and 0 <= r["precision"] <= 1 for r in rows)
    assert all(r["group_length"] == 30 and r["remove_stopwords"] for r in rows)
    assert result.rejected.count() == 0
    assert "needle" not in {r["term"] for r in result.features.vocabulary}


def test_sweep_metrics(corpus):
    df, patterns, vectors = corpus
    runs = {
        "short": Settings(group_by_length=True, group_length=30),
        "classes": Settings(group_by_length=True, group_length=60, multiclass=True),
    }
    table, rejected = workflow.run_sweep(
        df, patterns, vectors, 8, runs, classes={a: i for i, a in enumerate(AUTHORS)},
        model_names=("gaussian",), max_features=100,
    )
    rows = {(r["settings_id"], r["embedding_type"]): r for r in table.collect()}
    assert rejected.count() == 0
    assert len(rows) == 6 and all(r["accuracy"] > 0.8 for r in rows.values())
    assert rows["classes", "tfidf"]["multiclass"] and rows["short", "tfidf"]["group_length"] == 30


def test_predictions_are_classes_with_probabilities(run):
    result, _, _ = run
    for cell in result.cells:
        rows = cell.predictions.select(
            "prediction", models.positive_probability().alias("p")
        ).collect()
        assert rows and all(r["prediction"] in (0.0, 1.0) and 0 <= r["p"] <= 1 for r in rows)


def test_curves_of_all_cells(run):
    result, _, _ = run
    some = [c for c in result.cells if c.feature_type == "glove"]
    curves = grid.pr_curves(some, 2)
    assert curves.select("model").distinct().count() == 4
    ends = curves.where(F.col("threshold").isNull())
    assert ends.count() == 4


def test_failing_cell_keeps_its_error(run, monkeypatch):
    result, _, settings = run

    def broken(dims, classes, **options):
        raise RuntimeError("no such model")

    monkeypatch.setitem(models.MODELS, "rf", broken)
    features = result.features
    only = grid.Features({"glove": features.tables["glove"]}, features.dims, features.tfidf, [])
    cells = grid.fit_grid(only, 2, ("rf", "gaussian"))
    rows = {r["model"]: r for r in grid.metrics_table(cells, settings).collect()}
    assert "no such model" in rows["rf"]["error"] and rows["rf"]["accuracy"] is None
    assert rows["gaussian"]["error"] is None and rows["rf"]["group_length"] == 30
    assert grid.pr_curves(cells, 2).select("model").distinct().collect() == [("gaussian",)]
    failed = grid.metrics_table(cells[:1], settings)
    assert failed.count() == 1
    with pytest.raises(ValueError):
        grid.pr_curves(cells[:1], 2)


def test_cells_are_fitted_at_the_same_time_and_kept_in_order(run, monkeypatch):
    result, _, _ = run
    features = result.features
    together = threading.Barrier(2, timeout=60)

    def waiting(dims, classes, **options):
        together.wait()
        return models.gaussian(dims, classes)

    monkeypatch.setitem(models.MODELS, "rf", waiting)
    monkeypatch.setitem(models.MODELS, "svm", waiting)
    only = grid.Features({k: features.tables[k] for k in ("glove", "tfidf")}, features.dims, features.tfidf, [])
    cells = grid.fit_grid(only, 2, ("rf", "svm"))
    assert [(c.feature_type, c.name, c.error) for c in cells] == [(k, m, None) for k in ("glove", "tfidf") for m in ("rf", "svm")]


def test_options_reach_the_models(run):
    result, _, _ = run
    features = result.features
    only = grid.Features({"glove": features.tables["glove"]}, features.dims, features.tfidf, [])
    cells = grid.fit_grid(only, 2, ("rf",), options={"rf": {"trees": 3, "depth": 2}})
    assert cells[0].model.getNumTrees == 3 and max(t.depth for t in cells[0].model.trees) <= 2


def test_fit_on_train_leaves_test_terms_out(spark):
    rows = [(f"c{i}", i % 2, f"shared word{i:03d}") for i in range(60)]
    chunks = spark.createDataFrame(rows, "chunk_id string, label int, text string")
    vectors = spark.createDataFrame([("shared", [1.0])], "word string, vec array<float>")
    made = {
        fit_on: grid.make_features(
            chunks, vectors, 1, Settings(), kinds=("tfidf",), fit_on=fit_on
        )
        for fit_on in ("all", "train")
    }
    train = made["train"].tables["tfidf"].where("is_train").count()
    # one shared word; each text adds a word and a pair
    assert made["train"].dims["tfidf"] == 2 * train + 1
    assert made["all"].dims["tfidf"] == 2 * 60 + 1


def test_weights_of_train_rows_leave_test_words_out(spark):
    rows = [(f"c{i}", i % 2, f"shared word{i:03d}") for i in range(60)]
    chunks = spark.createDataFrame(rows, "chunk_id string, label int, text string")
    vectors = spark.createDataFrame(
        [("shared", [1.0, 0.0]), *[(f"word{i:03d}", [0.0, 1.0]) for i in range(60)]], "word string, vec array<float>"
    )
    made = grid.make_features(chunks, vectors, 2, Settings(), kinds=("glove", "glove-tfidf"), fit_on="train")
    for r in made.tables["glove-tfidf"].collect():
        assert (r["features"][1] > 0) == r["is_train"]
    assert all(r["features"][1] == 0.5 for r in made.tables["glove"].collect())


def test_many_classes(spark):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        label = i % 3
        rows.append((i, float(label), i % 5 > 0, [rng.gauss(3 if k == label else 0, 1) for k in range(3)]))
    df = spark.createDataFrame(
        rows, "chunk_id long, label double, is_train boolean, v array<double>"
    ).select("chunk_id", "label", "is_train", models.as_vector(F.col("v")).alias("features"))
    for name, build in models.MODELS.items():
        _, predictions = models.fit_and_predict(df, build(3, 3), ["chunk_id"])
        share = predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
        assert share > 0.8, name


def test_thresholds(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([0.5, 0.5]),)], ["probability"])
    row = df.select(models.class_at().alias("a"), models.class_at(inclusive=True).alias("b")).first()
    assert (row["a"], row["b"]) == (0, 1)


def test_score_new_texts(spark, run, tmp_path):
    result, vectors, _ = run
    wanted = [("glove", "svm"), ("glove", "lstm"), ("tfidf", "svm"), ("tfidf", "lstm")]
    cells = {(c.feature_type, c.name): c for c in result.cells}
    scorer = score.Scorer([cells[w] for w in wanted], result.features, vectors, 8)
    texts = [
        ("l.txt", "Lupin, thief! The jewel of Paris: castle, mask and duke."),
        ("c.txt", "Poirot: poison — Hastings' doctor; murder in the village, cocoa."),
    ]
    df = spark.createDataFrame(texts, "file_name string, value string")
    rows = {r["file_name"]: r for r in scorer.score(df, "file_name", "value").collect()}
    assert [rows["l.txt"][f"pred_model{i}"] for i in range(4)] == [1, 1, 1, 1]
    assert [rows["c.txt"][f"pred_model{i}"] for i in range(4)] == [0, 0, 0, 0]

    # the same with a saved pipeline on a folder that grows
    path = str(tmp_path / "model")
    score.tfidf_scorer(result.features, cells["tfidf", "svm"]).write().save(path)
    model = PipelineModel.load(path)
    folder, out, state = (tmp_path / n for n in ("in", "out", "state"))
    folder.mkdir()
    for name, text in texts:
        (folder / name).write_text(text)
        stream = scoring.read_new_texts(spark, str(folder))
        scoring.score_stream(stream, model, str(out), str(state)).awaitTermination(120)
    scored = {r["file_name"]: r["prediction"] for r in spark.read.parquet(str(out)).collect()}
    assert scored == {"l.txt": 1, "c.txt": 0}
    with pytest.raises(ValueError):
        score.tfidf_scorer(result.features, cells["glove", "svm"])


def blobs(spark, n=240, dims=4):
    """Three classes around three points; ``chunk_id, label, is_train, features``."""
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 2, (3, dims))
    rows = [
        (f"r{i}", float(i % 3), i % 5 != 0, Vectors.dense(middles[i % 3] + rng.normal(0, 0.5, dims))) for i in range(n)
    ]
    return spark.createDataFrame(rows, ["chunk_id", "label", "is_train", "features"]).repartition(3)


def test_gradients_of_the_gated_unit():
    rng = np.random.default_rng(0)
    weights = gated.start_weights(3, 4, 3)
    x, label = rng.normal(0, 1, (5, 3)), rng.integers(0, 3, 5)
    grads, loss = gated.batch_gradients(weights, x, label)
    for name, values in weights.items():
        for place in np.ndindex(values.shape):
            before, values[place] = values[place], values[place] + 1e-6
            above = gated.batch_gradients(weights, x, label)[1]
            values[place] = before
            assert grads[name][place] == pytest.approx((above - loss) / 1e-6, abs=1e-4)


def test_gated_unit_learns_and_predicts_as_its_weights_say(spark):
    rows = blobs(spark)
    model = gated.GatedUnit(3, "chunk_id", units=8, epochs=6).fit(rows.where("is_train"))
    assert len(model.history) == 6 and model.history[-1] < 0.5 * model.history[0]
    scored = model.transform(rows.where("NOT is_train"))
    assert scored.columns == [*rows.columns, "probability", "prediction"]
    for r in scored.collect():
        raw = np.append(r["features"].toArray(), 1) @ model.weights["gates"]
        a, b, c = raw[:8], raw[8:16], raw[16:]
        state = np.tanh(np.tanh(b) / (1 + np.exp(-a))) / (1 + np.exp(-c))
        logits = np.append(state, 1) @ model.weights["classes"]
        share = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        assert r["probability"].toArray() == pytest.approx(share) and r["prediction"] == share.argmax()
    right = scored.where("label = prediction").count() / scored.count()
    assert right > 0.9


def test_kernel_map_and_machine(spark):
    rows = blobs(spark)
    train = rows.where("is_train")
    points, gamma = kernels.landmarks(train, "chunk_id", 12), kernels.scale_gamma(train)
    values = np.array([r["features"].toArray() for r in train.collect()])
    assert gamma == pytest.approx(1 / (values.shape[1] * values.var())) and points.shape == (12, 4)
    after = kernels.whitening(points, gamma, 0.1)
    mapped = kernels.KernelMap(points, gamma, 0.1, "features", "k", after).transform(rows)
    for r in mapped.collect():
        own = np.tanh(gamma * points @ r["features"].toArray() + 0.1)
        assert r["k"].toArray() == pytest.approx(after @ own, rel=1e-6, abs=1e-6)
    _, scored = models.fit_and_predict(rows, kernels.kernel_svm(3, count=12), ["chunk_id"])
    assert scored.columns == ["chunk_id", "label", "prediction", "probability"]
    assert scored.where("label = prediction").count() / scored.count() > 0.9


def test_importance_by_hand(spark):
    rows = blobs(spark)
    model = models.gaussian(4, 3).fit(rows.where("is_train"))
    test = rows.where("NOT is_train")
    got = {r["feature"]: r for r in importance.permutation_importance(model, test, "chunk_id", [0, 2]).collect()}
    own = sorted(test.collect(), key=lambda r: hashlib.md5(f"42|{r['chunk_id']}".encode()).hexdigest())
    for feature in (0, 2):
        changed = []
        for r, other in zip(own, own[1:] + own[:1]):
            x = r["features"].toArray().copy()
            x[feature] = other["features"][feature]
            changed.append((r["label"], Vectors.dense(x)))
        scored = model.transform(spark.createDataFrame(changed, ["label", "features"]))
        assert got[feature]["permuted"] == pytest.approx(scored.where("label = prediction").count() / len(own))
        assert got[feature]["importance"] == pytest.approx(got[feature]["accuracy"] - got[feature]["permuted"])
    none = importance.permutation_importance(model, test.limit(0), "chunk_id", [0])
    assert none.collect() == []


def test_sweep_in_one_fit_equals_fitted_models(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    vectors = spark.createDataFrame([("the", [1.0, 0.2]), ("der", [-1.0, 0.4]), ("la", [0.1, 2.0])], "word string, vec array<float>")
    runs = {k: v for k, v in sweep().items() if k in ("length_100", "multiclass")}
    classes = {"de": 0, "en": 1, "es": 2, "fr": 3}
    table = one_sweep.sweep_metrics(docs, vectors, 2, "doc_id", "lang", runs, classes, "fr", max_features=50)
    got = {(r["settings_id"], r["embedding_type"]): (r["accuracy"], r["precision"], r["recall"], r["f1-score"]) for r in table.collect()}
    assert len(got) == 6
    for name, s in runs.items():
        pieces = chunks.prepare_chunks(docs, s, "text", ["doc_id", "lang"]).where("text != ''")
        pieces = pieces.withColumn("chunk_id", F.concat_ws("/", "doc_id", "chunk"))
        features = grid.make_features(grid.labelled(pieces, s, "lang", classes, "fr"), vectors, 2, s, max_features=50)
        cells = grid.fit_grid(features, 4 if s.multiclass else 2, ("gaussian",))
        for r in grid.metrics_table(cells, s).collect():
            expected = (r["accuracy"], r["precision"], r["recall"], r["f1-score"])
            assert got[name, r["embedding_type"]] == pytest.approx(expected, abs=0.02)


def test_network_gradient():
    rng = np.random.default_rng(1)
    layers = [6, 3, 4]
    flat = network.start_weights(layers, 2) + 0.1
    used, label = np.array([0, 2, 5]), np.array([0, 3, 1, 1, 2])
    x = rng.standard_normal((5, 3))

    def loss(w):
        return network.block_gradient(network.layers_of(w, layers), label, used, x)[0]

    got = np.zeros(len(flat))
    sums = network.layers_of(got, layers)
    first, *others = network.block_gradient(network.layers_of(flat, layers), label, used, x)[1]
    sums[0][used] += first
    for s, g in zip(sums[1:], others):
        s += g
    step = 1e-6 * np.eye(len(flat))
    assert np.allclose(got, [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in step], atol=1e-6)


def test_network_blocks_hold_used_dimensions_only(spark):
    dims, rng = 50_000, random.Random(3)
    rows = []
    for i in range(600):
        places = sorted({i % 2, *(rng.randrange(2, 40) for _ in range(5))})
        rows.append((i, float(i % 2), i % 5 > 0, Vectors.sparse(dims, places, [1.0] * len(places))))
    df = spark.createDataFrame(rows, ["id", "label", "is_train", "features"])
    blocks = network.pack(df, dims, 2, 3).collect()
    assert max(len(b["columns"]) // 4 for b in blocks) <= 40
    assert sum(len(b["labels"]) // 4 for b in blocks) == 600
    estimator = models.mlp(dims, 2, hidden=4, iterations=30)
    model, predictions = models.fit_and_predict(df, estimator, ["id"])
    assert predictions.where("label = prediction").count() == 120
    assert model.history[-1] < 0.05 < model.history[0] and model.history == sorted(model.history, reverse=True)


def test_network_is_the_same_on_dense_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((90, 3)).round(3)
    x[:, 1] = 0
    label = (x[:, 0] > 0).astype(float) + (x[:, 2] > 0.5)
    dense = spark.createDataFrame([(float(y), Vectors.dense(v)) for y, v in zip(label, x)], ["label", "features"])
    sparse = spark.createDataFrame(
        [(float(y), Vectors.sparse(3, [0, 2], [v[0], v[2]])) for y, v in zip(label, x)], ["label", "features"]
    )
    mixed = dense.limit(40).unionAll(sparse)
    one, two = (models.mlp(3, 3, hidden=5, iterations=5).fit(d) for d in (dense, sparse))
    assert np.allclose(one.history, two.history, rtol=1e-4)
    assert models.mlp(3, 3, hidden=5, iterations=2).fit(mixed).history[0] > 0
    # Spark's model has the weights of the solver, in its own order
    hidden, bias, out, out_bias = network.layers_of(one.weights.toArray(), [3, 5, 3])
    logits = 1 / (1 + np.exp(-(x @ hidden + bias))) @ out + out_bias
    assert [r[0] for r in one.transform(dense).select("prediction").collect()] == logits.argmax(1).tolist()


@pytest.mark.parametrize("label,features", [(None, [0.0, 1.0]), (2.0, [0.0, 1.0]), (0.0, [0.0]), (0.0, [0.0, float("nan")]), (1.0, None)])
def test_network_refuses_broken_rows(spark, label, features):
    good = [(float(i % 2), Vectors.dense(i % 2, 1.0)) for i in range(4)]
    rows = [*good, (label, Vectors.dense(features) if features else None)]
    with pytest.raises(Exception, match="null|whole numbers|finite"):
        models.mlp(2, 2, hidden=2).fit(spark.createDataFrame(rows, ["label", "features"]))
    with pytest.raises(ValueError, match="no rows"):
        models.mlp(2, 2, hidden=2).fit(spark.createDataFrame(good, ["label", "features"]).limit(0))


def test_network_stops_when_the_latest_losses_are_near():
    scale = np.geomspace(1, 1e-4, 8)

    def loss(w):
        return float(1 + (scale * (w - 1) ** 2).sum()), 2 * scale * (w - 1)

    found, losses = network.minimise(loss, np.zeros(8), 500, 1e-4)
    # as Spark's solver: over the last 20 values, and by the first one
    ends = [abs(losses[i] - max(losses[max(i - 19, 0) : i + 1])) <= 1e-4 * losses[0] for i in range(1, len(losses))]
    assert (ends[-1] and not any(ends[:-1])) or np.linalg.norm(loss(found)[1]) <= 1e-4 * losses[-1]
    assert losses == sorted(losses, reverse=True) and len(network.minimise(loss, np.zeros(8), 3, 0.0)[1]) == 4


def test_network_blocks_hold_rows_of_the_same_dimensions(spark):
    rng = random.Random(6)
    rows = []
    for i in range(1024):
        # two kinds of rows in turn, each with a word of its own that all its rows hold
        places = sorted({100 * (i % 2), *(100 * (i % 2) + rng.randrange(1, 100) for _ in range(8))})
        rows.append((1.0, Vectors.sparse(200, places, [float(i + 1)] * len(places))))
    df = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    blocks = network.pack(df, 200, 2, 2).collect()
    assert sum(len(b["labels"]) // 4 for b in blocks) == 1024
    assert max(len(b["columns"]) // 4 for b in blocks) <= 100
    found = []
    for b in blocks:
        label, used, at, x = (np.frombuffer(b[c], k) for c, k in (("labels", "<i4"), ("columns", "<i4"), ("at", "<i4"), ("x", "<f4")))
        row, place = np.divmod(at, len(used))
        for r in range(len(label)):
            found.append((float(label[r]), sorted(zip(used[place[row == r]].tolist(), x[row == r].tolist()))))
    assert sorted(found) == sorted((y, [(int(i), v) for i, v in zip(f.indices, f.values)]) for y, f in rows)


def test_network_scales_dimensions_by_their_values():
    assert np.allclose(network.scales(np.array([16.0, 0.0, 1.0, 256.0])) ** -4, np.array([16, 91, 1, 256]) / 91)
    assert network.scales(np.zeros(3)).tolist() == [1, 1, 1]
    assert network.scales(np.array([1.0, 1e-300, 0.0])).max() == network.MOST_SCALE


def test_frequent_terms_keep_the_ties_of_the_last_place(spark):
    rows = [("p", "a", 9), ("p", "b", 4), ("p", "c", 4), ("p", "d", 1), ("q", "a", 1)]
    counts = spark.createDataFrame(rows, "prepared string, term string, cf long")
    for n, expected in ((1, "a"), (2, "abc"), (3, "abc"), (4, "abcd"), (9, "abcd")):
        got = one_sweep._frequent(counts, n).where("prepared = 'p'").collect()
        assert sorted(r["term"] for r in got) == list(expected)


def test_sweep_counts_words_and_pairs_that_may_be_among_the_most_frequent(spark):
    rng = random.Random(8)
    rows = [(p, f"{p}{i}", " ".join(f"{p}{min(int(rng.paretovariate(0.7)), 60)}0" for _ in range(20))) for p in "ab" for i in range(40)]
    texts = spark.createDataFrame([*rows, ("c", "c0", "few words")], "prepared string, chunk_id string, text string")
    got = one_sweep._likely(texts, ["a", "b", "c"], 5).collect()
    for name in "ab":
        words = vocabulary.with_terms(texts.where(F.col("prepared") == name), "text", 1, 1)
        every = vocabulary.corpus_counts(words, low=1, high=2).collect()
        best = sorted(every, key=lambda r: (-r["cf"], r["term"]))[:5]
        own = {(r["term"], r["cf"], r["df"]) for r in got if r["prepared"] == name}
        assert {tuple(r) for r in best} <= own and len(own) < len(every) / 3
    # a preparation with fewer words than places has all its terms
    assert {r["term"] for r in got if r["prepared"] == "c"} == {"few", "words", "few words"}


def test_sweep_sums_and_gains_by_hand(spark):
    schema = "prepared string, chunk_id string, kind string, at array<int>, x array<double>"
    features = [("p", "1", "tfidf", [0, 2], [3.0, 1.0]), ("p", "2", "tfidf", [2], [2.0]), ("p", "3", "tfidf", [1], [1.0]),
                ("p", "4", "tfidf", [0, 1], [2.5, 0.1]), ("p", "5", "tfidf", [2], [2.0]), ("p", "1", "glove", None, [0.5, 0.0, 1.0])]
    marked = [("r", "p", "1", 0, True), ("r", "p", "2", 1, True), ("r", "p", "3", 1, True), ("r", "p", "4", 0, False),
              ("r", "p", "5", 0, False), ("r", "p", "9", None, True)]
    features = spark.createDataFrame(features, schema).repartition(3)
    marked = spark.createDataFrame(marked, "settings_id string, prepared string, chunk_id string, label int, is_train boolean")
    dims = {("r", "tfidf"): 3, ("r", "glove"): 3}
    train = features.join(marked.where("is_train AND label IS NOT NULL"), ["prepared", "chunk_id"])
    sums = {k: [x.tolist() for x in v] for k, v in one_sweep.class_sums(train, dims).items()}
    assert sums == {
        ("r", "tfidf", 0): [[3, 0, 1], [9, 0, 1]], ("r", "tfidf", 1): [[0, 1, 2], [0, 1, 4]], ("r", "glove", 0): [[0.5, 0, 1], [0.25, 0, 1]],
    }
    got = one_sweep.gaussian_predictions(features, marked.where("label IS NOT NULL"), dims).where("kind = 'tfidf'").collect()
    assert {r["chunk_id"]: (r["label"], r["prediction"]) for r in got}["5"] == (0, 1)


def test_sweep_with_repeated_chunks(spark):
    schema = "prepared string, chunk_id string, kind string, at array<int>, x array<double>"
    rows = [("p", i, "tfidf", [at], [1.0]) for i, at in (("1", 0), ("1", 0), ("3", 1), ("4", 0), ("5", 1))]
    marked = [("r", "p", "1", 0, True), ("r", "p", "1", 0, True), ("r", "p", "3", 1, True), ("r", "p", "5", 1, False)]
    got = one_sweep.gaussian_predictions(
        spark.createDataFrame(rows, schema),
        spark.createDataFrame(marked, "settings_id string, prepared string, chunk_id string, label int, is_train boolean"),
        {("r", "tfidf"): 2},
    )
    # the variance of class 0 is below zero; its score stays a number
    assert [(r["chunk_id"], r["prediction"]) for r in got.collect()] == [("5", 1)]
