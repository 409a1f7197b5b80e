"""Metrics, curves and models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import sqltext as q
from checks.features import DIMS, doc_words, word_vectors
from checks.registry import check, table
from checks.text import CLASSES
from penprint.functions import keys
from penprint.functions import lexicon as lex
from penprint.operators import metrics, reports
from penprint.operators import vocabulary as vo
from penprint.operators import wordvectors as wv
from penprint.plans import gated, grid, importance, kernels, models, score
from penprint.session import new_path, staged
from penprint.settings import Settings
from penprint.streaming import scoring

SETTINGS = Settings(multiclass=True)


def documents(spark, sf):
    return table(spark, sf, "documents")


CLASS_SQL = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END"

# a simple guess of the language from its special letters
RULED = f"""
ruled AS (
  SELECT doc_id, {CLASS_SQL} AS label,
    CASE WHEN regexp_matches(text, '[äöüß]') THEN 0 WHEN regexp_matches(text, '[ñíó]') THEN 2
      WHEN regexp_matches(text, '[éèêç]') THEN 3 ELSE 1 END AS prediction FROM documents),
confusion AS (SELECT label, prediction, count(*) AS n FROM ruled GROUP BY label, prediction)"""

SCORES = """
sides AS (
  SELECT label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM confusion
  UNION ALL SELECT prediction, 0, n, 0 FROM confusion),
class_sums AS (SELECT class, sum(support) AS s, sum(predicted) AS p, sum(hits) AS h FROM sides GROUP BY class),
scores AS (
  SELECT class, coalesce(h / nullif(p, 0), 0) AS precision, coalesce(h / nullif(s, 0), 0) AS recall,
    coalesce(2 * h / nullif(s + p, 0), 0) AS f1, CAST(s AS BIGINT) AS support FROM class_sums)"""


def ruled(spark, sf):
    text = F.col("text")
    guess = (
        F.when(text.rlike("[äöüß]"), 0).when(text.rlike("[ñíó]"), 2).when(text.rlike("[éèêç]"), 3).otherwise(1)
    )
    return documents(spark, sf).select(
        "doc_id", keys.class_label(F.col("lang"), CLASSES).alias("label"), guess.alias("prediction")
    )


def rounded(df, *names):
    for name in names:
        df = df.withColumn(name, F.round(name, 6))
    return df


@check(f"WITH {RULED} SELECT * FROM confusion")
def confusion_matrix(spark, sf):
    return metrics.confusion(ruled(spark, sf))


@check(f"""WITH {RULED}
SELECT round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n), 6) AS accuracy FROM confusion""")
def accuracy(spark, sf):
    return rounded(metrics.accuracy(metrics.confusion(ruled(spark, sf))), "accuracy")


@check(f"""WITH {RULED}, {SCORES}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores""")
def class_prf(spark, sf):
    return rounded(
        metrics.class_scores(metrics.confusion(ruled(spark, sf))), "precision", "recall", "f1"
    )


@check(f"""WITH {RULED}, {SCORES}
SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1,
  avg(support) AS support FROM scores""")
def macro_prf(spark, sf):
    return rounded(
        metrics.macro_scores(metrics.confusion(ruled(spark, sf))), "precision", "recall", "f1"
    )


@check(f"""WITH {RULED}, {SCORES}
SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores WHERE class = 3""")
def positive_prf(spark, sf):
    counts = metrics.confusion(ruled(spark, sf))
    return rounded(metrics.positive_scores(counts, positive=3), "precision", "recall", "f1")


@check(f"""WITH {RULED}, {SCORES},
rows AS (
  SELECT CAST(class AS VARCHAR) AS entry, precision, recall, f1, CAST(support AS DOUBLE) AS support FROM scores
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS DOUBLE) FROM scores
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), CAST(sum(support) AS DOUBLE) FROM scores
  UNION ALL SELECT 'accuracy', a, a, a, n FROM (
    SELECT sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n) AS a, CAST(sum(n) AS DOUBLE) AS n FROM confusion))
SELECT entry, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rows""")
def classification_report(spark, sf):
    return rounded(
        metrics.report(metrics.confusion(ruled(spark, sf))), "precision", "recall", "f1"
    )


# score of a document: its mean word length; positive class: French
WORD_LENGTH = r"""
scored AS (
  SELECT CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS label,
    coalesce(length(array_to_string(w, '')) / nullif(len(w), 0), 0) AS score
  FROM (SELECT lang, regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[-''][\p{L}\p{N}_]+)*') AS w FROM documents)),
by_score AS (SELECT score, count(*) AS n, sum(label) AS pos FROM scored GROUP BY score)"""


def word_length_scores(spark, sf):
    rows = reports.style_figures(documents(spark, sf), "text", ["lang"])
    return rows.select(
        keys.binary_label(F.col("lang"), "fr").alias("label"), F.col("word_length").alias("score")
    )


@check(f"""WITH {WORD_LENGTH},
running AS (
  SELECT score, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM by_score
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT round(score, 9) AS threshold, round(cp / cn, 9) AS precision,
  round(cp / (SELECT sum(pos) FROM by_score), 9) AS recall FROM running
UNION ALL SELECT NULL, 1, 0""")
def pr_curve(spark, sf):
    curve = metrics.pr_curve(word_length_scores(spark, sf), "score", "label")
    return curve.select(*[F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall")])


@check(f"""WITH {WORD_LENGTH},
running AS (SELECT pos, n - pos AS neg, sum(n - pos) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS upto FROM by_score)
SELECT round(sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM running""")
def roc_auc(spark, sf):
    area = metrics.roc_auc(word_length_scores(spark, sf), "score", "label")
    return area.select(F.round("auc", 9).alias("auc"))


GAUSSIAN = f"""
{q.MEANS},
data AS (
  SELECT doc_id, {CLASS_SQL} AS label, dim, value, {q.bucket('doc_id', '100')} < 80 AS is_train FROM means),
train AS (SELECT * FROM data WHERE is_train),
smoothing AS (SELECT 1e-9 * max(v) AS eps FROM (SELECT var_pop(value) AS v FROM train GROUP BY dim)),
stats AS (SELECT label AS class, dim, avg(value) AS mu, var_pop(value) + (SELECT eps FROM smoothing) AS var FROM train GROUP BY label, dim),
priors AS (SELECT label AS class, ln(count(*) / (SELECT count(*) FROM train WHERE dim = 0)) AS prior FROM train WHERE dim = 0 GROUP BY label),
logs AS (
  SELECT doc_id, d.label, class, any_value(prior) + sum(-0.5 * ln(2 * pi() * var) - (value - mu) * (value - mu) / (2 * var)) AS lp
  FROM data d JOIN stats USING (dim) JOIN priors USING (class) WHERE NOT is_train GROUP BY doc_id, d.label, class),
predicted AS (
  SELECT doc_id, label, CAST(arg_max(class, lp) AS INTEGER) AS prediction, max(lp) AS best FROM logs GROUP BY doc_id, label)"""


def text_vectors(spark, sf):
    """Mean word vectors of the documents with their class and split."""
    pooled = wv.mean_vectors(
        doc_words(spark, sf), "words", word_vectors(spark, sf), "doc_id", DIMS
    )
    rows = documents(spark, sf).select(
        "doc_id",
        keys.class_label(F.col("lang"), CLASSES).cast("double").alias("label"),
        keys.is_train_row(F.col("doc_id")).alias("is_train"),
    )
    joined = rows.join(pooled, "doc_id")
    return staged(
        joined.select(
            "doc_id", "label", "is_train", models.as_vector(F.col("vector")).alias("features")
        ),
        "text-vectors",
    )


def text_tfidf(spark, sf):
    """TF-IDF vectors of the documents with their class and split."""
    docs = documents(spark, sf).select(
        "doc_id",
        "text",
        keys.class_label(F.col("lang"), CLASSES).cast("double").alias("label"),
        keys.is_train_row(F.col("doc_id")).alias("is_train"),
    )
    model, rows = vo.fit_tfidf(docs, output="features")
    return staged(model.transform(docs).drop("text"), "text-tfidf"), len(rows)


def _predict(name, features, dims):
    estimator = models.MODELS[name](dims, len(CLASSES))
    _, predictions = models.fit_and_predict(features, estimator, ["doc_id"])
    return predictions


def _rows(predictions):
    return predictions.select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        F.round(F.array_max(vector_to_array("probability")), 4).alias("probability"),
    )


@check(f"""WITH {GAUSSIAN}
SELECT p.doc_id, p.label, prediction, round(1 / sum(exp(lp - best)), 4) AS probability
FROM predicted p JOIN logs l ON l.doc_id = p.doc_id GROUP BY p.doc_id, p.label, prediction""")
def gaussian_nb(spark, sf):
    return _rows(_predict("gaussian", text_vectors(spark, sf), DIMS))


@check(f"""WITH {GAUSSIAN},
confusion AS (SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction), {SCORES}
SELECT 'gaussian' AS model, 'glove' AS embedding_type,
  (SELECT round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n), 6) FROM confusion) AS accuracy,
  round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS "f1-score",
  avg(support) AS support, false AS group_by_paragraph, false AS remove_stopwords, false AS keep_punctuation,
  false AS group_by_length, CAST(NULL AS INTEGER) AS group_length, true AS multiclass, false AS remove_out_of_vocab,
  'macro' AS average
FROM scores""")
def metrics_table(spark, sf):
    predictions = _predict("gaussian", text_vectors(spark, sf), DIMS)
    row = metrics.metrics_row(predictions, "gaussian", "glove", SETTINGS)
    return rounded(row, "accuracy", "precision", "recall", "f1-score")


@check(f"""WITH {GAUSSIAN},
moments AS MATERIALIZED (SELECT * FROM stats),
tested AS MATERIALIZED (SELECT doc_id, label, dim, value FROM data WHERE NOT is_train),
places AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id)) - 1 AS place FROM tested WHERE dim = 0),
nexts AS MATERIALIZED (
  SELECT a.doc_id, b.doc_id AS other FROM places a JOIN places b ON b.place = (a.place + 1) % (SELECT count(*) FROM places)),
densities AS MATERIALIZED (
  SELECT doc_id, label, dim, class, value, -0.5 * ln(2 * pi() * var) - (value - mu) * (value - mu) / (2 * var) AS density
  FROM tested JOIN moments USING (dim)),
odds AS MATERIALIZED (
  SELECT doc_id, class, any_value(label) AS label, any_value(prior) + sum(density) AS lp
  FROM densities JOIN priors USING (class) GROUP BY doc_id, class),
exchanged AS MATERIALIZED (
  SELECT nexts.doc_id, d.dim, d.class, d.density FROM nexts JOIN densities d ON d.doc_id = nexts.other),
permuted AS (
  SELECT e.doc_id, e.dim, any_value(o.label) AS label, arg_max(e.class, lp - d.density + e.density) AS prediction
  FROM exchanged e JOIN densities d ON d.doc_id = e.doc_id AND d.dim = e.dim AND d.class = e.class
  JOIN odds o ON o.doc_id = e.doc_id AND o.class = e.class GROUP BY e.doc_id, e.dim),
whole AS (
  SELECT avg((label = prediction)::INTEGER) AS accuracy
  FROM (SELECT any_value(label) AS label, arg_max(class, lp) AS prediction FROM odds GROUP BY doc_id))
SELECT dim::INTEGER AS feature, round(any_value(accuracy), 6) AS accuracy, round(avg((label = prediction)::INTEGER), 6) AS permuted,
  round(any_value(accuracy) - avg((label = prediction)::INTEGER), 6) + 0.0 AS importance
FROM permuted, whole GROUP BY dim""")
def feature_importance(spark, sf):
    """What the Gaussian model loses on test rows when one dimension is exchanged between them."""
    features = text_vectors(spark, sf)
    model = models.gaussian(DIMS, len(CLASSES)).fit(features.where("is_train"))
    table = importance.permutation_importance(model, features.where("NOT is_train"), "doc_id", list(range(DIMS)))
    return table.select(
        "feature", *[(F.round(c, 6) + 0.0).alias(c) for c in ("accuracy", "permuted", "importance")]
    )


KERNEL_LANDMARKS = 16


@check(f"""WITH {q.MEANS},
data AS MATERIALIZED (SELECT doc_id, dim, value, {q.bucket('doc_id', '100')} < 80 AS is_train FROM means),
points AS MATERIALIZED (
  SELECT doc_id AS point, row_number() OVER (ORDER BY md5('42|' || doc_id)) - 1 AS landmark
  FROM (SELECT DISTINCT doc_id FROM data WHERE is_train) ORDER BY md5('42|' || doc_id) LIMIT {KERNEL_LANDMARKS}),
gamma AS (SELECT 1 / ({DIMS} * var_pop(value)) AS g FROM data WHERE is_train),
marks AS MATERIALIZED (SELECT landmark, dim, value FROM data JOIN points ON doc_id = point)
SELECT doc_id, landmark, round(tanh(any_value(g) * sum(data.value * marks.value)), 6) + 0.0 AS value
FROM data JOIN marks USING (dim), gamma GROUP BY doc_id, landmark""")
def svm_kernel_features(spark, sf):
    """The sigmoid kernel of every text with the landmarks."""
    features = text_vectors(spark, sf)
    train = features.where("is_train")
    points = kernels.landmarks(train, "doc_id", KERNEL_LANDMARKS)
    mapped = kernels.KernelMap(points, kernels.scale_gamma(train), 0.0, "features", "kernel").transform(features)
    rows = mapped.select("doc_id", F.posexplode(vector_to_array("kernel")).alias("landmark", "value"))
    return rows.select("doc_id", F.col("landmark").cast("long").alias("landmark"), (F.round("value", 6) + 0.0).alias("value"))


TEST_ROWS = f"""test AS (
  SELECT doc_id, {CLASS_SQL} AS label, CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS french
  FROM documents WHERE {q.bucket('doc_id', '100')} >= 80)"""

# What must hold for a model whose numbers depend on a solver.
INVARIANTS = f"""WITH {TEST_ROWS}
SELECT doc_id, label, 'known class' AS checked, true AS holds FROM test
UNION ALL SELECT doc_id, label, 'probability in range', true FROM test
UNION ALL SELECT NULL, NULL, 'better than the largest class', true"""


def _invariants(predictions):
    best = F.array_max(vector_to_array("probability"))
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p)
    rows = predictions.select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("known class").alias("checked"),
                    F.col("prediction").isin(*CLASSES.values()).alias("holds"),
                ),
                F.struct(
                    F.lit("probability in range").alias("checked"),
                    (best.between(1 / len(CLASSES), 1 + 1e-9) & (F.abs(total - 1) < 1e-6)).alias("holds"),
                ),
            )
        ),
    )
    right = predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("x")).scalar()
    largest = predictions.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("x"))
    summary = largest.select(
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("int").alias("label"),
        F.lit("better than the largest class").alias("checked"),
        (right > F.col("x")).alias("holds"),
    )
    return rows.unionByName(summary)


@check(INVARIANTS)
def svm(spark, sf):
    features, dims = text_tfidf(spark, sf)
    return _invariants(_predict("svm", features, dims))


@check(INVARIANTS)
def svm_kernel(spark, sf):
    """The sigmoid kernel machine on the word vectors."""
    estimator = kernels.kernel_svm(len(CLASSES), "doc_id")
    _, predictions = models.fit_and_predict(text_vectors(spark, sf), estimator, ["doc_id"])
    return _invariants(predictions)


@check(INVARIANTS)
def random_forest(spark, sf):
    features, dims = text_tfidf(spark, sf)
    return _invariants(_predict("rf", features, dims))


@check(INVARIANTS)
def mlp(spark, sf):
    features, dims = text_tfidf(spark, sf)
    return _invariants(_predict("lstm", features, dims))


@check(INVARIANTS)
def gated_unit(spark, sf):
    """The gated network on the word vectors, ten epochs of mini-batches."""
    estimator = gated.GatedUnit(len(CLASSES), "doc_id")
    _, predictions = models.fit_and_predict(text_vectors(spark, sf), estimator, ["doc_id"])
    return _invariants(predictions)


@check(f"SELECT unnest(range(1, {gated.EPOCHS} + 1))::INTEGER AS epoch, true AS finite, true AS below_the_first")
def gated_loss(spark, sf):
    """Mean loss of each epoch of the gated network: it stays below that of the first."""
    model = gated.GatedUnit(len(CLASSES), "doc_id").fit(text_vectors(spark, sf).where("is_train"))
    losses = [(i, loss) for i, loss in enumerate(model.history, 1)]
    rows = spark.createDataFrame(losses, "epoch int, loss double")
    return rows.select(
        "epoch",
        (~F.isnan("loss") & (F.col("loss") < 100)).alias("finite"),
        (F.col("loss") <= F.lit(model.history[0])).alias("below_the_first"),
    )


@check("SELECT true AS ordered, true AS falls, true AS finite")
def training_loss(spark, sf):
    """Loss per iteration of the network on word vectors: it never rises, and falls."""
    features = text_vectors(spark, sf)
    model = models.mlp(DIMS, len(CLASSES)).fit(features.where("is_train"))
    losses = models.loss_history(features, model)
    pairs = F.array_sort(F.collect_list(F.struct("iteration", "loss")))
    loss = F.transform(pairs, lambda p: p["loss"])
    steps = F.zip_with(F.slice(loss, 1, F.size(loss) - 1), F.slice(loss, 2, F.size(loss)), lambda a, b: a >= b)
    return losses.agg(
        F.forall(steps, lambda x: x).alias("ordered"),
        (F.get(loss, F.lit(0)) > F.element_at(loss, -1)).alias("falls"),
        F.forall(loss, lambda x: ~F.isnan(x)).alias("finite"),
    )


def _features(spark, sf, settings, kinds=("glove", "glove-tfidf", "tfidf"), fit_on="all"):
    chunks = documents(spark, sf).select(F.col("doc_id").alias("chunk_id"), "lang", "text")
    labelled = grid.labelled(chunks, settings, "lang", CLASSES, "fr")
    return grid.make_features(
        labelled, word_vectors(spark, sf), DIMS, settings, kinds=kinds, fit_on=fit_on
    )


GRID = "(VALUES ('rf'), ('gaussian'), ('svm'), ('lstm')) m(model), (VALUES ('glove'), ('glove-tfidf'), ('tfidf')) k(embedding_type)"


@check(f"""WITH {TEST_ROWS}
SELECT model, embedding_type, CASE WHEN model = 'lstm' THEN 'binary' ELSE 'macro' END AS average,
  CASE WHEN model = 'lstm' THEN sum(french) ELSE count(*) / 2 END AS support, true AS holds
FROM {GRID}, test GROUP BY model, embedding_type""")
def model_grid(spark, sf):
    """All models on all feature types, the two-class task: every cell is fitted, scores are in range."""
    settings = Settings()
    table = grid.metrics_table(grid.fit_grid(_features(spark, sf, settings), 2), settings)
    holds = F.col("error").isNull()
    for name in ("accuracy", "precision", "recall", "f1-score"):
        holds &= F.col(f"`{name}`").between(0, 1)
    return table.select("model", "embedding_type", "average", "support", holds.alias("holds"))


@check(f"""SELECT embedding_type AS feature_type, model, class, true AS holds
FROM {GRID}, (VALUES (0), (1), (2), (3)) c(class)""")
def model_pr_curves(spark, sf):
    """Curves of all models on all feature types, one per class, in one pass."""
    curves = grid.pr_curves(grid.fit_grid(_features(spark, sf, SETTINGS), len(CLASSES)), len(CLASSES))
    end = F.col("threshold").isNull()
    return curves.groupBy("feature_type", "model", "class").agg(
        (
            (F.count(F.when(end, 1)) == 1)
            & (F.max("recall") == 1)
            & (F.min(F.when(~end, F.col("recall"))) >= 0)
            & F.min("precision").between(0, 1)
            & (F.max("precision") == 1)
            & (F.count(F.when(~end, 1)) == F.count_distinct("threshold"))
        ).alias("holds")
    )


@check("SELECT item_id, true AS holds FROM benchmark")
def score_new_texts(spark, sf):
    """Models fitted on the documents give each benchmark text one of the two classes."""
    features = _features(spark, sf, Settings(), kinds=("glove", "tfidf"))
    cells = grid.fit_grid(features, 2, ("svm", "lstm"))
    scorer = score.Scorer(cells, features, word_vectors(spark, sf), DIMS)
    scored = scorer.score(table(spark, sf, "benchmark"), "item_id", "text")
    holds = F.lit(True)
    for i in range(4):
        holds &= F.col(f"pred_model{i}").isin(0, 1)
    return scored.select("item_id", holds.alias("holds"))


def _gaussian_sql(means: str, label: str) -> str:
    """Gaussian naive Bayes on the vectors ``means (doc_id, dim, value)``, exact: ``predicted``."""
    return GAUSSIAN.replace(q.MEANS, means).replace(f"{CLASS_SQL} AS label", f"{label} AS label")


TWO_CLASS = "CASE WHEN lang = 'fr' THEN 1 ELSE 0 END"
WEIGHTED_MEANS = f"""
{q.VECTORS},
fitted AS (SELECT * FROM doc_words WHERE {q.bucket('doc_id', '100')} < 80),
weights AS (
  SELECT word, ln((1 + (SELECT count(*) FROM documents WHERE {q.bucket('doc_id', '100')} < 80)) / (1 + count(*))) + 1 AS idf
  FROM fitted GROUP BY word),
sums AS (
  SELECT doc_id, dim, sum(n * n * idf * CAST(vec[dim + 1] AS DOUBLE)) / sum(n * n * idf) AS value
  FROM doc_words JOIN vectors USING (word) JOIN weights USING (word), dims GROUP BY doc_id, dim),
means AS (SELECT doc_id, lang, dim, coalesce(value, 0) AS value
  FROM (SELECT doc_id, lang, dim FROM documents, dims) LEFT JOIN sums USING (doc_id, dim))"""


def _grid_row(kind: str, means: str) -> str:
    return f"""SELECT * FROM (WITH {_gaussian_sql(means, TWO_CLASS)},
confusion AS (SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction), {SCORES}
SELECT '{kind}' AS embedding_type,
  (SELECT round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n), 6) FROM confusion) AS accuracy,
  round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM scores)"""


# the plain mean sees the words between blanks, in their own case
SPOKEN_MEANS = f"""
{q.VECTORS},
spoken AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(trim(text), ' ')) AS word FROM documents) GROUP BY ALL),
sums AS (
  SELECT doc_id, dim, sum(n * CAST(vec[dim + 1] AS DOUBLE)) / sum(n) AS value
  FROM spoken JOIN vectors USING (word), dims GROUP BY doc_id, dim),
means AS (SELECT doc_id, lang, dim, coalesce(value, 0) AS value
  FROM (SELECT doc_id, lang, dim FROM documents, dims) LEFT JOIN sums USING (doc_id, dim))"""


@check(f"{_grid_row('glove', SPOKEN_MEANS)} UNION ALL {_grid_row('glove-tfidf', WEIGHTED_MEANS)}")
def model_grid_gaussian(spark, sf):
    """Features fitted on the training rows, Gaussian cells of the grid, metrics: exact end to end."""
    settings = Settings()
    features = _features(spark, sf, settings, kinds=("glove", "glove-tfidf"), fit_on="train")
    table = grid.metrics_table(grid.fit_grid(features, 2, ("gaussian",)), settings)
    return table.select(
        "embedding_type",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")],
        F.round("`f1-score`", 6).alias("f1"),
    )


@check(f"""WITH {_gaussian_sql(SPOKEN_MEANS, TWO_CLASS)},
chances AS (
  SELECT p.doc_id, p.label, sum(CASE WHEN class = 1 THEN exp(lp - best) ELSE 0 END) / sum(exp(lp - best)) AS p
  FROM predicted p JOIN logs l ON l.doc_id = p.doc_id GROUP BY p.doc_id, p.label)
SELECT doc_id, rule, label, (CASE rule WHEN '> 0.5' THEN p > 0.5 WHEN '>= 0.5' THEN p >= 0.5 WHEN '> 0.999' THEN p > 0.999
  ELSE p >= 0 END)::INTEGER AS prediction
FROM chances, (VALUES ('> 0.5'), ('>= 0.5'), ('> 0.999'), ('>= 0')) r(rule)""")
def threshold_predictions(spark, sf):
    """Class 1 by thresholds of its probability, the threshold itself in or out."""
    features = _features(spark, sf, Settings(), kinds=("glove",))
    rules = {"> 0.5": (0.5, False), ">= 0.5": (0.5, True), "> 0.999": (0.999, False), ">= 0": (0.0, True)}
    out = None
    for rule, (threshold, inclusive) in rules.items():
        (cell,) = grid.fit_grid(features, 2, ("gaussian",), threshold=threshold, inclusive=inclusive)
        rows = cell.predictions.select(
            F.col("chunk_id").alias("doc_id"),
            F.lit(rule).alias("rule"),
            *[F.col(c).cast("int").alias(c) for c in ("label", "prediction")],
        )
        out = rows if out is None else out.unionByName(rows)
    return out


SCORED_SQL = f"""WITH {_gaussian_sql(SPOKEN_MEANS, TWO_CLASS)},
bwords AS (
  SELECT item_id, unnest({q.lowered(q.no_stop_words(q.raw_tokens(q.clean('text', lex.COMPACT_RULES))))}) AS word FROM benchmark),
bsums AS (
  SELECT item_id, dim, sum(CAST(vec[dim + 1] AS DOUBLE)) / count(*) AS value
  FROM bwords JOIN vectors USING (word), dims GROUP BY item_id, dim),
bmeans AS (SELECT item_id, dim, coalesce(value, 0) AS value
  FROM (SELECT item_id, dim FROM benchmark, dims) LEFT JOIN bsums USING (item_id, dim)),
blogs AS (
  SELECT item_id, class, any_value(prior) + sum(-0.5 * ln(2 * pi() * var) - (value - mu) * (value - mu) / (2 * var)) AS lp
  FROM bmeans JOIN stats USING (dim) JOIN priors USING (class) GROUP BY item_id, class)
SELECT item_id, CAST(arg_max(class, lp) AS INTEGER) AS pred_model0 FROM blogs GROUP BY item_id"""


@check(SCORED_SQL)
def score_new_texts_gaussian(spark, sf):
    """A Gaussian model fitted on the documents scores the benchmark texts: exact end to end."""
    features = _features(spark, sf, Settings(), kinds=("glove",))
    cells = grid.fit_grid(features, 2, ("gaussian",))
    scorer = score.Scorer(cells, features, word_vectors(spark, sf), DIMS)
    return scorer.score(table(spark, sf, "benchmark"), "item_id", "text")


@check(SCORED_SQL)
def stream_new_texts(spark, sf):
    """The same model scores the benchmark texts as a stream of files, batch by batch."""
    features = _features(spark, sf, Settings(), kinds=("glove",))
    scorer = score.Scorer(grid.fit_grid(features, 2, ("gaussian",)), features, word_vectors(spark, sf), DIMS)
    folder, output = new_path(spark, "arriving"), new_path(spark, "streamed")
    texts = table(spark, sf, "benchmark").select("item_id", "text")
    texts.repartition(3, "item_id").write.parquet(folder)
    arriving = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    scoring.score_batches(arriving, scorer, "item_id", "text", output, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema("item_id long, pred_model0 int, batch int").parquet(output).drop("batch")
