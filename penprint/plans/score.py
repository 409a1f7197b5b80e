"""Score new texts with fitted models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.functions import lexicon as lex
from penprint.functions import text as tx
from penprint.operators import wordvectors
from penprint.plans import models
from penprint.plans.grid import Cell, Features


@dataclass
class Scorer:
    """Fitted models for new texts, in the order of the prediction columns."""

    cells: list[Cell]
    features: Features
    vectors: DataFrame
    vector_dims: int

    def prepare(self, texts: DataFrame, key: str, text: str, rules=lex.COMPACT_RULES) -> DataFrame:
        """Normalised tokens without stop words, joined again."""
        tokens = tx.word_tokens(tx.clean(F.col(text), rules), remove_stopwords=True)
        return texts.select(key, F.array_join(tokens, " ").alias("text"))

    def score(
        self, texts: DataFrame, key: str, text: str, threshold: float | None = None, inclusive: bool = False
    ) -> DataFrame:
        """``key, pred_model0, pred_model1, ...``: one prediction per fitted model.

        The models are applied to the same rows one after the other. ``threshold`` and
        ``inclusive`` are those of :func:`grid.fit_grid`, for models of two classes.
        """
        kinds = {cell.feature_type for cell in self.cells}
        ready = self.prepare(texts, key, text)
        rows = ready
        if "tfidf" in kinds:
            rows = self.features.tfidf.transform(ready).withColumnRenamed("features", "_tfidf")
        if "glove" in kinds:
            words = ready.select(key, F.split("text", " ").alias("words"))
            pooled = wordvectors.mean_vectors(
                words, "words", self.vectors, key, self.vector_dims
            )
            rows = rows.join(
                pooled.select(key, models.as_vector(F.col("vector")).alias("_glove")), key
            )
        names = []
        for i, cell in enumerate(self.cells):
            kept = [c for c in rows.columns if c != "features"]
            scored = cell.model.transform(
                rows.select(*kept, F.col(f"_{cell.feature_type}").alias("features"))
            )
            scored = models.with_threshold(scored, threshold, inclusive)
            names.append(f"pred_model{i}")
            rows = scored.select(*kept, F.col("prediction").cast("int").alias(names[-1]))
        return rows.select(key, *names)


def tfidf_scorer(features: Features, cell: Cell, text: str = "text") -> PipelineModel:
    """One saved pipeline, text to prediction, without any join.

    It can be written, loaded and used on a stream.
    """
    if cell.feature_type != "tfidf":
        raise ValueError("only a TF-IDF model works on the text alone")
    return PipelineModel([features.tfidf, cell.model])
