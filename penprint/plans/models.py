"""The four classifiers, as ``pyspark.ml`` estimators.

All read ``features`` and ``label`` and write ``prediction`` and ``probability``.
"""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.plans.network import HiddenLayer

SEED = 42


def random_forest(dims: int, classes: int, trees: int = 100, depth: int = 30) -> Estimator:
    """Random forest; trees grow to ``depth``, of which Spark allows 30."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, maxMemoryInMB=512)


def gaussian(dims: int, classes: int) -> Estimator:
    """Gaussian naive Bayes."""
    return NaiveBayes(modelType="gaussian")


class LinearMachines(Estimator):
    """Linear support vector machines with class probabilities.

    One machine for two classes, one per class for more. A logistic fit on the
    margins gives the probabilities, and with more than two classes the
    prediction. The fitted model is a plain pipeline model.
    """

    def __init__(
        self,
        classes: int,
        iterations: int = 200,
        reg_param: float = 0.01,
        tolerance: float = 1e-3,
        features: str = "features",
    ):
        super().__init__()
        self.features = features
        self.tolerance = tolerance
        self.classes = classes
        self.iterations = iterations
        self.reg_param = reg_param

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        two = self.classes <= 2
        machines, temporary = [], []
        for k in [1] if two else range(self.classes):
            machine = LinearSVC(
                featuresCol=self.features,
                labelCol="_is_class",
                maxIter=self.iterations,
                tol=self.tolerance,
                regParam=self.reg_param,
                rawPredictionCol=f"_margin_{k}",
                predictionCol="prediction" if two else f"_guess_{k}",
            )
            rows = dataset.withColumn("_is_class", (F.col("label") == k).cast("double"))
            machines.append(machine.fit(rows))
            temporary += [f"_margin_{k}"] if two else [f"_margin_{k}", f"_guess_{k}"]
        margins = VectorAssembler(
            inputCols=[c for c in temporary if c.startswith("_margin")], outputCol="_margins"
        )
        platt = LogisticRegression(
            featuresCol="_margins",
            predictionCol="_platt" if two else "prediction",
            rawPredictionCol="_platt_raw",
            probabilityCol="probability",
            regParam=1e-6,
            maxIter=self.iterations,
            tol=self.tolerance,
        )
        measured = PipelineModel([*machines, margins])
        calibrated = platt.fit(measured.transform(dataset))
        temporary += ["_margins", "_platt_raw"] + (["_platt"] if two else [])
        tidy = SQLTransformer(
            statement=f"SELECT * EXCEPT ({', '.join(temporary)}) FROM __THIS__"
        )
        return PipelineModel([*machines, margins, calibrated, tidy])


def svm(
    dims: int, classes: int, iterations: int = 200, reg_param: float = 0.01, tolerance: float = 1e-3
) -> Estimator:
    """Support vector machine, linear kernel, solved to a tolerance."""
    return LinearMachines(classes, iterations, reg_param, tolerance)


def mlp(
    dims: int, classes: int, hidden: int = 128, iterations: int = 200, tolerance: float = 1e-4
) -> Estimator:
    """One hidden layer of 128 units: what an LSTM over a sequence of length one comes to."""
    return HiddenLayer(dims, classes, hidden, iterations, tolerance, SEED)


MODELS = {"rf": random_forest, "gaussian": gaussian, "svm": svm, "lstm": mlp}


def as_vector(column: Column) -> Column:
    """An array column as an ML vector."""
    return array_to_vector(column)


def positive_probability(positive: int = 1) -> Column:
    """Probability of one class."""
    return F.get(vector_to_array(F.col("probability")), F.lit(positive))


def class_at(threshold: float = 0.5, inclusive: bool = False) -> Column:
    """Class 1 when its probability passes the threshold, else 0."""
    p = positive_probability()
    return (p >= threshold if inclusive else p > threshold).cast("int")


def with_threshold(predictions: DataFrame, threshold: float | None, inclusive: bool = False) -> DataFrame:
    """``prediction`` of a two-class model by a threshold of its probability; None leaves it as it is."""
    if threshold is None:
        return predictions
    return predictions.withColumn("prediction", class_at(threshold, inclusive).cast("double"))


def loss_history(df: DataFrame, model) -> DataFrame:
    """``iteration, loss`` of a fitted network; one row per iteration."""
    losses = [(i, float(x)) for i, x in enumerate(model.history)]
    return df.sparkSession.createDataFrame(losses, "iteration int, loss double")


def fit_and_predict(
    features: DataFrame, estimator: Estimator, keep: list[str]
) -> tuple[object, DataFrame]:
    """Fit on rows with ``is_train``, predict the others."""
    model = estimator.fit(features.where("is_train"))
    scored = model.transform(features.where(~F.col("is_train")))
    return model, scored.select(*keep, "label", "prediction", "probability")
