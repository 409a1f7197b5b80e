"""The sigmoid kernel for the linear machines, by landmarks.

A kernel machine compares every row with every other. Here a bounded number of training
rows, chosen by hash, are the landmarks: a row becomes its kernel values
``tanh(gamma * x.z + c)`` with them, and the Gram matrix of the landmarks, inverted to the
power of a half, turns these into coordinates whose products are the kernel again wherever
the landmarks span it. The linear solver does the rest, so the work grows with the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.plans import models

LANDMARKS = 64
# singular values below this count as such
_LEAST = 1e-12


def linear_map(matrix: np.ndarray, source: str, target: str) -> Transformer:
    """A stage that multiplies the vectors of a column by a matrix (rows: results), inside the JVM."""
    gateway = SparkSession.active().sparkContext._gateway
    numbers = gateway.new_array(gateway.jvm.double, matrix.size)
    # columns of the stage's matrix are the rows of this one
    for i, x in enumerate(matrix.ravel().tolist()):
        numbers[i] = x
    linalg = gateway.jvm.org.apache.spark.ml.linalg
    stored = linalg.DenseMatrix(matrix.shape[1], matrix.shape[0], numbers)
    none = linalg.DenseVector(gateway.new_array(gateway.jvm.double, matrix.shape[0]))
    stage = PCAModel(gateway.jvm.org.apache.spark.ml.feature.PCAModel(f"map_{target}", stored, none))
    return stage._set(k=len(matrix)).setInputCol(source).setOutputCol(target)


def landmarks(rows: DataFrame, key: str, count: int = LANDMARKS, seed: int = 42) -> np.ndarray:
    """The features of the ``count`` rows with the smallest hashes, a row each."""
    hashed = rows.select(keys.hash_key(F.lit(seed), F.col(key)).alias("_h"), vector_to_array("features").alias("x"))
    return np.array([r["x"] for r in hashed.orderBy("_h", "x").limit(count).collect()])


def scale_gamma(rows: DataFrame) -> float:
    """One over the number of dimensions times the variance of all values."""
    x = vector_to_array("features")
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    squares = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    n, s, q = rows.select(F.size(x).alias("n"), total.alias("s"), squares.alias("q")).agg(
        F.sum("n"), F.sum("s"), F.sum("q")
    ).first()
    dims = rows.select(F.size(x)).first()[0]
    variance = q / n - (s / n) ** 2
    return 1.0 / (dims * variance) if variance > 0 else 1.0


class KernelMap(Transformer):
    """Adds ``target``: the kernel values of each row with the landmarks, through ``after`` if there is a matrix."""

    def __init__(self, points: np.ndarray, gamma: float, shift: float, source: str, target: str, after: np.ndarray | None = None):
        super().__init__()
        self.gamma, self.shift, self.source, self.target = gamma, shift, source, target
        self.products = linear_map(points, source, f"_{target}_products")
        self.after = None if after is None else linear_map(after, f"_{target}_values", target)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        products, values = f"_{self.target}_products", f"_{self.target}_values"
        bent = F.transform(vector_to_array(products), lambda p: F.tanh(self.gamma * p + self.shift))
        out = self.products.transform(dataset).withColumn(values, array_to_vector(bent)).drop(products)
        if self.after is None:
            return out.withColumnRenamed(values, self.target)
        return self.after.transform(out).drop(values)


class Without(Transformer):
    """Drops a column at the end of a pipeline."""

    def __init__(self, column: str):
        super().__init__()
        self.column = column

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(self.column)


def whitening(points: np.ndarray, gamma: float, shift: float) -> np.ndarray:
    """The Gram matrix of the landmarks to the power of minus a half."""
    left, sizes, right = np.linalg.svd(np.tanh(gamma * points @ points.T + shift))
    return (left / np.sqrt(np.maximum(sizes, _LEAST))) @ right


class KernelMachines(Estimator):
    """Support vector machines with a sigmoid kernel over landmarks; see :class:`models.LinearMachines` for the rest."""

    def __init__(self, classes: int, key: str, count: int = LANDMARKS, gamma: float | None = None, shift: float = 0.0, **options):
        super().__init__()
        self.key, self.count, self.gamma, self.shift = key, count, gamma, shift
        self.linear = models.LinearMachines(classes, features="_kernel", **options)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        points = landmarks(dataset, self.key, self.count)
        gamma = scale_gamma(dataset) if self.gamma is None else self.gamma
        mapped = KernelMap(points, gamma, self.shift, "features", "_kernel", whitening(points, gamma, self.shift))
        return PipelineModel([mapped, self.linear.fit(mapped.transform(dataset)), Without("_kernel")])


def kernel_svm(classes: int, key: str = "chunk_id", **options) -> Estimator:
    """Support vector machine with a sigmoid kernel; ``key`` is the column that tells rows apart."""
    return KernelMachines(classes, key, **options)
