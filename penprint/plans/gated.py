"""The gated network: a long short-term memory unit over a sequence of one step, trained in mini-batches.

With nothing to carry over, the unit is ``h = out * tanh(in * fresh)``, its three gates each a
linear map of the row; a softmax over the classes follows. Training makes epochs of
mini-batches: rows are dealt to batches by a hash of their key, the batches of a task follow
each other in it with a step each, and after an epoch the weights of all tasks are averaged by
their rows. So an epoch is one job, and a batch never leaves its task. Steps need the weights of
the steps before them, which no built-in expression has, so they are done on arrays in the
tasks; predictions are made by built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penprint.operators.split import assign_batches
from penprint.plans.kernels import linear_map
from penprint.session import staged

EPOCHS = 10
BATCH = 32
UNITS = 128
RATE = 0.01


def start_weights(dims: int, units: int, classes: int, seed: int = 42) -> dict[str, np.ndarray]:
    """Small random weights; the last row of each matrix is its bias."""
    rng = np.random.default_rng(seed)

    def matrix(rows: int, columns: int) -> np.ndarray:
        out = rng.standard_normal((rows + 1, columns)) / np.sqrt(max(rows, 1))
        out[-1] = 0
        return out

    return {"gates": matrix(dims, 3 * units), "classes": matrix(units, classes)}


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def batch_gradients(weights: dict, x: np.ndarray, label: np.ndarray) -> tuple[dict, float]:
    """Gradients of the mean loss of a batch, and its loss."""
    units = weights["classes"].shape[0] - 1
    row = _with_one(x)
    raw = row @ weights["gates"]
    gate_in, gate_out = (1 / (1 + np.exp(-raw[:, k * units : (k + 1) * units])) for k in (0, 2))
    fresh = np.tanh(raw[:, units : 2 * units])
    bent = np.tanh(gate_in * fresh)
    state = _with_one(gate_out * bent)
    logits = state @ weights["classes"]
    logits -= logits.max(axis=1, keepdims=True)
    share = np.exp(logits)
    share /= share.sum(axis=1, keepdims=True)
    every = np.arange(len(x))
    loss = -np.log(np.maximum(share[every, label], 1e-300)).mean()
    share[every, label] -= 1
    share /= len(x)
    back = share @ weights["classes"][:-1].T
    cell = back * gate_out * (1 - bent * bent)
    error = np.concatenate(
        [
            cell * fresh * gate_in * (1 - gate_in),
            cell * gate_in * (1 - fresh * fresh),
            back * bent * gate_out * (1 - gate_out),
        ],
        axis=1,
    )
    return {"gates": row.T @ error, "classes": state.T @ share}, float(loss)


def _epoch_task(sent, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = {k: v.copy() for k, v in sent.value.items()}
        first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
        seen, total, step = 0, 0.0, 0
        for part in batches:
            x = np.stack(part.column(0).to_numpy(zero_copy_only=False)) if part.num_rows else np.zeros((0, 1))
            label, batch = part.column(1).to_numpy(), part.column(2).to_numpy()
            order = np.argsort(batch, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(batch[order])) + 1):
                if not len(rows):
                    continue
                grads, loss = batch_gradients(weights, x[rows], label[rows])
                step += 1
                pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    weights[k] -= pace * first[k] / (np.sqrt(second[k]) + 1e-8)
                seen, total = seen + len(rows), total + loss * len(rows)
        if seen:
            flat = np.concatenate([v.ravel() for v in weights.values()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen]), pa.array([total]), pa.array([flat.tolist()], pa.list_(pa.float64()))], ["seen", "loss", "weights"]
            )

    return run


def _added(a, b):
    return F.zip_with(a, b, lambda x, y: x + y)


class GatedModel(Transformer):
    """Adds ``probability`` and ``prediction``; ``history`` has the mean loss of each epoch."""

    def __init__(self, weights: dict[str, np.ndarray], history: list[float]):
        super().__init__()
        self.weights, self.history = weights, history
        self.units = weights["classes"].shape[0] - 1
        self.gates = linear_map(weights["gates"][:-1].T.copy(), "features", "_gates")
        self.classes = linear_map(weights["classes"][:-1].T.copy(), "_state", "_logits")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def biased(column: str, bias: np.ndarray):
            return _added(vector_to_array(column), F.array(*[F.lit(x) for x in bias.tolist()]))

        def part(array, k):
            return F.slice(array, k * self.units + 1, self.units)

        gated = self.gates.transform(dataset).withColumn("_raw", biased("_gates", self.weights["gates"][-1]))
        held = F.zip_with(part("_raw", 0), part("_raw", 1), lambda a, b: F.tanh(F.tanh(b) / (1 + F.exp(-a))))
        state = F.zip_with(held, part("_raw", 2), lambda c, o: c / (1 + F.exp(-o)))
        scored = self.classes.transform(gated.withColumn("_state", array_to_vector(state)))
        scored = scored.withColumn("_own", biased("_logits", self.weights["classes"][-1]))
        exps = F.transform("_own", lambda x: F.exp(x - F.array_max("_own")))
        scored = scored.withColumn("_exps", exps)
        total = F.aggregate("_exps", F.lit(0.0), lambda a, x: a + x)
        best = F.array_position("_exps", F.array_max("_exps")) - 1
        return (
            scored.withColumn("probability", array_to_vector(F.transform("_exps", lambda x: x / total)))
            .withColumn("prediction", best.cast("double"))
            .drop("_gates", "_raw", "_state", "_logits", "_own", "_exps")
        )


class GatedUnit(Estimator):
    """The gated network; ``key`` is the column that deals rows to batches."""

    def __init__(self, classes: int, key: str, units: int = UNITS, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE):
        super().__init__()
        self.classes, self.key, self.units, self.epochs, self.batch, self.rate = classes, key, units, epochs, batch, rate

    def _fit(self, dataset: DataFrame) -> GatedModel:
        rows = dataset.select(self.key, vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"))
        dealt = assign_batches(rows, self.key, self.batch).select("x", "label", "batch")
        # a batch lies in one file
        dealt = staged(dealt.repartition("batch"), "batches")
        head = dealt.select(F.size("x").alias("n")).first()
        if head is None:
            raise ValueError("no rows to train on")
        weights, history = start_weights(head["n"], self.units, self.classes), []
        for _ in range(self.epochs):
            sent = dataset.sparkSession.sparkContext.broadcast(weights)
            tasks = dealt.mapInArrow(_epoch_task(sent, self.rate), "seen bigint, loss double, weights array<double>")
            # weights are added up place by place, so the driver gets one row per weight
            parts = staged(tasks, "epoch")
            seen, loss = parts.agg(F.sum("seen"), F.sum("loss")).first()
            places = parts.select("seen", F.posexplode("weights").alias("at", "w")).groupBy("at")
            mean = places.agg((F.sum(F.col("w") * F.col("seen")) / F.sum("seen")).alias("w")).toArrow()
            flat = np.empty(mean.num_rows)
            flat[mean.column("at").to_numpy()] = mean.column("w").to_numpy()
            edge = weights["gates"].size
            weights = {"gates": flat[:edge].reshape(weights["gates"].shape), "classes": flat[edge:].reshape(weights["classes"].shape)}
            history.append(loss / seen)
            sent.unpersist()
        return GatedModel(weights, history)
