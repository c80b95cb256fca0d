"""Small helpers to learn linear models from bounded samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyloop.llm.frequency import among
from keyloop.llm.text import stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, learn=None,
                    ident: str = "doc_id", columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """At most ``most`` labelled documents, those of least id hash: id, label and ``columns``.

    ``learn`` is a condition on the id (column ``id``).  Repeated ids count once, with the largest
    label and the least text; null ids and labels are left out.
    """
    known = labels.select(F.col(ident).alias("id"), F.col(label).alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL")
    if learn is not None:
        known = known.where(learn)
    ids = (known.groupBy("id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(most))
    # ``most`` rows of an id and a label: the size of the broadcast is bounded
    rows = docs.select(F.col(ident).alias("id"), *columns).join(F.broadcast(ids), "id")
    one = rows.groupBy("id").agg(F.min(F.struct("label", *columns)).alias("r"))
    return stored(one.select("id", "r.*"), f"sample-{label}")


def labelled(docs: DataFrame, labels: DataFrame, label: str, ident: str = "doc_id",
             columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """All labelled documents: id, label and ``columns``, dealt by id; texts of other documents do not move.

    Repeated ids count once, with the largest label and the least text; null ids and labels are left out.
    """
    known = labels.select(F.col(ident).alias("id"), F.col(label).alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL")
    ids = known.groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(ident).alias("id"), *columns)
    if rows.schema["id"].dataType == known.schema["id"].dataType:  # else hashes of equal ids may differ
        rows = among(rows, known, "id")
    rows = rows.join(ids, "id")
    one = rows.groupBy("id").agg(F.min(F.struct("label", *columns)).alias("r"))
    return stored(one.select("id", "r.*"), f"labelled-{label}")


def vector_sum(rows: DataFrame, parts: int = 16) -> np.ndarray:
    """Sum of equally long float64 vectors, ``rows(v binary)``, added up in ``parts`` tasks.

    All rows move: a task that makes them should give one, the sum of its own."""
    sums = _added(rows, parts).collect()
    return np.sum([np.frombuffer(r.v, np.float64) for r in sums], axis=0) if sums else np.zeros(0)


def _added(rows: DataFrame, parts: int) -> DataFrame:
    """The sums of the ``parts`` tasks.  Nothing is added where the rows are made: a second Python
    worker beside the one that makes them would stay for the session."""
    def add(batches):
        total = None
        for batch in batches:
            for v in batch.column("v").to_pylist():
                v = np.frombuffer(v, np.float64)
                total = v.copy() if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    return rows.repartition(parts).mapInArrow(add, "v binary")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_dense(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 30,
              weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant.  Without both
    labels the constant alone says so."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64, copy=False)
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
        return w
    weight = np.ones(len(y)) if weight is None else weight
    ridge = l2 * len(y) * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge @ w
        s = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * s[:, None]).T @ x + ridge, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_sparse(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, width: int,
               l2: float = 1e-4, steps: int = 300, rate: float = 0.1) -> np.ndarray:
    """Logistic regression over (row, column, value) entries by Adam over all rows; the last
    weight is the constant."""
    w = np.zeros(width + 1)
    if not len(y) or y.min() == y.max():
        w[-1] = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
        return w
    rate_of_ones = y.mean()
    w[-1] = np.log(rate_of_ones / (1 - rate_of_ones))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = sigmoid(np.bincount(rows, vals * w[cols], len(y)) + w[-1])
        off = (p - y) / len(y)
        grad = np.append(np.bincount(cols, vals * off[rows], width) + l2 * w[:-1], off.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w
