"""Logistic regression by Newton's method, as an independent check of a fit (M5).

Minimises ``penalty / 2 |w|^2 + sum of weighted log-losses`` with a free intercept, the
objective of the fitted candidates. A step needs one pass: every task sums its rows'
loss, gradient and Gram matrix (features squared numbers, whatever the rows), the sums
are added up by Spark, and the driver solves a system as large as the features. Steps
that don't lower the objective are halved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NewtonFit:
    intercept: float
    weights: tuple[float, ...]
    gradient: tuple[float, ...]  # of the features, then the intercept
    iterations: int


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Gaussian elimination with partial pivoting, for a few dozen unknowns."""
    rows = [[*r, b] for r, b in zip(matrix, right, strict=True)]
    n = len(rows)
    for k in range(n):
        top = max(range(k, n), key=lambda i: abs(rows[i][k]))
        if rows[top][k] == 0:
            raise ValueError("the system is singular")
        rows[k], rows[top] = rows[top], rows[k]
        for i in range(k + 1, n):
            f = rows[i][k] / rows[k][k]
            rows[i] = [x - f * y for x, y in zip(rows[i], rows[k], strict=True)]
    out = [0.0] * n
    for k in reversed(range(n)):
        out[k] = (rows[k][n] - sum(rows[k][j] * out[j] for j in range(k + 1, n))) / rows[k][k]
    return out


def _sums(rows: DataFrame, beta: Sequence[float]) -> np.ndarray:
    """Loss, gradient, Gram matrix and number of all rows (columns ``x0``, ..., ``y``, ``w``)."""
    p = len(beta)
    now = np.array(beta)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + p + p * p)
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            x, y, w = np.column_stack([*cols[:-2], np.ones(batch.num_rows)]), cols[-2], cols[-1]
            z = x @ now
            prob = 1 / (1 + np.exp(-z))
            total[0] += float(np.sum(w * (np.logaddexp(0, z) - y * z)))
            total[1:1 + p] += x.T @ (w * (prob - y))
            total[1 + p:-1] += ((x * (w * prob * (1 - prob))[:, None]).T @ x).ravel()
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    out = np.zeros(2 + p + p * p)
    for r in rows.mapInArrow(each, "k int, v double").groupBy("k").agg(F.sum("v")).collect():  # features squared
        out[r[0]] = r[1]
    return out


def fit_newton(df: DataFrame, inputs: Sequence[str], label: str, weight: str | None = None, penalty: float = 1.0,
               tol: float = 1e-10, max_iter: int = 50) -> NewtonFit:
    """Fit on the rows of ``df``, which is read once for each step and so should be a
    written table. ``tol`` bounds the gradient for each row. Rows with a null are left out."""
    rows = df.select(*[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(inputs)],
                     F.col(label).cast("double").alias("y"),
                     (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w")).na.drop()
    p = len(inputs)
    ridge = np.array([penalty] * p + [0.0])
    beta, step, best = np.zeros(p + 1), None, np.inf
    gradient, taken = np.zeros(p + 1), 0
    for taken in range(1, max_iter + 1):
        sums = _sums(rows, beta)
        value = sums[0] + 0.5 * float(ridge @ (beta * beta))
        if value > best * (1 + 1e-12) and step is not None and np.abs(step).max() > 1e-12:
            step = step / 2
            beta = beta - step
            continue
        best = value
        gradient = sums[1:2 + p] + ridge * beta
        if np.abs(gradient).max() <= tol * max(sums[-1], 1):
            break
        hessian = sums[2 + p:-1].reshape(p + 1, p + 1) + np.diag(ridge)
        step = -np.array(solve(hessian.tolist(), gradient.tolist()))
        beta = beta + step
    return NewtonFit(float(beta[-1]), tuple(beta[:-1].tolist()), tuple(gradient.tolist()), taken)
