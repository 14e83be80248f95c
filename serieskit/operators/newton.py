"""L2 logistic regressions of many models and folds at once, by Newton steps.

Every step is one grouped aggregate over the stored rows: a task sums loss, gradient and curvature of its rows for each key, and those
sums, as many as features squared, are all that is shuffled and collected. The minimum is unique, so the result does not
depend on the path; a step that does not lower the loss is halved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass
class Solution:
    """Intercept and coefficients of one key, and how the steps ended."""

    beta: np.ndarray
    loss: float
    steps: int
    converged: bool

    @property
    def intercept(self) -> float:
        return float(self.beta[0])

    @property
    def coefficients(self) -> np.ndarray:
        return self.beta[1:]


def _sums(betas: dict[str, np.ndarray]):
    """Per key the packed sums of loss, gradient and the lower half of the curvature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            keys = np.array(batch.column("key").to_pylist(), object)
            lists = batch.column("x")
            x = lists.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy())
            begin = np.cumsum(lengths) - lengths
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            for key in set(keys) & betas.keys():
                beta = betas[key]
                own = np.flatnonzero(keys == key)
                rows = np.column_stack([np.ones(len(own)), x[begin[own][:, None] + np.arange(len(beta) - 1)[None, :]]])
                z = rows @ beta
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                loss = (w[own] * (np.logaddexp(0.0, z) - y[own] * z)).sum()
                curve = (rows * (w[own] * p * (1 - p))[:, None]).T @ rows
                packed = np.concatenate([[loss], rows.T @ (w[own] * (p - y[own])), curve[np.tril_indices(len(beta))]])
                held[key] = held.get(key, 0.0) + packed
        for key, packed in held.items():
            yield pa.RecordBatch.from_pydict({"key": [key] * len(packed), "place": np.arange(len(packed), dtype=np.int32), "value": packed})

    return run


def fit(rows: DataFrame, ridge: float = 1.0, most_steps: int = 100, tolerance: float = 1e-12) -> dict[str, Solution]:
    """Solutions by key of ``rows`` (key string, x array<double>, y double, w double), a stored table without missing values.

    Minimised is the weighted log loss plus half of ``ridge`` times the squared coefficients; the intercept is free.
    """
    width = {r["key"]: r["n"] for r in rows.groupBy("key").agg(F.max(F.size("x")).alias("n")).collect()}
    best = {key: None for key in width}
    tried = {key: np.zeros(n + 1) for key, n in width.items()}
    done: dict[str, Solution] = {}
    for step in range(most_steps + 1):
        if not tried:
            break
        summed: dict[str, dict[int, float]] = {key: {} for key in tried}
        found = rows.mapInArrow(_sums(dict(tried)), "key string, place int, value double").groupBy("key", "place").agg(F.sum("value").alias("value"))
        for r in found.collect():
            summed[r["key"]][r["place"]] = r["value"]
        for key, beta in list(tried.items()):
            p = len(beta)
            flat = np.array([summed[key][i] for i in range(len(summed[key]))])
            penalty = np.r_[0.0, np.full(p - 1, ridge)]
            loss, gradient = flat[0] + 0.5 * (penalty * beta * beta).sum(), flat[1 : p + 1] + penalty * beta
            if best[key] is not None and not loss <= best[key][0] + 1e-12 * abs(best[key][0]):
                # Too far: half the way back to the best point.
                tried[key] = (beta + best[key][1]) / 2
                if np.abs(tried[key] - best[key][1]).max() <= tolerance:
                    done[key] = Solution(best[key][1], best[key][0], step, True)
                    del tried[key]
                continue
            curve = np.zeros((p, p))
            curve[np.tril_indices(p)] = flat[p + 1 :]
            curve = curve + np.tril(curve, -1).T + np.diag(penalty)
            move = np.linalg.lstsq(curve, gradient, rcond=None)[0]
            best[key] = (loss, beta)
            if np.abs(move).max() <= tolerance * max(1.0, np.abs(beta).max()) or step == most_steps:
                done[key] = Solution(beta, loss, step, step < most_steps)
                del tried[key]
            else:
                tried[key] = beta - move
    for key in tried:
        done[key] = Solution(best[key][1], best[key][0], most_steps, False)
    return done
