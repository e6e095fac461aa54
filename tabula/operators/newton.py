"""Many binary logistic fits in one scan.

Every fit has its own features, rows and coefficients. One pass over the data
gives each fit's log likelihood, gradient and Hessian (numpy blocks in the
tasks, partial sums added per fit in Spark), and a Newton step follows on the
driver, which holds ``fits x features^2 / 2`` numbers whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one block product, a memory bound.
BLOCK = 8192


@dataclass
class Fit:
    """One model: the places of its features in the vector, the group whose
    rows it must not see (or None), and intercept and coefficients."""

    columns: list
    leave_out: str | None = None
    coefs: np.ndarray = None
    log_likelihood: float = -np.inf
    step: np.ndarray = field(default=None, repr=False)
    done: bool = False

    def __post_init__(self):
        if self.coefs is None:
            self.coefs = np.zeros(len(self.columns) + 1)


def _rows(batch):
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        if part.num_rows:
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield (np.hstack([np.ones((len(x), 1)), x]), part.column(1).to_numpy(zero_copy_only=False),
                   [np.array(part.column(k).to_pylist(), object) for k in range(2, part.num_columns)])


def _chosen(groups, leave_out):
    """Rows that a fit learns from; ``leave_out`` is "column=value"."""
    if leave_out is None:
        return slice(None)
    column, value = leave_out.split("=", 1)
    return groups[int(column)].astype(str) != value


def _pass(data: DataFrame, fits: list[Fit], found) -> dict:
    """Sums of ``found(x, y)`` over the rows of every fit."""
    sent = data.sparkSession.sparkContext.broadcast(fits)

    def run(batches):
        total = [0.0] * len(sent.value)
        for batch in batches:
            for x, y, groups in _rows(batch):
                for i, fit in enumerate(sent.value):
                    total[i] = total[i] + found(fit, x[:, [0, *[c + 1 for c in fit.columns]]], y, groups)
        held = [(i, t) for i, t in enumerate(total) if not isinstance(t, float)]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in held], pa.int32()),
                                          pa.array([t.tolist() for _, t in held], pa.list_(pa.float64()))], names=["fit", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fit": pdf["fit"].iloc[:1].to_numpy(), "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0)]})

    parts = data.mapInArrow(run, "fit int, v array<double>")
    out = {r["fit"]: np.array(r["v"]) for r in parts.groupBy("fit").applyInPandas(add, "fit int, v array<double>").collect()}
    sent.unpersist()
    return out


def _derivatives(fit: Fit, x: np.ndarray, y: np.ndarray, groups) -> np.ndarray:
    rows = _chosen(groups, fit.leave_out)
    x, y = x[rows], y[rows]
    eta = x @ fit.coefs
    p = 0.5 * (1 + np.tanh(eta / 2))
    hessian = x.T @ (x * (p * (1 - p))[:, None])
    return np.concatenate([[float(np.sum(y * eta - np.logaddexp(0, eta)))], x.T @ (y - p), hessian.ravel()])


def _hits(fit: Fit, x: np.ndarray, y: np.ndarray, groups) -> np.ndarray:
    rows = _chosen(groups, fit.leave_out)
    if not isinstance(rows, slice):
        x, y = x[~rows], y[~rows]
    return np.array([float(((x @ fit.coefs > 0) == (y > 0.5)).sum()), float(len(y))])


def newton(data: DataFrame, fits: list[Fit], max_steps: int = 25, gain: float = 1e-10) -> list[Fit]:
    """Maximum likelihood of all ``fits`` over ``data`` (features as an array
    of doubles, label 0 or 1, then group columns).

    A fit ends when its log likelihood gains less than ``gain`` of itself. A
    step that loses is halved. Where the classes can be separated there is no
    maximum: the steps are damped and end with ``max_steps``.
    """
    for _ in range(max_steps):
        open_ = [f for f in fits if not f.done]
        if not open_:
            break
        sums = _pass(data, open_, _derivatives)
        for i, fit in enumerate(open_):
            if i not in sums:
                fit.done = True
                continue
            k, v = len(fit.coefs), sums[i]
            if v[0] < fit.log_likelihood - 1e-9 * abs(fit.log_likelihood) and np.abs(fit.step).max() > 1e-12:
                fit.step = fit.step / 2
                fit.coefs = fit.coefs - fit.step
                continue
            fit.done = bool(v[0] - fit.log_likelihood <= gain * abs(v[0]))
            fit.log_likelihood = v[0]
            if not fit.done:
                hessian = v[1 + k:].reshape(k, k)
                damped = hessian + 1e-10 * (np.trace(hessian) / k + 1e-300) * np.eye(k)
                fit.step = np.linalg.lstsq(damped, v[1:1 + k], rcond=None)[0]
                fit.coefs = fit.coefs + fit.step
    return fits


def accuracies(data: DataFrame, fits: list[Fit]) -> list[float]:
    """Share of right predictions of every fit on the rows that it left out
    (all rows where it left out none)."""
    sums = _pass(data, fits, _hits)
    return [float(sums[i][0] / sums[i][1]) if i in sums and sums[i][1] else float("nan") for i in range(len(fits))]


def standardised(df: DataFrame, features, label: str, groups=()) -> DataFrame:
    """Features as one array (mean 0, sample deviation 1; a constant is 0), rows
    with a missing value left out, label as 0 or 1, and the group columns."""
    stats = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features)
                     for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    cells = []
    for i, c in enumerate(features):
        deviation = stats[f"s{i}"] or 0.0
        cells.append((F.col(c).cast("double") - F.lit(stats[f"m{i}"])) / F.lit(deviation) if deviation
                     else F.when(F.col(c).isNotNull(), F.lit(0.0)))
    x = F.array(*cells)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)) & F.col(label).isNotNull()
    return df.filter(whole).select(x.alias("x"), F.col(label).cast("double").alias("y"), *groups)
