"""All logistic fits of a grid (targets x folds x strengths) at once, with or without an L1 penalty.

A separate fit per cell reads the data once per solver step and cell. Here one pass over the rows
gives, for every cell, the gradient and curvature of its loss; the small penalized Newton step of
each cell (a few dozen coefficients) is then solved on the driver. About ten passes serve the
whole grid.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PASSES = 40
TOLERANCE = 1e-6


@dataclass(frozen=True)
class Cell:
    """One fit; ``converged`` is false if its last step was still above the tolerance after all passes."""

    intercept: float
    coefficients: list[float]
    converged: bool


def _cell_sums(x: np.ndarray, y: np.ndarray, beta: np.ndarray, upper: tuple) -> np.ndarray:
    """Upper triangle of the curvature, gradient and loss of one cell on some rows."""
    m = x @ beta
    p = np.exp(-np.logaddexp(0.0, -m))
    curve = (x * (p * (1 - p))[:, None]).T @ x
    loss = np.logaddexp(0.0, m).sum() - y @ m
    return np.concatenate([curve[upper], x.T @ (y - p), [loss]])


@dataclass(frozen=True)
class Fold:
    """Rows of one part (a target, say) without those of one fold; a fold that does not occur leaves all of them."""

    part: int
    held: int


def _sums(rows: DataFrame, cells: Sequence[tuple[int, Fold]], betas: np.ndarray) -> np.ndarray:
    """One pass: statistics per cell (its number and its rows), summed over all rows.

    A task sends one array for each cell; the arrays of a cell meet in one task.
    """
    d = betas.shape[1]
    upper = np.triu_indices(d)
    width = len(upper[0]) + d + 1

    def out(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))],
                                          names=["i", "stats"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {i: np.zeros(width) for i in range(len(cells))}
        for b in batches:
            x = b.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b.column("y").to_numpy(zero_copy_only=False)
            fold, of = b.column("fold").to_numpy(zero_copy_only=False), b.column("part").to_numpy(zero_copy_only=False)
            kept: dict[Fold, tuple[np.ndarray, np.ndarray]] = {}
            for i, (n, f) in enumerate(cells):
                if f not in kept:
                    mine = (of == f.part) & (fold != f.held)
                    kept[f] = x[mine], y[mine]
                total[i] += _cell_sums(*kept[f], betas[n], upper)
        yield out(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            stats = b.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i, v in zip(b.column("i").to_pylist(), stats, strict=True):
                total[i] = total[i] + v if i in total else v.copy()
        if total:
            yield out(total)

    shape = "i int, stats array<double>"
    got = rows.mapInArrow(part, shape).repartition("i").mapInArrow(add, shape).collect()  # a row for each cell
    stats = np.zeros((len(cells), width))
    for r in got:
        stats[r["i"]] = r["stats"]
    return stats


def _unpacked(stats: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Curvature, gradient and loss of each cell."""
    upper = np.triu_indices(d)
    curve = np.zeros((len(stats), d, d))
    curve[:, upper[0], upper[1]] = stats[:, :len(upper[0])]
    curve[:, upper[1], upper[0]] = stats[:, :len(upper[0])]
    return curve, stats[:, len(upper[0]):-1], stats[:, -1]


def _polish(curve: np.ndarray, target: np.ndarray, beta: np.ndarray, pen: np.ndarray) -> np.ndarray:
    """Exact minimum for the signs at hand, kept only when it confirms them."""
    free = (beta != 0) | ((pen == 0) & (np.diag(curve) > 1e-12))
    out = np.zeros_like(beta)
    sign = np.sign(beta[free])
    try:
        out[free] = np.linalg.solve(curve[np.ix_(free, free)], target[free] - pen[free] * sign)
    except np.linalg.LinAlgError:
        return beta
    signs_hold = ((np.sign(out[free]) == sign) | (pen[free] == 0)).all()
    pull = np.abs(target - curve @ out)[~free] <= pen[~free] + 1e-9
    return out if signs_hold and (pull | (np.diag(curve)[~free] <= 1e-12)).all() else beta


def _step(curve: np.ndarray, grad: np.ndarray, beta: np.ndarray, pen: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Coordinate descent on the penalized quadratic model for all cells side by side, then polish."""
    new, d = beta.copy(), beta.shape[1]
    target = np.einsum("cjk,ck->cj", curve, beta) + grad
    for _ in range(sweeps):
        for j in range(d):
            h = curve[:, j, j]
            ok = h > 1e-12
            part = target[:, j] - np.einsum("ck,ck->c", curve[:, j, :], new) + h * new[:, j]
            shrunk = np.sign(part) * np.maximum(np.abs(part) - pen[:, j], 0.0)
            new[:, j] = np.divide(shrunk, h, out=np.zeros_like(h), where=ok)
    return np.stack([_polish(curve[i], target[i], new[i], pen[i]) for i in range(len(new))])


def l1_grid(rows: DataFrame, features: int, cells: Sequence[tuple[Fold, float]]) -> list[Cell]:
    """One fit per cell (its rows, strength C), in the order of ``cells``.

    ``rows`` has xs (features, then a constant 1), y, part and fold; cache it, it is read once per pass.
    """
    d = features + 1
    pen = np.array([[1.0 / c] * features + [0.0] for _, c in cells])
    beta, open_cells, _ = _descend(rows, [f for f, _ in cells], d, lambda who, beta: (pen[who] * np.abs(beta)).sum(axis=1),
                                   lambda who, curve, grad, beta: _step(curve, grad, beta, pen[who]))
    return [Cell(float(b[-1]), [float(v) for v in b[:-1]], n not in open_cells) for n, b in enumerate(beta)]


def _descend(rows: DataFrame, folds: Sequence[Fold], d: int, penalty: Callable, step: Callable) -> tuple[np.ndarray, set[int], np.ndarray]:
    """Newton steps of all cells in shared passes: (coefficients, cells still open after all passes, curvature at them)."""
    beta = np.zeros((len(folds), d))
    best = np.full(len(folds), np.inf)
    last = beta.copy()
    curves = np.zeros((len(folds), d, d))
    active = list(range(len(folds)))
    for _ in range(MAX_PASSES):
        curve, grad, loss = _unpacked(_sums(rows, [(n, folds[n]) for n in active], beta), d)
        who = np.array(active)
        value = loss + penalty(who, beta[who])
        worse = value > best[who] + 1e-9 * np.abs(value)
        to = step(who, curve, grad, beta[who])
        open_cells = []
        for i, n in enumerate(active):
            if worse[i]:  # overshoot: go back half way
                beta[n] = (beta[n] + last[n]) / 2
                open_cells.append(n)
                continue
            best[n], last[n], curves[n] = value[i], beta[n].copy(), curve[i]
            if np.abs(to[i] - beta[n]).max() >= TOLERANCE:
                open_cells.append(n)
            beta[n] = to[i]
        active = open_cells
        if not active:
            break
    return beta, set(active), curves


@dataclass(frozen=True)
class LogitCell:
    """A fit with hardly any penalty, and the curvature of its loss (the information matrix), the constant last."""

    intercept: float
    coefficients: list[float]
    converged: bool
    information: np.ndarray


def logit_grid(rows: DataFrame, features: int, folds: Sequence[Fold], strength: float = 1e6) -> list[LogitCell]:
    """Logistic fits of all ``folds`` in shared passes; the squared penalty of ``strength`` only keeps them finite."""
    d = features + 1
    ridge = np.array([1.0 / strength] * features + [0.0])

    def step(who: np.ndarray, curve: np.ndarray, grad: np.ndarray, beta: np.ndarray) -> np.ndarray:
        # A column that never varies has no curvature: the small addition keeps its coefficient at 0.
        return beta + np.linalg.solve(curve + np.diag(ridge + 1e-12), (grad - ridge * beta)[:, :, None])[:, :, 0]

    beta, open_cells, curves = _descend(rows, folds, d, lambda who, beta: (ridge * beta**2).sum(axis=1) / 2, step)
    return [LogitCell(float(b[-1]), [float(v) for v in b[:-1]], n not in open_cells, curves[n]) for n, b in enumerate(beta)]


def clustered_scores(rows: DataFrame, by: str, beta: Sequence[float]) -> np.ndarray:
    """Sum over the groups of ``by`` of the outer product of a group's summed slopes, for robust intervals.

    Slopes are added up in each task before they are sent; what reaches the driver is one matrix a task at most.
    """
    b, d = np.asarray(beta), len(beta)

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[object, np.ndarray] = {}
        for batch in batches:
            x = batch.column("xs").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            m = x @ b
            s = x * (batch.column("y").to_numpy(zero_copy_only=False) - np.exp(-np.logaddexp(0.0, -m)))[:, None]
            codes = batch.column("g").dictionary_encode()
            at = codes.indices.to_numpy(zero_copy_only=False)
            for k, g in enumerate(codes.dictionary.to_pylist()):
                total[g] = total.get(g, 0.0) + s[at == k].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["g", "s"])

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for g, s in zip(batch.column("g").to_pylist(), batch.column("s").to_pylist(), strict=True):
                total[g] = total.get(g, 0.0) + np.array(s)
        if total:
            s = np.stack(list(total.values()))
            yield pa.RecordBatch.from_arrays([pa.array([(s.T @ s).ravel()], pa.list_(pa.float64()))], names=["m"])

    keyed = rows.select(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("g"), "xs", "y")
    got = keyed.mapInArrow(slopes, "g string, s array<double>").repartition("g").mapInArrow(outer, "m array<double>").collect()
    return sum((np.array(r["m"]).reshape(d, d) for r in got), np.zeros((d, d)))
