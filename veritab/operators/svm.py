"""Linear SVMs on random Fourier features, of all folds and trials of a cross-validation, fitted in common passes (M4, M6–M8).

The objective is that of Spark's ``LinearSVC``: mean hinge loss plus an L2 penalty on the weights of the standardised
random features, minimised by the same steps (OWL-QN with ten corrections). The random features of a row take 200
numbers, so they are not stored: tasks compute them anew in every pass, a block of rows at a time, for every model that
is being fitted, and return a model's loss and gradient as one row.

The features are standardised once, over all rows. A fold's own standardisation, over the rows it is fitted on, is an
affine map of those; it becomes a part of the fold's projection.
"""

from __future__ import annotations

import math
import random
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veritab.operators.blocks import block_rows

CHUNK = 512  # rows whose random features are held at once
CORRECTIONS = 10
RECENT = 20  # objective values compared for convergence
SEARCH_STEPS = 20
CONSTANT = 1e-12  # a random feature with a smaller deviation has no weight


@dataclass
class Projection:
    """Random features cos(Wx + b) of a fold's own features x, and ``on_rows``, half of Wx + b on the (x, 1) of the table."""

    W: list
    b: list
    on_rows: np.ndarray
    fold: int | None


def random_projection(d: int, n_components: int, gamma: float, seed: int) -> tuple[list, list]:
    rng = random.Random(seed)
    sd = math.sqrt(2.0 * gamma)
    W = [[rng.gauss(0.0, sd) for _ in range(d)] for _ in range(n_components)]
    return W, [rng.uniform(0.0, 2 * math.pi) for _ in range(n_components)]


def half_angle(x: np.ndarray, on_rows: np.ndarray) -> np.ndarray:
    """(1 + cos(Wx + b)) / 2 as 1 / (1 + tan²) of half the angle, to a rounding error of cos; numpy has a fast tan."""
    u = x @ on_rows
    np.tan(u, out=u)
    with np.errstate(over="ignore"):
        np.multiply(u, u, out=u)
        u += 1.0
        return np.divide(1.0, u, out=u)


def _used(b: pa.RecordBatch, folds: Sequence[int | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(model, labels, rows with a one) of the blocks, a chunk at a time, without the rows of the model's fold."""
    for y, fold, x in block_rows(b):
        for model, left_out in enumerate(folds):
            rows = slice(None) if left_out is None else fold != left_out
            own_y, own_x = y[rows], x[rows]
            for at in range(0, len(own_y), CHUNK):
                yield model, own_y[at : at + CHUNK], own_x[at : at + CHUNK]


def _summed(table: DataFrame, folds: Sequence[int | None], width: int, sums) -> np.ndarray:
    """``sums(model, y, x)``, so many numbers, added up over all rows for every model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(folds), width))
        for b in batches:
            for model, y, x in _used(b, folds):
                total[model] += sums(model, y, x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(folds), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["model", "sums"])

    found = table.mapInArrow(run, "model int, sums array<double>").toArrow()  # a row a task and model
    out = np.zeros((len(folds), width))
    if len(found):
        np.add.at(out, found.column("model").to_numpy(), found.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
    return out


def _spread(table: DataFrame, folds, maps: Sequence[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of every model, and mean and sample deviation of its ``half_angle``; sums are of differences to those of the
    ``first`` row, so that a constant has none."""
    size = maps[0].shape[1]
    pivots = np.stack([half_angle(first[None, :], m)[0] for m in maps])

    def sums(model, y, x):
        d = half_angle(x, maps[model]) - pivots[model]
        return np.concatenate([[len(y)], d.sum(axis=0), np.einsum("ij,ij->j", d, d)])

    found = _summed(table, folds, 1 + 2 * size, sums)
    n = found[:, :1]
    mean = found[:, 1 : 1 + size] / np.maximum(n, 1)
    var = np.maximum(found[:, 1 + size :] - n * mean * mean, 0.0) / np.maximum(n - 1, 1)
    return n[:, 0], mean + pivots, np.sqrt(var)


def fit_svms(table: DataFrame, projections: Sequence[Projection], penalties: Sequence[float], first: np.ndarray, max_iter: int = 100, tol: float = 1e-6) -> list[tuple[np.ndarray, float]]:
    """(coefficients, intercept) on the random features of every model, fitted on the rows of the table that are not of
    its fold, in common passes."""
    folds, maps = [p.fold for p in projections], [p.on_rows for p in projections]
    size = maps[0].shape[1]
    n, mean, deviation = _spread(table, folds, maps, first)
    inverse = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > CONSTANT)
    fits = [owlqn(size + 1, max_iter, tol) for _ in projections]
    wanted = {m: next(f) for m, f in enumerate(fits)}
    found = {}
    while wanted:
        active = sorted(wanted)
        on_half = [wanted[m][:-1] * inverse[m] for m in active]
        offsets = [wanted[m][-1] - v @ mean[m] for m, v in zip(active, on_half)]

        def sums(k, y, x, maps=[maps[m] for m in active], on_half=on_half, offsets=offsets):
            u, sign = half_angle(x, maps[k]), 2.0 * y - 1.0
            loss = 1.0 - sign * (u @ on_half[k] + offsets[k])
            slope = np.where(loss > 0, -sign, 0.0)
            return np.concatenate([[np.maximum(loss, 0.0).sum(), slope.sum()], slope @ u])

        for m, own in zip(active, _summed(table, [folds[m] for m in active], size + 2, sums) / n[active][:, None]):
            w = wanted[m][:-1]
            grad = np.append((own[2:] - own[1] * mean[m]) * inverse[m] + penalties[m] * w, own[1])
            try:
                wanted[m] = fits[m].send((own[0] + 0.5 * penalties[m] * (w @ w), grad))
            except StopIteration as done:
                found[m] = done.value
                del wanted[m]
    scale = 2.0 * math.sqrt(2.0 / size)
    return [(found[m][:-1] * inverse[m] / scale, float(found[m][-1] - (found[m][:-1] * inverse[m]) @ (mean[m] - 0.5))) for m in range(len(fits))]


def margin_columns(table: DataFrame, projections: Sequence[Projection], fitted: Sequence[tuple[np.ndarray, float]]) -> DataFrame:
    """(y, fold, m): label, fold and the margins under all models of every row."""
    scale = math.sqrt(2.0 / len(fitted[0][0]))
    models = [(p.on_rows, 2.0 * scale * c, b - scale * c.sum()) for p, (c, b) in zip(projections, fitted)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, fold, x in block_rows(b):
                m = np.empty((len(y), len(models)))
                for at in range(0, len(y), CHUNK):
                    for i, (on_rows, weights, offset) in enumerate(models):
                        m[at : at + CHUNK, i] = half_angle(x[at : at + CHUNK], on_rows) @ weights + offset
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, len(models)), pa.int32()), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(fold), flat], names=["y", "fold", "m"])

    return table.mapInArrow(run, "y double, fold int, m array<double>")


def owlqn(width: int, max_iter: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimiser that yields the points it wants evaluated, is sent (value, gradient), and returns the last point: the
    steps of the optimiser that Spark's ``LinearSVC`` uses."""
    x = np.zeros(width)
    value, grad = yield x
    start, recent, steps, changes, failed = value, [math.inf], [], [], False
    number = 0
    while number < max_iter and abs(value - max(recent)) > tol * start and np.linalg.norm(grad) > max(tol * value, 1e-8):
        found = None
        direction = _direction(grad, steps, changes)
        if direction is not None:
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad))
            found = yield from _search(x, value, grad, direction, orthant, number == 0)
        if found is None:
            if failed:
                break
            steps, changes, failed = [], [], True
            continue
        new, new_value, new_grad = found
        steps, changes = [new - x, *steps][:CORRECTIONS], [new_grad - grad, *changes][:CORRECTIONS]
        x, value, grad, failed = new, new_value, new_grad, False
        recent = [*recent, value][-RECENT:]
        number += 1
    return x


def _direction(grad: np.ndarray, steps: list, changes: list) -> np.ndarray | None:
    """Descent direction from the last steps and changes of the gradient; None where these do not fit."""
    d, scale, by = grad.copy(), 1.0, []
    with np.errstate(all="ignore"):
        if steps:
            sy = steps[0] @ changes[0]
            if not sy >= 0:
                return None
            scale = sy / (changes[0] @ changes[0])
        for s, c in zip(steps, changes):
            by.append((s @ d) / (s @ c))
            if math.isnan(by[-1]):
                return None
            d -= by[-1] * c
        d *= scale
        for s, c, a in reversed(list(zip(steps, changes, by))):
            d += (a - (c @ d) / (s @ c)) * s
        return np.where(-d * grad < 0, -d, 0.0)


def _search(x, value, grad, direction, orthant, first: bool):
    """Backtracking line search under the strong Wolfe conditions: (point, value, gradient), or None."""

    def at(step):
        new = x + step * direction
        return np.where(np.sign(new) == np.sign(orthant), new, 0.0)

    slope, shrink = grad @ direction, 0.1 if first else 0.5
    # that optimiser never takes its first step, whatever the value there
    step = shrink * (0.5 / np.linalg.norm(grad) if first else 1.0)
    for number in range(1, SEARCH_STEPS):
        new = at(step)
        new_value, new_grad = yield new
        new_slope = new_grad @ direction
        if new_value > value + step * slope * 1e-4:
            factor = shrink
        elif new_slope < 0.9 * slope:
            factor = 2.1
        elif new_slope > -0.9 * slope:
            factor = shrink
        else:
            factor = 1.0
        if factor == 1.0 or number == SEARCH_STEPS - 1:
            return new, new_value, new_grad
        step *= factor
        if not 1e-10 <= step <= 1e10:
            return None
