"""Logistic models of one table fitted side by side: every fold, penalty and λ in the same scans.

A pass over the rows multiplies them with the weights of all models at once and adds up, by model, the loss, its gradient
and its second derivatives; tasks send one short row per model and Spark adds them. The driver then takes one proximal
Newton step for each model (the exact minimum of a quadratic of as many unknowns as there are features) and the next
pass judges all steps: a step that does not lower its objective is halved. What reaches the driver is (features + 2)²
numbers a model, whatever the number of rows; what is sent out is one weight vector a model.

The objective is that of a penalised fit on scaled features: summed log-loss plus ``lam * (l1_ratio * |w| + (1 - l1_ratio)
/ 2 * w²)``, the intercept free. Each fold has means and deviations of its own training rows; since scaling is linear, the
rows themselves need not be scaled for each fold. Profiles are one column a level; an unknown profile is all zeros.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.session import ship

ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Spec:
    """One penalty; ``lam`` is on the summed loss."""

    name: str
    l1_ratio: float
    lam: float


@dataclass
class Fitted:
    """Weights for scaled features and for the features as they are; the first is the intercept."""

    spec: Spec
    fold: int | None  # the fold left out; None: fitted on all rows
    rows: int
    scaled: np.ndarray
    plain: np.ndarray
    objective: float
    passes: int


@dataclass(frozen=True)
class _Frame:
    """How a row becomes a vector: 1, the numeric columns (centred and scaled over all rows), one column a profile."""

    numeric: tuple
    levels: tuple
    center: np.ndarray
    scale: np.ndarray
    profile: str
    label: str

    @property
    def width(self) -> int:
        return 1 + len(self.numeric) + len(self.levels)

    def rows(self, df: DataFrame, *keep: str) -> DataFrame:
        level = F.array_position(F.array(*[F.lit(v) for v in self.levels]), F.col(self.profile)) if self.levels else F.lit(0)
        numbers = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.numeric)]
        return df.select(*numbers, F.coalesce(level, F.lit(0)).cast("int").alias("_level"), F.col(self.label).cast("double").alias("_y"), *keep)

    def vectors(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, self.width))
        out[:, 0] = 1
        for i in range(len(self.numeric)):
            out[:, 1 + i] = (batch.column(f"_x{i}").to_numpy(zero_copy_only=False) - self.center[i]) / self.scale[i]
        level = batch.column("_level").to_numpy(zero_copy_only=False)
        some = np.flatnonzero(level)
        out[some, len(self.numeric) + level[some]] = 1
        return out


def _moments(df: DataFrame, numeric: Sequence[str], profile: str, fold: str | None):
    """Rows, means and squared deviations of each fold, and the profiles: one job, one row a fold."""
    key = F.coalesce(F.col(fold), F.lit(-1)).cast("int") if fold else F.lit(0)
    sums = [f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(numeric) for n, f in (("m", F.avg), ("v", F.var_pop), ("n", F.count))]
    rows = df.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_rows"), F.collect_set(profile).alias("_levels"), *sums).collect()
    levels = sorted({v for r in rows for v in r["_levels"]})
    parts = {}
    for r in rows:
        if any(r[f"_n{i}"] != r["_rows"] for i in range(len(numeric))):
            raise ValueError("null in a numeric feature")
        mean = np.array([r[f"_m{i}"] for i in range(len(numeric))])
        parts[r["_k"]] = (r["_rows"], mean, np.array([r[f"_v{i}"] for i in range(len(numeric))]) * r["_rows"])
    return parts, levels


def _pooled(parts):
    """Rows, mean and sample deviation of several groups."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    square = sum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts)
    return n, mean, np.sqrt(square / max(n - 1, 1))


def _statistics(df: DataFrame, frame: _Frame, weights: np.ndarray, folds: np.ndarray, fold: str | None):
    """For each model: loss, gradient and upper triangle of the second derivatives over its training rows."""
    width, models = frame.width, len(weights)
    upper = np.triu_indices(width)

    def run(batches):
        loss, slope, bend = np.zeros(models), np.zeros((models, width)), np.zeros((models, len(upper[0])))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                x, y = frame.vectors(batch), batch.column("_y").to_numpy(zero_copy_only=False)[:, None]
                own = batch.column("_fold").to_numpy(zero_copy_only=False)[:, None]
                used = own != folds[None, :]
                z = x @ weights.T
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                loss += ((np.logaddexp(0, z) - y * z) * used).sum(axis=0)
                slope += ((p - y) * used).T @ x
                bend += (p * (1 - p) * used).T @ (x[:, upper[0]] * x[:, upper[1]])
        body = np.concatenate([loss[:, None], slope, bend], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(models), pa.int32()), pa.array([row.tobytes() for row in body], pa.binary())], ["model", "sums"]
        )

    def add(table):
        total = sum(np.frombuffer(v.as_py()) for v in table.column("sums"))
        return pa.table({"model": table.column("model")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    rows = frame.rows(df, (F.coalesce(F.col(fold), F.lit(-1)) if fold else F.lit(0)).cast("int").alias("_fold"))
    kind = "model int, sums binary"
    found = rows.mapInArrow(run, kind).groupBy("model").applyInArrow(add, kind).collect()
    out = np.zeros((models, 1 + width + len(upper[0])))
    for r in found:
        out[r.model] = np.frombuffer(r.sums)
    square = np.zeros((models, width, width))
    square[:, upper[0], upper[1]] = out[:, 1 + width :]
    square[:, upper[1], upper[0]] = out[:, 1 + width :]
    return out[:, 0], out[:, 1 : 1 + width], square


def _newton_point(w, slope, bend, l1, l2):
    """Minimum of the quadratic around ``w`` plus penalties; the first coordinate is free.

    With the zeros and signs of the weights known, the minimum solves a linear system. The search goes from one choice of
    zeros and signs to the next, each with a lower value, until no zero wants to move.
    """
    free = np.arange(len(w)) > 0
    square = bend + np.diag(l2 * free + 1e-10 * np.trace(bend) / len(w) + 1e-12)
    line = slope - bend @ w
    if not l1:
        return np.linalg.solve(square, -line)

    def value(x):
        return x @ square @ x / 2 + line @ x + l1 * np.abs(x[1:]).sum()

    x, signs = w.copy(), np.sign(w) * free
    used = (x != 0) | ~free
    for _ in range(50 * len(w)):
        at, goal = np.flatnonzero(used), np.zeros_like(x)
        goal[at] = np.linalg.solve(square[np.ix_(at, at)], -(line + l1 * signs)[at])
        turned = at[free[at] & (np.sign(goal[at]) != signs[at])]
        if len(turned):  # go only as far as the value falls, to a point where some weight becomes zero
            crossing = turned[x[turned] != 0]
            points = [goal]
            for j in crossing:
                point = x + x[j] / (x[j] - goal[j]) * (goal - x)
                point[j] = 0.0
                points.append(point)
            best = min(points, key=value)
            if not value(best) < value(x):
                used[turned] = x[turned] != 0
                if len(crossing):
                    return x
                signs = np.sign(x) * free
                continue
            x = best
            signs, used = np.sign(x) * free, (x != 0) | ~free
            continue
        x = goal
        pull = square @ x + line
        over = np.where(used, 0.0, np.abs(pull) - l1)
        j = int(np.argmax(over))
        if over[j] <= 1e-9 * (1 + l1):
            return x
        used[j], signs[j] = True, -np.sign(pull[j])
    return x


class _Model:
    """One model on its way down: the accepted point, the point being judged, and how they compare."""

    def __init__(self, spec: Spec, fold, rows: int, mean, std, frame: _Frame, tol: float):
        self.spec, self.fold, self.rows, self.tol = spec, fold, rows, tol
        self.l1, self.l2 = spec.lam * spec.l1_ratio, spec.lam * (1 - spec.l1_ratio)
        width, k = frame.width, 1 + len(frame.numeric)
        shift, spread = (mean - frame.center) / frame.scale, std / frame.scale
        inverse = np.where(spread > 1e-12, 1 / np.where(spread > 1e-12, spread, 1), 0.0)
        self.to_rows = np.eye(width)  # scaled weights to those of the rows as sent
        self.to_rows[range(1, k), range(1, k)] = inverse
        self.to_rows[0, 1:k] = -shift * inverse
        self.at = self.trial = np.zeros(width)
        self.value, self.step, self.share, self.done, self.passes = np.inf, None, 1.0, False, 0

    def judge(self, loss, slope, bend) -> None:
        self.passes += 1
        w = self.trial[1:]
        value = loss + self.l1 * np.abs(w).sum() + self.l2 / 2 * (w**2).sum()
        if value > self.value + 1e-12 * abs(self.value):  # too far: half the way
            self.share /= 2
            self.done = self.share < 1e-6
            self.trial = self.at + self.share * self.step
            return
        gained, self.value, self.at = self.value - value, value, self.trial
        new = _newton_point(self.at, self.to_rows.T @ slope, self.to_rows.T @ bend @ self.to_rows, self.l1, self.l2)
        self.step, self.share = new - self.at, 1.0
        self.trial = new
        small = np.abs(self.step).max() <= self.tol * (1 + np.abs(self.at).max())
        self.done = small or gained <= 1e-11 * abs(value)

    def result(self, frame: _Frame) -> Fitted:
        sent = self.to_rows @ self.at
        plain = sent.copy()
        k = 1 + len(frame.numeric)
        plain[1:k] = sent[1:k] / frame.scale
        plain[0] = sent[0] - (plain[1:k] * frame.center).sum()
        return Fitted(self.spec, self.fold, self.rows, self.at, plain, float(self.value), self.passes)


@dataclass
class Fits:
    """All fitted models of a table and what is needed to score rows with them."""

    models: list[Fitted]
    frame: _Frame

    @property
    def features(self) -> list[str]:
        return [*self.frame.numeric, *[f"{self.frame.profile}_{v}" for v in self.frame.levels]]

    def scores(self, df: DataFrame, fold: str | None, unit: str, val_only: bool = False) -> DataFrame:
        """``(modelo, lambda, fold, split, unit, label, puntaje)`` for each row and model, by one pass."""
        models, frame = self.models, self.frame
        weights = np.array([m.plain for m in models])
        folds = np.array([-2 if m.fold is None else m.fold for m in models])
        center = _Frame(frame.numeric, frame.levels, np.zeros(len(frame.numeric)), np.ones(len(frame.numeric)), frame.profile, frame.label)
        names = pa.array([m.spec.name for m in models])
        lambdas = np.array([m.spec.lam for m in models])

        def run(batches):
            step = max(1, 200_000 // len(models))
            for whole in batches:
                for at in range(0, whole.num_rows, step):
                    batch = whole.slice(at, step)
                    z = np.clip(center.vectors(batch) @ weights.T, -500, 500)
                    own = batch.column("_fold").to_numpy(zero_copy_only=False)
                    val = own[:, None] == folds[None, :]
                    row, model = np.nonzero(val if val_only else np.ones_like(val))
                    split = pa.array(["train", "val"]).take(pa.array(val[row, model].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(model)), pa.array(lambdas[model]), pa.array(folds[model], pa.int32()), split,
                            batch.column(unit).take(pa.array(row)), batch.column(frame.label).take(pa.array(row)),
                            pa.array(1 / (1 + np.exp(-z[row, model]))),
                        ],
                        ["modelo", "lambda", "fold", "split", unit, frame.label, "puntaje"],
                    )

        key = (F.coalesce(F.col(fold), F.lit(-1)) if fold else F.lit(-1)).cast("int").alias("_fold")
        rows = center.rows(df, key, F.col(unit).cast("string").alias(unit), F.col(frame.label).cast("int").alias(frame.label))
        kind = f"modelo string, lambda double, fold int, split string, `{unit}` string, `{frame.label}` int, puntaje double"
        return rows.mapInArrow(run, kind)


def fit(
    df: DataFrame, numeric: Sequence[str], specs: Sequence[Spec], label: str, profile: str, fold: str | None = None,
    folds: Sequence[int] = (), tol: float = 1e-6, most_passes: int = 100,
) -> Fits:
    """Fit every spec: without ``fold`` on all rows, else once for each of ``folds`` on the rows outside it.

    ``df`` is a written table; each pass reads it once.
    """
    ship(df.sparkSession)
    parts, levels = _moments(df, numeric, profile, fold)
    if not parts:
        raise ValueError("no rows to fit")
    _, center, std = _pooled(list(parts.values()))
    frame = _Frame(tuple(numeric), tuple(levels), center, np.where(std > 0, std, 1.0), profile, label)
    running = []
    for k in folds if fold else [None]:
        n, mean, own = _pooled([p for key, p in parts.items() if key != k])
        running += [_Model(s, k, n, mean, own, frame, tol) for s in specs]
    for _ in range(most_passes):
        active = [m for m in running if not m.done]
        if not active:
            break
        weights = np.array([m.to_rows @ m.trial for m in active])
        left_out = np.array([-2 if m.fold is None else m.fold for m in active])
        for model, *sums in zip(active, *_statistics(df, frame, weights, left_out, fold)):
            model.judge(*sums)
    return Fits([m.result(frame) for m in running], frame)
