"""Implicit ALS of many settings at once, where items are few.

A person's factors follow from the item factors and from how often the person met each item,
so people with equal counts are one case, and nothing of a person has to be kept or moved
between steps: a task takes its cases, solves them for every model and sends sums for the
items. All models take a step in one job, and settings that differ in the number of steps
only are stations of one fit.

The steps are those of Spark's implicit, non-negative ALS with every rating 1, from random item
factors on. A person's x minimises
|Yx|^2 + alpha n (Yx)^2 - 2 (1 + alpha) n Yx summed over items + reg N |x|^2 with x >= 0, where n
counts the person's rows of an item and N all of them. At the minimum x = max(0, Y'g) with one
number g per item, so the search is for few numbers, not for a rank's worth of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.session import cut_lineage

#: Most items; a model's sums are (items + 1) x rank x rank.
FEW_ITEMS = 16
#: Cases of a task at least; beyond that there are as many tasks as cores.
CASES_PER_TASK = 1_000
#: Newton steps before they are damped, and in all.
PLAIN_STEPS, STEPS = 15, 300


@dataclass(frozen=True)
class Fit:
    """One model on its way: the fold it leaves out and its item factors."""

    fold: int
    alpha: float
    reg: float
    items: np.ndarray


def start(n_items: int, rank: int, seed: int) -> np.ndarray:
    """Random non-negative item factors of length 1."""
    factors = np.abs(np.random.default_rng(seed).standard_normal((n_items, rank)))
    return factors / np.linalg.norm(factors, axis=1, keepdims=True)


def people_step(rows: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Scores of every item and factors for cases with ``rows`` (cases x items) training rows; zeros without any."""
    y, (n, m) = fit.items, rows.shape
    scores, total = np.zeros((n, m)), rows.sum(axis=1)
    left = np.flatnonzero(total > 0)
    per = fit.reg * np.maximum(total, 1)[:, None]
    wanted, slope = (1 + fit.alpha) * rows / per, (1 + fit.alpha * rows) / per
    products = (y[:, None, :] * y[None, :, :]).reshape(m * m, -1).T

    def objective(g: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (np.maximum(g @ y, 0) ** 2).sum(axis=1) + ((g - wanted[at]) ** 2 / slope[at]).sum(axis=1)

    for turn in range(STEPS):
        if not len(left):
            break
        c, q, s = wanted[left], slope[left], scores[left]
        used = (c - q * s) @ y > 0
        inner = (used.astype(np.float64) @ products).reshape(-1, m, m)
        found = np.linalg.solve(np.eye(m) + inner * q[:, None, :], inner @ c[:, :, None])[:, :, 0]
        if turn >= PLAIN_STEPS:
            before, step = objective(c - q * s, left), np.ones(len(left))
            for _ in range(30):
                worse = objective(c - q * (s + step[:, None] * (found - s)), left) > before
                if not worse.any():
                    break
                step[worse] /= 2
            found = s + step[:, None] * (found - s)
        scores[left] = found
        same = (((c - q * found) @ y > 0) == used).all(axis=1)
        still = np.abs(found - s).max(axis=1) <= 1e-11 * np.abs(found).max(axis=1)
        left = left[~(same | still)]
    if len(left):
        raise ArithmeticError(f"{len(left)} cases did not converge")
    factors = np.maximum((wanted - slope * scores) @ y, 0)
    factors[total == 0] = 0
    return scores, factors


def nonnegative(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises x'ax / 2 - b'x for a positive definite ``a``, by block pivoting."""
    free, fewest, tries = np.ones(len(b), bool), len(b) + 1, 3
    limit = 1e-12 * np.abs(b).max(initial=0)
    while True:
        x = np.zeros(len(b))
        x[free] = np.linalg.solve(a[np.ix_(free, free)], b[free])
        slack = a @ x - b
        wrong = np.flatnonzero(np.where(free, x < 0, slack < -limit))
        if not len(wrong):
            return x
        if len(wrong) < fewest:
            fewest, tries = len(wrong), 3
        elif tries:
            tries -= 1
        else:  # one at a time always ends
            wrong = wrong[-1:]
        free[wrong] = ~free[wrong]


def _counts(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def _item_sums(rows: np.ndarray, people: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Upper halves of X'X over all people and over each item's rows, sums of X and numbers of rows per item."""
    upper = np.triu_indices(factors.shape[1])
    weights = [people, *(people[:, None] * rows).T]
    return np.concatenate([
        *[(factors.T @ (factors * w[:, None]))[upper] for w in weights], *[w @ factors for w in weights[1:]],
        [w.sum() for w in weights[1:]]])


def items_step(sums: np.ndarray, fit: Fit) -> np.ndarray:
    """Item factors from the sums over all people; zeros for an item without rows."""
    m, rank = fit.items.shape
    half = rank * (rank + 1) // 2
    squares = np.zeros((m + 1, rank, rank))
    squares[:, *np.triu_indices(rank)] = sums[:(m + 1) * half].reshape(m + 1, half)
    squares += np.triu(squares, 1).transpose(0, 2, 1)
    firsts = sums[(m + 1) * half:-m].reshape(m, rank)
    return np.array([
        nonnegative(squares[0] + fit.alpha * squares[i + 1] + fit.reg * n * np.eye(rank), (1 + fit.alpha) * firsts[i])
        if n else np.zeros(rank) for i, n in enumerate(sums[-m:])])


def one_step(cases: DataFrame, fits: list[Fit]) -> list[Fit]:
    """All fits after one more step on ``cases`` (fold, rows, people); only item factors come to the driver."""
    shared = cases.sparkSession.sparkContext.broadcast(fits)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            fold, rows, people = batch.column("fold").to_numpy(), _counts(batch, "rows"), batch.column("people").to_numpy()
            for i, fit in enumerate(shared.value):
                mine = np.flatnonzero(fold == fit.fold)
                if len(mine):
                    sums[i] = sums.get(i, 0) + _item_sums(rows[mine], people[mine], people_step(rows[mine], fit)[1])
        for i, found in sums.items():
            yield pa.RecordBatch.from_pydict({"fit": pa.array([i], pa.int32()), "sums": pa.array([found.tobytes()], pa.binary())})

    def solved(group: pd.DataFrame) -> pd.DataFrame:
        i = group["fit"].iloc[0]
        sums = sum(np.frombuffer(s) for s in group["sums"])
        return pd.DataFrame({"fit": [i], "items": [items_step(sums, shared.value[i]).ravel()]})

    found = cases.mapInArrow(part, "fit int, sums binary").groupBy("fit").applyInPandas(
        solved, "fit int, items array<double>").collect()
    shared.unpersist()
    after = {r.fit: np.array(r["items"]) for r in found}
    return [replace(fit, items=after[i].reshape(fit.items.shape) if i in after else np.zeros_like(fit.items))
            for i, fit in enumerate(fits)]


def all_fits(cases: DataFrame, n_items: int, settings: list[dict], folds: tuple[int, ...], seed: int) -> dict[tuple[int, int], Fit]:
    """The fit of every (place in ``settings``, fold) on ``cases`` (fold, rows, people)."""
    cores = cases.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, cases.count() // CASES_PER_TASK))
    cases = cases.repartition(parts).persist()
    keys = sorted({(s["rank"], s["reg"], s["alpha"], f) for s in settings for f in folds})
    fits = [Fit(f, alpha, reg, start(n_items, rank, seed)) for rank, reg, alpha, f in keys]
    lengths = {key: max(s["max_iter"] for s in settings if (s["rank"], s["reg"], s["alpha"]) == key[:3]) for key in keys}
    found, at = {}, dict(zip(keys, fits))
    try:
        for turn in range(1, max(lengths.values()) + 1):
            running = [key for key in keys if lengths[key] >= turn]
            at |= zip(running, one_step(cases, [at[key] for key in running]))
            found |= {(i, f): at[s["rank"], s["reg"], s["alpha"], f]
                      for i, s in enumerate(settings) if s["max_iter"] == turn for f in folds}
    finally:
        cases.unpersist()
    return found


SCORED = "setting int, fold int, squares double, misses double, met double, away double, attended double, best double"


def scored(cases: DataFrame, fits: dict[tuple[int, int], Fit]) -> DataFrame:
    """Sums that errors and ranks need, per setting and fold, over ``cases`` (fold, rows, held, cells, people).

    squares: of errors over all cells. misses, met: of errors over attended cells that the model
    knows, and their number. away, attended, best: as in ``rank_bar``.
    """
    shared = cases.sparkSession.sparkContext.broadcast(list(fits.items()))
    names = [field.split(" ")[0] for field in SCORED.split(", ")]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, people = batch.column("fold").to_numpy(), batch.column("people").to_numpy()
            rows, held, cells = (_counts(batch, c) for c in ("rows", "held", "cells"))
            out = []
            for (setting, f), fit in shared.value:
                mine = np.flatnonzero(fold == f)
                if not len(mine):
                    continue
                s, h, c, w = people_step(rows[mine], fit)[0], held[mine], cells[mine], people[mine]
                known = h * (rows[mine].sum(axis=1) > 0)[:, None] * fit.items.any(axis=1)
                best = np.where(c > 0, s, 0).max(axis=1)
                far = np.where(best > 0, h.sum(axis=1) - (h * s).sum(axis=1) / np.where(best > 0, best, 1), 0)
                out.append((setting, f, w @ (c * s * s + h * (1 - 2 * s)).sum(axis=1), w @ (known * (1 - s) ** 2).sum(axis=1),
                            w @ known.sum(axis=1), 100 * (w @ far), w @ h.sum(axis=1), best.max()))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names).astype({"setting": "int32", "fold": "int32"}),
                                             preserve_index=False)

    return cases.mapInArrow(part, SCORED).groupBy("setting", "fold").agg(
        *[F.sum(c).alias(c) for c in names[2:-1]], F.max("best").alias("best"))


def stored_cases(people: DataFrame) -> DataFrame:
    """Equal rows of ``people`` (fold, rows, held, cells) once, with their number."""
    return cut_lineage(people.groupBy("fold", "rows", "held", "cells").agg(F.count(F.lit(1)).alias("people")))
