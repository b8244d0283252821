"""Full grid search of boosted trees over two binned features.

Trees on binned features see a row only through its cell, so the training rows are reduced on Spark to one row per
cell and fold with their number, sum and sum of squares of the target: at most ``bins`` squared times the folds,
whatever the size of the table. Boosting on the cells gives the same trees as boosting on the rows. One task of Spark
fits one depth, rate and fold; as boosting adds tree after tree, the shorter forests are read off the longest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
# The functions that run in Spark's tasks travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cells(train: DataFrame, features: tuple[str, str], target: str, key: str, folds: int, bins: int = BINS) -> DataFrame:
    """``fold, b0, b1, n, y, yy``: rows, sum and sum of squares of the target by fold and pair of bins."""
    numbers = train.select(F.col(key).cast("string").alias("k"), *[F.col(c).cast("double").alias(c) for c in (*features, target)])
    used = numbers.dropna(subset=[*features, target])
    cuts = used.approxQuantile(list(features), [i / bins for i in range(1, bins)], 0.001)
    digest = F.conv(F.substring(F.md5(F.coalesce("k", F.lit(""))), 1, 8), 16, 10).cast("long")
    placed = used.select(
        (digest % folds).alias("fold"),
        *[
            sum(((F.col(c) > edge).cast("int") for edge in sorted(set(edges))), F.lit(0)).alias(f"b{i}")
            for i, (c, edges) in enumerate(zip(features, cuts))
        ],
        F.col(target).alias("t"),
    )
    return placed.groupBy("fold", "b0", "b1").agg(
        F.count(F.lit(1)).alias("n"), F.sum("t").alias("y"), F.sum(F.col("t") * F.col("t")).alias("yy")
    )


def _best_cut(n: np.ndarray, r: np.ndarray) -> tuple[float, int, int]:
    """Largest gain over all cuts of a rectangle of cells: gain, axis and place."""
    total_n, total_r = n.sum(), r.sum()
    best = (1e-9, -1, 0)
    for axis in (0, 1):
        left_n, left_r = n.sum(axis=1 - axis).cumsum()[:-1], r.sum(axis=1 - axis).cumsum()[:-1]
        right_n = total_n - left_n
        whole = (left_n > 0) & (right_n > 0)
        if not whole.any():
            continue
        gain = np.full(len(left_n), -1.0)
        gain[whole] = left_r[whole] ** 2 / left_n[whole] + (total_r - left_r[whole]) ** 2 / right_n[whole]
        at = int(gain.argmax())
        if gain[at] - total_r**2 / total_n > best[0]:
            best = (gain[at] - total_r**2 / total_n, axis, at + 1)
    return best


def _grow(n: np.ndarray, r: np.ndarray, out: np.ndarray, depth: int) -> None:
    """Write the leaf means of a tree on residual sums ``r`` into ``out``."""
    gain, axis, at = _best_cut(n, r) if depth else (0.0, -1, 0)
    if axis < 0:
        out[:] = r.sum() / max(n.sum(), 1)
        return
    for part in (slice(None, at), slice(at, None)):
        where = (part, slice(None)) if axis == 0 else (slice(None), part)
        _grow(n[where], r[where], out[where], depth - 1)


def boosted_scores(
    n: np.ndarray, y: np.ndarray, test: tuple[np.ndarray, np.ndarray, float], depth: int, rate: float, marks: tuple[int, ...]
) -> list[float]:
    """R² on the test cells (rows, sums, sum of squares) after each number of trees in ``marks``."""
    test_n, test_y, test_yy = test
    made = np.full(n.shape, y.sum() / max(n.sum(), 1))
    step = np.zeros(n.shape)
    spread = test_yy - test_y.sum() ** 2 / max(test_n.sum(), 1)
    out = []
    for trees in range(1, max(marks) + 1):
        _grow(n, y - n * made, step, depth)
        made += rate * step
        if trees in marks:
            error = test_yy - 2 * (made * test_y).sum() + (made * made * test_n).sum()
            out.append(float(1 - error / spread) if spread > 0 else float("nan"))
    return out


def full_grid(
    train: DataFrame,
    features: tuple[str, str],
    target: str,
    key: str,
    *,
    depths: tuple[int, ...] = (3, 5, 7),
    trees: tuple[int, ...] = (100, 200, 300),
    rates: tuple[float, ...] = (0.1, 0.05, 0.01),
    folds: int = 3,
) -> DataFrame:
    """``max_depth, trees, rate, r2``: mean R² over the folds for every point of the grid."""
    held = cells(train, features, target, key, folds).toPandas()  # at most bins * bins * folds rows
    shape = (int(held["b0"].max()) + 1, int(held["b1"].max()) + 1) if len(held) else (1, 1)

    def grids(rows: pd.DataFrame) -> list[np.ndarray]:
        made = []
        for column in ("n", "y", "yy"):
            grid = np.zeros(shape)
            np.add.at(grid, (rows["b0"].to_numpy(), rows["b1"].to_numpy()), rows[column].to_numpy(float))
            made.append(grid)
        return made

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for depth, rate, fold in batch.itertuples(index=False):
                n, y, _ = grids(held[held["fold"] != fold])
                test_n, test_y, test_yy = grids(held[held["fold"] == fold])
                scores = boosted_scores(n, y, (test_n, test_y, float(test_yy.sum())), int(depth), rate, trees)
                rows += [(int(depth), count, rate, score) for count, score in zip(sorted(trees), scores)]
            yield pd.DataFrame(rows, columns=["max_depth", "trees", "rate", "r2"])

    points = [(d, r, f) for d, r, f in product(depths, rates, range(folds))]
    tasks = train.sparkSession.createDataFrame(points, "depth int, rate double, fold int").repartition(len(points))
    scored = tasks.mapInPandas(fit, "max_depth int, trees int, rate double, r2 double")
    return scored.groupBy("max_depth", "trees", "rate").agg(F.avg("r2").alias("r2"))
