"""Regression jobs on Spark ML, with their metrics and coefficient tables."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import PySparkException
from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from py4j.protocol import Py4JError

from emporia.sources.shared import written

FEATURES = "features"
WEIGHT = "training_weight"


def feature_table(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Rows without a missing value, features as one vector column."""
    used = df.dropna(subset=[*columns, target])
    numbers = used.withColumns({c: F.col(c).cast("double") for c in [*columns, target]})
    return VectorAssembler(inputCols=columns, outputCol=FEATURES).transform(numbers)


def regression_metrics(predicted: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R² in one pass; the spread is taken around the mean of the same rows."""
    rows = predicted.select(F.col(target).cast("double").alias("y"), F.col(prediction).alias("p")).dropna()
    error = F.col("y") - F.col("p")
    spread = F.var_pop("y") * F.count("y")
    return rows.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        F.count("y").alias("rows"),
    )


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares of ``y`` on one column with in-sample metrics, from two aggregations."""
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    line = rows.agg(F.regr_intercept("y", "x").alias("intercept"), F.regr_slope("y", "x").alias("slope"))
    fitted = rows.crossJoin(F.broadcast(line)).withColumn("prediction", F.col("intercept") + F.col("slope") * F.col("x"))
    return line.crossJoin(F.broadcast(regression_metrics(fitted, "y")))


def independent_columns(df: DataFrame, columns: list[str], least: float = 1e-9) -> tuple[list[str], list[str]]:
    """The columns in order without those that the ones before them and a constant explain, and these.

    One aggregate makes the covariances of all pairs of columns, a figure for each; they are eliminated column by
    column, and a column is explained when less than ``least`` of its variance is left.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    figures = numbers.agg(*[F.covar_pop(columns[i], columns[j]).alias(f"c{n}") for n, (i, j) in enumerate(pairs)]).first()
    held = {pair: figures[n] or 0.0 for n, pair in enumerate(pairs)}
    left = {(i, j): held[min(i, j), max(i, j)] for i in range(len(columns)) for j in range(len(columns))}
    kept, dropped = [], []
    for k, name in enumerate(columns):
        if left[k, k] <= least * held[k, k] or held[k, k] == 0.0:
            dropped.append(name)
            continue
        kept.append(name)
        row = [left[k, j] for j in range(len(columns))]
        for i in range(k + 1, len(columns)):
            share = left[i, k] / row[k]
            for j in range(k, len(columns)):
                left[i, j] -= share * row[j]
    return kept, dropped


def linear_model(train: DataFrame, target: str):
    """Ordinary least squares through the normal equations; features are used as they are."""
    return LinearRegression(
        featuresCol=FEATURES, labelCol=target, solver="normal", regParam=0.0, standardization=False
    ).fit(train)


def coefficient_table(model, names: list[str], train: DataFrame) -> DataFrame:
    """Coefficient and standard error per feature and for the intercept.

    Collinear features have no standard errors: the normal equations are singular and the fit is iterative.
    :func:`least_squares` leaves such features out.
    """
    try:
        errors = list(model.summary.coefficientStandardErrors)
    except (Py4JError, PySparkException):
        errors = [None] * (len(names) + 1)
    values = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    rows = list(zip([*names, "const"], values, errors))
    return train.sparkSession.createDataFrame(rows, "feature string, coefficient double, std_error double")


def least_squares(df: DataFrame, columns: list[str], target: str):
    """The fit on the independent columns, its features, the table it was fitted on, and the columns that were dropped."""
    kept, dropped = independent_columns(df.dropna(subset=[*columns, target]), columns)
    table = feature_table(df, kept, target)
    return linear_model(table, target), kept, table, dropped


def fitted_table(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """``feature, coefficient, std_error, dropped``: a dropped column has neither coefficient nor error."""
    model, kept, table, dropped = least_squares(df, columns, target)
    found = coefficient_table(model, kept, table).withColumn("dropped", F.lit(False))
    if not dropped:
        return found
    rows = [(name, None, None, True) for name in dropped]
    return found.unionByName(df.sparkSession.createDataFrame(rows, found.schema))


#: Rows that a task of a tree learner reads at least: it runs some jobs for every tree.
ROWS_PER_TASK = 50_000


def training_rows(train: DataFrame, target: str) -> DataFrame:
    """Features and target alone, written once and read in no more parts than their number of rows is worth."""
    rows = written(train.select(FEATURES, target), "training-rows")
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK)))


def training_cells(train: DataFrame, target: str) -> DataFrame:
    """One row for all rows with the same features: the mean of their target, and their number in :data:`WEIGHT`.

    For squared errors without sampling, a mean with its weight is worth the rows themselves: what they differ by in a
    cell is the same in every split.
    """
    cells = train.groupBy(FEATURES).agg(F.avg(target).alias(target), F.count(target).cast("double").alias(WEIGHT))
    rows = written(cells, "training-cells")
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK)))


def boosted_trees(train: DataFrame, target: str, *, depth: int = 3, trees: int = 100, rate: float = 0.05):
    return GBTRegressor(
        featuresCol=FEATURES, labelCol=target, weightCol=WEIGHT, maxDepth=depth, maxIter=trees, stepSize=rate, seed=42
    ).fit(training_cells(train, target))


#: Bins of a feature in a forest; Spark's learners have as many by default.
BINS = 32
TREES_AT_ONCE = 8  # trees that learn at the same time: one alone keeps few cores busy


def candidate_cuts(rows: DataFrame, columns: list[str]) -> list[list[float]]:
    """Cuts of each column: between all its values where there are up to :data:`BINS`, else at quantiles of all rows."""
    some = [rows.select(F.lit(i).alias("i"), F.col(c).alias("v")).distinct().limit(BINS + 1) for i, c in enumerate(columns)]
    found = reduce(DataFrame.unionByName, some).collect()  # BINS + 1 values of a column at most
    values = [sorted(r["v"] for r in found if r["i"] == i) for i in range(len(columns))]
    wide = [c for c, held in zip(columns, values) if len(held) > BINS]
    quantiles = rows.approxQuantile(wide, [i / BINS for i in range(1, BINS)], 1e-4) if wide else []
    cuts = dict(zip(wide, quantiles))
    return [sorted(set(cuts[c])) if c in cuts else [a + (b - a) / 2 for a, b in zip(v, v[1:])] for c, v in zip(columns, values)]


def binned(df: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """``_bin_i``: the number of the cuts of feature ``i`` that its value reaches."""
    value = vector_to_array(FEATURES)
    reached = [sum(((value[i] >= cut).cast("int") for cut in held), F.lit(0)) for i, held in enumerate(cuts)]
    return df.withColumns({f"_bin_{i}": n.cast("double") for i, n in enumerate(reached)})


def drawn_cells(cells: DataFrame, trees: int, seed: int) -> DataFrame:
    """``_draws_t``: how often the bootstrap of tree ``t`` draws the ``_rows`` rows of a cell.

    Spark's forest draws each row a Poisson number of times with mean one; the draws of ``n`` rows that a tree cannot
    tell apart add up to a Poisson number with mean ``n``. The draws of a cell depend on its values alone.
    """
    names = [c for c in cells.columns if c != "_rows"]
    draws = [f"_draws_{t}" for t in range(trees)]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = np.empty((len(batch), trees), dtype=np.int64)
            for at, (key, n) in enumerate(zip(batch["_key"].to_numpy(), batch["_rows"].to_numpy())):
                made[at] = np.random.default_rng([seed, int(key) & (1 << 64) - 1]).poisson(n, trees)
            yield pd.concat([batch[names], pd.DataFrame(made, columns=draws, index=batch.index)], axis=1)

    schema = ", ".join([*[f"`{c}` double" for c in names], *[f"{c} bigint" for c in draws]])
    return cells.withColumn("_key", F.xxhash64(*names)).mapInPandas(draw, schema)


@dataclass(frozen=True)
class Forest:
    """Regression trees on binned features; the forest predicts their mean."""

    cuts: list[list[float]]
    trees: list[DecisionTreeRegressionModel]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its ``prediction``; the trees read each combination of bins once."""
        bins = [f"_bin_{i}" for i in range(len(self.cuts))]
        placed = binned(df, self.cuts)
        told = VectorAssembler(inputCols=bins, outputCol="_bins").transform(placed.select(*bins).distinct())
        for tree in self.trees:
            told = tree.transform(told)
        mean = sum((F.col(t.getPredictionCol()) for t in self.trees), F.lit(0.0)) / len(self.trees)
        return placed.join(written(told.select(*bins, mean.alias("prediction")), "predictions"), bins).drop(*bins)

    @property
    def featureImportances(self) -> DenseVector:  # the name that Spark's models have
        """The trees' importances, each with sum one as far as the tree has a split, scaled to sum one."""
        total = sum((t.featureImportances.toArray() for t in self.trees), np.zeros(len(self.cuts)))
        return Vectors.dense(total / total.sum() if total.sum() else total)


def random_forest(train: DataFrame, target: str, *, trees: int = 100, depth: int = 10, seed: int = 42) -> Forest:
    """All features are tried at each split; the depth is bounded, Spark allows 30 at most.

    A tree sees a row only through its bins and its target, so rows that agree in them are one cell and the trees learn
    from cells weighted with their draws. The cells are bounded by the bins and the values of the target, whatever the
    number of rows; a target that rarely repeats leaves as many cells as rows. A tree that drew no row is left out.
    """
    rows = written(train.select(FEATURES, target), "training-rows")
    one = rows.first()
    if one is None:
        raise ValueError("no rows to learn from")
    columns = [f"_feature_{i}" for i in range(one[FEATURES].size)]
    value = vector_to_array(FEATURES)
    cuts = candidate_cuts(rows.select(*[value[i].alias(c) for i, c in enumerate(columns)]), columns)
    bins = [f"_bin_{i}" for i in range(len(cuts))]
    cells = binned(rows, cuts).groupBy(*bins, F.col(target).alias("_target")).agg(F.count(F.lit(1)).alias("_rows"))
    held = written(drawn_cells(cells, trees, seed), "training-cells")
    most = held.agg(F.count(F.lit(1)).alias("cells"), *[F.max(f"_draws_{t}").alias(f"_{t}") for t in range(trees)]).first()
    parts = max(1, -(-most["cells"] // ROWS_PER_TASK))
    table = VectorAssembler(inputCols=bins, outputCol="_bins").transform(held.coalesce(parts))

    def fit(t: int) -> DecisionTreeRegressionModel:
        learner = DecisionTreeRegressor(
            featuresCol="_bins", labelCol="_target", weightCol=f"_draws_{t}", predictionCol=f"_prediction_{t}",
            maxDepth=depth, maxBins=BINS * 8, seed=seed,
        )  # its cuts lie between the bins; it would find them from a sample of squared maxBins rows
        return learner.fit(table.select("_bins", "_target", f"_draws_{t}").where(F.col(f"_draws_{t}") > 0))

    with ThreadPoolExecutor(TREES_AT_ONCE) as pool:
        return Forest(cuts, list(pool.map(fit, [t for t in range(trees) if most[f"_{t}"]])))


def importance_table(model: Model | Forest, names: list[str], train: DataFrame) -> DataFrame:
    values = model.featureImportances.toArray().tolist()  # one number per feature
    return train.sparkSession.createDataFrame(list(zip(names, values)), "feature string, importance double")


def grid_search(
    train: DataFrame,
    target: str,
    *,
    depths: tuple[int, ...] = (3, 5, 7),
    trees: tuple[int, ...] = (100, 200, 300),
    rates: tuple[float, ...] = (0.1, 0.05, 0.01),
    folds: int = 3,
    parallelism: int = 4,
):
    """Boosted trees over a parameter grid, scored by R² with cross validation."""
    learner = GBTRegressor(featuresCol=FEATURES, labelCol=target, seed=42)
    grid = (
        ParamGridBuilder()
        .addGrid(learner.maxDepth, list(depths))
        .addGrid(learner.maxIter, list(trees))
        .addGrid(learner.stepSize, list(rates))
        .build()
    )
    return CrossValidator(
        estimator=learner,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=target, metricName="r2"),
        numFolds=folds,
        parallelism=parallelism,
        seed=42,
    ).fit(train)


def grid_table(fitted, train: DataFrame) -> DataFrame:
    """Mean R² per parameter set: one row per point of the grid."""
    rows = []
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        named = {param.name: value for param, value in params.items()}
        rows.append((named["maxDepth"], named["maxIter"], float(named["stepSize"]), float(score)))
    return train.sparkSession.createDataFrame(rows, "max_depth int, trees int, rate double, r2 double")
