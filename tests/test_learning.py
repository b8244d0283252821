"""Feature tables, regressions and the forecast."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.ml import features, forecast, models
from emporia.ml.grid import boosted_scores, cells, full_grid

# The published monthly figures (neutral, positive, negative and all mentions, orders, mean note).
MONTHS = [
    (15613, 25216, 24661, 65490, 3775, 3.02),
    (16409, 22294, 13533, 52236, 12828, 2.96),
    (23978, 21786, 31480, 77244, 4621, 3.04),
    (30838, 26620, 22498, 79956, 4034, 2.96),
    (25156, 32684, 23615, 81455, 4672, 3.11),
    (35058, 13952, 34179, 83189, 4101, 3.03),
    (29055, 24476, 37904, 91435, 4445, 3.1),
    (31175, 39753, 26356, 97284, 4329, 3.09),
    (40927, 29372, 34782, 105081, 4868, 3.0),
    (13740, 42741, 35031, 91512, 6400, 3.08),
    (34933, 34671, 24925, 94529, 4508, 3.09),
    (25760, 23791, 31192, 80743, 12294, 3.01),
    (4079, 1657, 0, 5736, 9125, 3.0),
]


def test_correlations_of_the_published_months(spark):
    names = ["neutral", "positive", "negative", "total", "orders", "note"]
    matrix = features.correlation_matrix(spark.createDataFrame(MONTHS, names), names)
    found = {(r["a"], r["b"]): r["r"] for r in matrix.collect()}
    assert len(found) == 36 and found[("note", "note")] == pytest.approx(1.0)
    for name, orders, note in (
        ("neutral", -0.465, 0.171),
        ("positive", -0.308, 0.517),
        ("negative", -0.428, 0.409),
        ("total", -0.489, 0.451),
    ):
        assert found[(name, "orders")] == pytest.approx(orders, abs=5e-4) == found[("orders", name)]
        assert found[(name, "note")] == pytest.approx(note, abs=5e-4)


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 5.0), (4.0, None, 2.0)], "a double, b double, c double")
    found = {(r["a"], r["b"]): r["r"] for r in features.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert found[("a", "c")] == pytest.approx(np.corrcoef([2, 3, 4], [1, 5, 2])[0, 1])


def sample(spark, n=400):
    rng = np.random.default_rng(5)
    x, z = rng.normal(size=n), rng.integers(0, 3, size=n)
    y = 2 + 3 * x - 1.5 * (z == 1) + rng.normal(scale=0.5, size=n)
    rows = [(i, float(a), "uvw"[b], float(c)) for i, (a, b, c) in enumerate(zip(x, z, y))]
    return spark.createDataFrame(rows, "id int, x double, z string, y double"), x, z, y


def test_multiple_regression_equals_least_squares(spark):
    df, x, z, y = sample(spark)
    coded, columns = features.one_hot(df, "z", ["u", "v", "w"], drop_first=True)
    assert columns == ["z_v", "z_w"]
    names = ["x", *columns]
    table = models.feature_table(coded, names, "y")
    found = {r["feature"]: r for r in models.coefficient_table(models.linear_model(table, "y"), names, table).collect()}
    design = np.column_stack([x, z == 1, z == 2, np.ones(len(x))]).astype(float)
    beta, residual, *_ = np.linalg.lstsq(design, y, rcond=None)
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * residual[0] / (len(y) - 4))
    for name, value, error in zip([*names, "const"], beta, errors):
        assert found[name]["coefficient"] == pytest.approx(value, abs=1e-6)
        assert found[name]["std_error"] == pytest.approx(error, abs=1e-6)


def test_simple_regression_and_metrics(spark):
    df, x, _, y = sample(spark)
    slope, intercept = np.polyfit(x, y, 1)
    error = y - (intercept + slope * x)
    row = models.simple_regression(df, "x", "y").first()
    assert row["slope"] == pytest.approx(slope) and row["intercept"] == pytest.approx(intercept)
    assert row["mae"] == pytest.approx(np.abs(error).mean()) and row["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert row["r2"] == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum())


def test_one_hot_missing_value(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "z string")
    rows = sorted(tuple(r) for r in features.one_hot(df, "z", ["a", "b"])[0].collect())
    assert rows == [(0, 0), (0, 0), (0, 1), (1, 0)]


@pytest.mark.parametrize("drop_first", [False, True])
def test_one_hot_vectors_of_many_values(spark, drop_first):
    values = sorted(f"v{i:05}" for i in range(5000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(5000, None), (5001, "v00007")], "id int, z string")
    made = features.one_hot_vectors(df, "z", "vector", drop_first=drop_first).collect()
    assert len(made) == 5002
    for r in made:
        place = None if r.z is None else values.index(r.z) - drop_first
        assert r.vector.size == 5000 - drop_first
        assert r.vector.indices.tolist() == ([] if place is None or place < 0 else [place])
    held = features.dictionary(df, "z")
    assert [tuple(r) for r in held.orderBy("place").limit(2).collect()] == [("v00000", 0), ("v00001", 1)]
    other = spark.createDataFrame([("unknown",)], "z string")
    assert features.one_hot_vectors(other, "z", "vector", held).first().vector.numNonzeros() == 0
    empty = features.one_hot_vectors(df.where("false"), "z", "vector")
    assert empty.count() == 0


def test_collinear_columns_are_named_and_left_out(spark):
    df, x, z, y = sample(spark)
    coded, columns = features.one_hot(df, "z", ["u", "v", "w"])
    coded = coded.selectExpr("*", "3 * x - 1 AS twice", "1.0 AS one", "x + z_v AS sum")
    names = ["x", *columns, "twice", "one", "sum"]
    assert models.independent_columns(coded, names) == (["x", "z_u", "z_v"], ["z_w", "twice", "one", "sum"])
    found = models.fitted_table(coded, names, "y").collect()
    assert {r["feature"] for r in found if r["dropped"]} == {"z_w", "twice", "one", "sum"}
    assert all(r["std_error"] > 0 for r in found if not r["dropped"])
    # large means do not hide what is left of a column's variance
    shifted = coded.selectExpr("x + 1e6 AS a", "x + 1e6 + z_u * 1e-3 AS b", "y")
    assert models.independent_columns(shifted, ["a", "b"])[1] == []


def test_standardise_uses_train_figures(spark):
    train = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 9.0)], "a double, b double")
    scaled = features.standardise(test, ["a", "b"], features.scaling(train, ["a", "b"])).first()
    assert (scaled["a"], scaled["b"]) == (3.0, 0.0)


def test_random_split_is_stable_and_complete(spark):
    df = spark.range(5000)
    train, test = features.split_random(df, "id")
    again = features.split_random(df.repartition(13), "id")[1]
    assert train.count() + test.count() == 5000 and train.intersect(test).count() == 0
    assert test.exceptAll(again).count() == 0 and 850 < test.count() < 1150


def test_ordered_split_holds_out_the_last_groups(spark):
    rows = [(g, d) for g in "abc" for d in range(1, 6)]
    train, test = features.split_ordered(spark.createDataFrame(rows, "g string, d int"), "g", "d")
    assert sorted(map(tuple, test.collect())) == [("c", 3), ("c", 4), ("c", 5)] and train.count() == 12


def test_split_by_time(spark):
    df = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-10')) AS d")
    train, test = features.split_by_time(df, "d", "2024-01-08")
    assert (train.count(), test.count()) == (7, 3)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10, 10)], "v double")
    rows = features.histogram(df, "v", 5).orderBy("bin").collect()
    expected, edges = np.histogram([0, 1, 2, 9, 10, 10], bins=5)
    assert [r["rows"] for r in rows] == list(expected) and rows[0]["low"] == edges[0] and rows[-1]["high"] == edges[-1]


def test_lags(spark):
    rows = [("a", dt.date(2024, m, 1), float(v)) for m, v in zip(range(1, 6), (10, 20, 0, 30, 60))]
    df = spark.createDataFrame(rows, "c string, d date, v double")
    leaky = features.lag_features(df, "c", "d", "v", leak_free=False).orderBy("d").collect()
    assert [r["moyenne_mobile_3m"] for r in leaky] == [None, None, 10.0, 50 / 3, 30.0]
    assert [r["variation_pourcent"] for r in leaky] == [None, 1.0, -1.0, None, 1.0]
    clean = features.lag_features(df, "c", "d", "v").orderBy("d").collect()
    assert [r["moyenne_mobile_3m"] for r in clean] == [None, None, None, 10.0, 50 / 3]
    assert [r["variation_pourcent"] for r in clean] == [None, None, 1.0, -1.0, None]


def test_forecast_follows_its_own_predictions(spark):
    """A category with a gap before the start is not predicted; the others feed on their predictions."""
    rows = []
    for month in range(1, 25):
        rows.append((2023 + (month - 1) // 12, (month - 1) % 12 + 1, "x", 100.0 + month))
        if month < 24:
            rows.append((2023 + (month - 1) // 12, (month - 1) % 12 + 1, "gap", 50.0 + month % 3))
    monthly = spark.createDataFrame(rows, "annee bigint, mois bigint, categorie string, ca_ventes double")
    model = forecast.fit_forecaster(forecast.training_table(monthly), trees=3, depth=2)
    result = forecast.forecast(monthly, model, start="2025-01-01", months=3)
    found = result.orderBy("date").collect()
    assert [(r["categorie"], r["annee"], r["mois"]) for r in found] == [("x", 2025, m) for m in (1, 2, 3)]

    # The second month again, from the known values and the first prediction.
    first, second = found[0]["ca_ventes"], found[1]["ca_ventes"]
    row = {
        "annee": 2025.0,
        "mois": 2.0,
        "ca_ventes_prec": first,
        "ca_ventes_prec_2": 124.0,
        "moyenne_mobile_3m": (123.0 + 124.0 + first) / 3,
        "variation_pourcent": (first - 124.0) / 124.0,
        "gap": 0.0,
        "x": 1.0,
        "unknown": 0.0,
    }
    from pyspark.ml.linalg import Vectors

    assert model.stages[0].labels == ["gap", "x"]
    assert model.stages[-1].predict(Vectors.dense(list(row.values()))) == pytest.approx(second)
    assert model.transform(forecast.training_table(monthly).withColumn("categorie", F.lit("new"))).count() > 0


def test_full_grid_boosts_on_cells_as_on_rows(spark):
    """Trees on cells equal trees on rows: depth 1, one tree, against the best cut found by hand."""
    rng = np.random.default_rng(2)
    rows = [(str(i), float(a), float(b), float(3.0 * (a > 4) + 0.5 * b + rng.normal(0, 0.1))) for i, (a, b) in enumerate(rng.integers(0, 9, (400, 2)))]
    train = spark.createDataFrame(rows, "k string, a double, b double, y double")
    held = cells(train, ("a", "b"), "y", "k", folds=2).toPandas()
    assert held["n"].sum() == 400 and held["y"].sum() == pytest.approx(sum(r[3] for r in rows))
    one = held.groupby(["b0", "b1"])[["n", "y", "yy"]].sum().reset_index()
    grids = [one.pivot(index="b0", columns="b1", values=c).fillna(0).to_numpy(float) for c in ("n", "y", "yy")]
    score = boosted_scores(grids[0], grids[1], (grids[0], grids[1], grids[2].sum()), 1, 1.0, (1,))[0]
    y = np.array([r[3] for r in rows])
    best = 0.0
    for column in (1, 2):
        x = np.array([r[column] for r in rows])
        for cut in sorted(set(x))[:-1]:
            fitted = np.where(x <= cut, y[x <= cut].mean(), y[x > cut].mean())
            best = max(best, 1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert score == pytest.approx(best)
    points = full_grid(train, ("a", "b"), "y", "k", trees=(5, 20), folds=2).collect()
    assert len(points) == 3 * 2 * 3 and max(r["r2"] for r in points) > 0.9


def test_value_counts_and_describe(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (4,)], "v int")
    assert {tuple(r) for r in features.value_counts(df, "v").collect()} == {(1, 2), (4, 1)}
    row = features.describe(df, ["v"]).first()
    assert (row["present"], row["missing"], row["mean"], row["min"], row["max"]) == (3.0, 1.0, 2.0, 1.0, 4.0)


def test_trees_learn_and_rank_features(spark):
    df, *_ = sample(spark)
    table = models.feature_table(df.withColumn("noise", F.rand(1)), ["x", "noise"], "y")
    forest = models.random_forest(table, "y", trees=5, depth=4)
    importance = {r["feature"]: r["importance"] for r in models.importance_table(forest, ["x", "noise"], table).collect()}
    assert importance["x"] > 0.8
    assert models.regression_metrics(models.boosted_trees(table, "y", trees=5).transform(table), "y").first()["r2"] > 0.5
    fitted = models.grid_search(table, "y", depths=(1, 2), trees=(2,), rates=(0.1,), folds=2)
    assert models.grid_table(fitted, table).count() == 2


def test_boosted_trees_learn_from_cells_as_from_rows(spark):
    from pyspark.ml.regression import GBTRegressor

    rows = spark.range(3000).selectExpr("CAST(id % 17 AS DOUBLE) a", "CAST(id * id % 5 AS DOUBLE) b", "CAST(id * 7 % 101 + id % 17 * 9 AS DOUBLE) y")
    table = models.feature_table(rows, ["a", "b"], "y")
    cells = models.training_cells(table, "y")
    assert cells.count() == rows.select("a", "b").distinct().count() < 100
    assert cells.agg({models.WEIGHT: "sum"}).first()[0] == 3000
    plain = GBTRegressor(featuresCol=models.FEATURES, labelCol="y", maxDepth=3, maxIter=5, stepSize=0.05, seed=42).fit(table)
    made = models.boosted_trees(table, "y", trees=5)
    wanted, got = (models.regression_metrics(m.transform(table), "y").first() for m in (plain, made))
    assert [round(x, 9) for x in got] == [round(x, 9) for x in wanted] and got["r2"] > 0.1


def test_forest_learns_from_cells_as_spark_from_rows(spark):
    from pyspark.ml.regression import RandomForestRegressor

    rows = spark.range(4000).selectExpr(
        "CAST(id * 7919 % 1000 AS DOUBLE) a", "CAST(id % 3 AS DOUBLE) b", "CAST(id % 400 = 0 AS DOUBLE) c",
        "CAST(floor(id * 7919 % 1000 / 250) + (id % 3) * (id % 2) + 5 * CAST(id % 400 = 0 AS INT) AS DOUBLE) y",
    )
    table = models.feature_table(rows, ["a", "b", "c"], "y")
    made = models.random_forest(table, "y", trees=30, depth=6)
    plain = RandomForestRegressor(
        featuresCol=models.FEATURES, labelCol="y", numTrees=30, maxDepth=6, featureSubsetStrategy="all", seed=42
    ).fit(table)
    got, wanted = made.transform(table), plain.transform(table)
    assert got.columns == wanted.columns and got.count() == 4000
    got, wanted = (models.regression_metrics(x, "y").first() for x in (got, wanted))
    assert got["r2"] > 0.5 and tuple(got) == pytest.approx(tuple(wanted), rel=0.03)
    assert made.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=0.02)
    # a rare value keeps its cut, a wide feature has as many bins as Spark's learner gives it
    assert [len(c) for c in made.cuts] == [31, 2, 1]
    again = models.random_forest(table.repartition(7), "y", trees=3, depth=6)
    first = models.random_forest(table, "y", trees=3, depth=6)
    assert again.cuts == first.cuts and again.featureImportances.toArray() == pytest.approx(first.featureImportances.toArray())


def test_draws_of_a_forest_are_a_bootstrap_of_rows(spark):
    rows = spark.range(200_000).selectExpr("CAST(id % 4 AS DOUBLE) a", "CAST(id % 3 AS DOUBLE) y")
    table = models.feature_table(rows, ["a"], "y")
    cells = models.binned(table, [[0.5, 1.5, 2.5]]).groupBy("_bin_0", F.col("y").alias("_target")).agg(F.count("y").alias("_rows"))
    held = models.drawn_cells(cells, 200, 42).toPandas()
    draws = held.filter(like="_draws_").to_numpy()
    assert held.shape == (12, 202)  # twelve cells for any number of rows
    # Poisson numbers: mean and variance are the rows of a cell
    n = 200_000 / 12
    assert draws.mean() == pytest.approx(n, rel=0.005) and draws.var() == pytest.approx(n, rel=0.15)
    assert draws.sum(axis=0).var() == pytest.approx(200_000, rel=0.5)


def test_forest_without_rows_or_with_one(spark):
    table = models.feature_table(spark.createDataFrame([(1.0, 2.0)], "a double, y double"), ["a"], "y")
    one = models.random_forest(table, "y", trees=20, depth=2)
    assert 0 < len(one.trees) < 20 and one.transform(table).first()["prediction"] == 2.0
    assert one.featureImportances.toArray().tolist() == [0.0]
    with pytest.raises(ValueError, match="no rows"):
        models.random_forest(table.where("a > 1"), "y")
