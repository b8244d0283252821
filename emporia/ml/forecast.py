"""Monthly revenue per category and its recursive forecast."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.semantics import cents, from_cents
from emporia.ml.features import lag_features
from emporia.ml.models import FEATURES, training_rows
from emporia.plans.sales import PAID, not_cancelled
from emporia.sources.shared import written

CATEGORY, DAY, REVENUE = "categorie", "date", "ca_ventes"
LAGS = [f"{REVENUE}_prec", f"{REVENUE}_prec_2", "moyenne_mobile_3m", "variation_pourcent"]


def monthly_revenue(fact: DataFrame, products: DataFrame, days: DataFrame) -> DataFrame:
    """Paid amount per calendar month and category, for order days that the date dimension knows.

    Orders are reduced to one row per day and product before anything is joined.
    """
    daily = (
        not_cancelled(fact)
        .where(F.col("id_produit").isNotNull())
        .groupBy(F.col("date_commande").alias("date_jour"), "id_produit")
        .agg(F.sum(cents(F.col(PAID))).alias("_cents"))
    )
    named = daily.join(products.select("id_produit", CATEGORY), "id_produit")
    per_day = named.groupBy("date_jour", CATEGORY).agg(F.sum("_cents").alias("_cents"))
    return (
        per_day.join(days.select("date_jour", "annee", "mois"), "date_jour")
        .groupBy("annee", "mois", CATEGORY)
        .agg(from_cents(F.sum("_cents")).alias(REVENUE))
    )


def with_month(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn(DAY, F.make_date("annee", "mois", F.lit(1)))


def training_table(monthly: DataFrame, *, leak_free: bool = True) -> DataFrame:
    """Months with complete lag features."""
    return lag_features(with_month(monthly), CATEGORY, DAY, REVENUE, leak_free=leak_free).dropna()


def fit_forecaster(table: DataFrame, *, trees: int = 100, depth: int = 6, rate: float = 0.1) -> PipelineModel:
    """Boosted trees on year, month, lags and the category, one position of a sparse vector per category.

    ``table`` comes from :func:`training_table`. Any number of categories is fine; one that was not there in
    training has all positions of the known ones empty.
    """
    numbers = ["annee", "mois", *LAGS]
    steps = [
        StringIndexer(inputCol=CATEGORY, outputCol="_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=["_index"], outputCols=["_category"], dropLast=False),
        VectorAssembler(inputCols=[*numbers, "_category"], outputCol=FEATURES),
    ]
    encoder = Pipeline(stages=steps).fit(typed := table.withColumns({c: F.col(c).cast("double") for c in [*numbers, REVENUE]}))
    rows = training_rows(encoder.transform(typed), REVENUE)
    learner = GBTRegressor(featuresCol=FEATURES, labelCol=REVENUE, maxDepth=depth, maxIter=trees, stepSize=rate, seed=42)
    return PipelineModel([*encoder.stages, learner.fit(rows)])


def _value_at(month: Column) -> Column:
    """Revenue of a month among the recent ones, NULL when it is not there."""
    return F.get(F.filter("_recent", lambda r: r[DAY] == month), 0)[REVENUE]


def forecast(monthly: DataFrame, model: PipelineModel, *, start: str, months: int = 12) -> DataFrame:
    """Predict month after month from known and already predicted months.

    The state is one row per category with its last three months, so a step neither shuffles nor touches the
    history; each step is written, which keeps the plan of every step the same size. A category without the
    two months before a month is not predicted for it.
    """
    dated = with_month(monthly).where(F.col(DAY) < F.to_date(F.lit(start)))
    known = F.array_sort(F.collect_list(F.struct(DAY, REVENUE)))  # bounded by the months of the calendar
    latest = F.slice(known, -F.least(F.size(known), F.lit(3)), 3)
    state = written(dated.groupBy(CATEGORY).agg(latest.alias("_recent")), "recent")
    steps = []
    for step in range(months):
        month = F.add_months(F.to_date(F.lit(start)), step)
        last, previous = _value_at(F.add_months(month, -1)), _value_at(F.add_months(month, -2))
        mean = F.aggregate("_recent", F.lit(0.0), lambda s, r: s + r[REVENUE]) / F.size("_recent")
        ready = state.withColumns(
            {
                "annee": F.year(month).cast("bigint"),
                "mois": F.month(month).cast("bigint"),
                LAGS[0]: last,
                LAGS[1]: previous,
                "moyenne_mobile_3m": mean,
                "variation_pourcent": F.coalesce(F.try_divide(last - previous, previous), F.lit(0.0)),
            }
        )
        complete = F.col(LAGS[0]).isNotNull() & F.col(LAGS[1]).isNotNull()
        filled = ready.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in LAGS[:2]} | {"_ok": complete})
        predicted = model.transform(filled).withColumn(
            "_value", F.when(F.col("_ok"), F.col("prediction"))
        )
        longer = F.concat("_recent", F.array(F.struct(month.alias(DAY), F.col("_value").alias(REVENUE))))
        extended = F.slice(longer, -F.least(F.size(longer), F.lit(3)), 3)
        state = written(
            predicted.select(
                CATEGORY,
                F.when(F.col("_ok"), extended).otherwise(F.col("_recent")).alias("_recent"),
                "annee",
                "mois",
                month.alias(DAY),
                F.col("_value").alias(REVENUE),
            ),
            "recent",
        )
        steps.append(state.where(F.col(REVENUE).isNotNull()).select("annee", "mois", CATEGORY, DAY, REVENUE))
        state = state.select(CATEGORY, "_recent")
    result = steps[0]
    for more in steps[1:]:
        result = result.unionByName(more)
    return result
