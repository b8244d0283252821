"""Queries for the feature, profile and regression jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.ml import features, forecast, models
from emporia.ml.grid import full_grid
from emporia.sources.shared import written
from workload.oracle import COMMENTS, MODEL_SQL, near, total
from workload.registry import Data, query

BREAKDOWNS = ["temps_arret_panne", "nb_pannes_machines"]
VOLUME = "volume_traite"
COMPLAINTS = ["Delivery", "Price", "Product"]  # fixed values, in the order of their dummies
_MACHINES = """(SELECT CAST(coalesce(sum(temps_arret) FILTER (etat_machine = 'En panne'), 0) AS BIGINT) AS temps_arret_panne,
    count(*) FILTER (etat_machine = 'En panne') AS nb_pannes_machines, CAST(sum(volume_traite) AS BIGINT) AS volume_traite
    FROM mrt_fct_machines GROUP BY id_machine, id_entrepot, type_machine, annee_mois)"""


def _rounded(df, *names: str, digits: int = 6):
    return df.withColumns({n: F.round(F.col(n).cast("decimal(28,10)"), digits).cast("double") for n in names})


def _correlation_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {near(f'corr({a}, {b})', 6)} AS r FROM {source}" for a in columns for b in columns
    )


_MONTHLY = [
    "volumes_mentions_neutres", "volumes_mentions_positives", "volumes_mentions_negatives", "volume_commandes_total",
    "volume_mentions_total", "note_moyenne",
]


@query("ml_correlation_matrix", _correlation_sql([*BREAKDOWNS, VOLUME], _MACHINES))
def correlations(data: Data):
    frame = data("impacts_pannes_machines_par_mois")
    return _rounded(features.correlation_matrix(frame, [*BREAKDOWNS, VOLUME]), "r")


_MENTIONS_SQL = f"WITH par_mois AS ({MODEL_SQL['impacts_reseaux_sur_business']}) " + _correlation_sql(_MONTHLY, "par_mois")


@query("ml_correlation_mentions", _MENTIONS_SQL)
def correlations_of_months(data: Data):
    """Mentions against orders and notes by month."""
    return _rounded(features.correlation_matrix(data("impacts_reseaux_sur_business"), _MONTHLY), "r")


_NOTED = """(SELECT CAST(note_client AS DOUBLE) AS y, CAST(delai AS DOUBLE) AS x
    FROM delais JOIN mrt_fct_satisfaction USING (id_commande) WHERE note_client IS NOT NULL AND delai IS NOT NULL)"""


@query(
    "ml_simple_regression",
    f"""WITH l AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {_NOTED}),
        e AS (SELECT y, a, b, y - (a + b * x) AS e FROM {_NOTED}, l)
        SELECT {near('any_value(a)', 6)} AS intercept, {near('any_value(b)', 6)} AS slope, {near('avg(abs(e))', 6)} AS mae,
            {near('sqrt(avg(e * e))', 6)} AS rmse, {near('1 - sum(e * e) / (var_pop(y) * count(y))', 6)} AS r2,
            count(*) AS rows FROM e""",
)
def simple(data: Data):
    fitted = models.simple_regression(data("performance_retard_satisfaction"), "delai_commande", "note_client")
    return _rounded(fitted, "intercept", "slope", "mae", "rmse", "r2")


_X1, _X2 = BREAKDOWNS
_TWO_SQL = f"""WITH m AS (SELECT avg({_X1}) AS m1, avg({_X2}) AS m2, avg({VOLUME}) AS my, var_pop({_X1}) AS v1,
        var_pop({_X2}) AS v2, covar_pop({_X1}, {_X2}) AS c12, covar_pop({_X1}, {VOLUME}) AS c1,
        covar_pop({_X2}, {VOLUME}) AS c2 FROM {_MACHINES}),
    b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2
          FROM m)
    SELECT '{_X1}' AS feature, {near('b1', 4)} AS coefficient FROM b
    UNION ALL SELECT '{_X2}', {near('b2', 4)} FROM b
    UNION ALL SELECT 'const', {near('my - b1 * m1 - b2 * m2', 4)} FROM b"""


@query("ml_two_feature_regression", _TWO_SQL)
def two_features(data: Data):
    """Multiple regression through the ML estimator, against its normal equations."""
    table = models.feature_table(data("impacts_pannes_machines_par_mois"), BREAKDOWNS, VOLUME)
    fitted = models.coefficient_table(models.linear_model(table, VOLUME), BREAKDOWNS, table)
    return _rounded(fitted, "coefficient", digits=4).select("feature", "coefficient")


def _satisfaction(data: Data):
    """Numeric feature table of the satisfaction study: flags as 0/1, the amount cut to whole units."""
    base = data("performance_retard_satisfaction").select(
        "id_commande", "note_client", "delai_commande", "montant_commande_apres_promotion", "retard_livraison",
        "plainte", "type_plainte",
    )
    coded, columns = features.one_hot(base, "type_plainte", COMPLAINTS, drop_first=True)
    names = ["delai_commande", "montant_commande_apres_promotion", "retard_livraison", "plainte", *columns]
    whole = coded.dropna(subset=["note_client", *names]).withColumns({c: F.col(c).cast("int") for c in names})
    # written, because the rank check, the fit and its summary read it
    return written(whole, "satisfaction"), names


_STUDY = ["delai", "montant", "retard", "plainte", "prix", "produit", "livraison"]
_STUDY_ROWS = f"""(SELECT * FROM (SELECT CAST(note_client AS DOUBLE) AS y, CAST(delai_commande AS DOUBLE) AS delai,
    CAST(trunc(montant_commande_apres_promotion) AS DOUBLE) AS montant, CAST(CAST(retard_livraison AS INT) AS DOUBLE) AS retard,
    CAST(CAST(plainte AS INT) AS DOUBLE) AS plainte, CASE WHEN type_plainte = 'Price' THEN 1.0 ELSE 0.0 END AS prix,
    CASE WHEN type_plainte = 'Product' THEN 1.0 ELSE 0.0 END AS produit,
    CASE WHEN type_plainte = 'Delivery' THEN 1.0 ELSE 0.0 END AS livraison
    FROM ({MODEL_SQL['performance_retard_satisfaction']}))
    WHERE y IS NOT NULL AND delai IS NOT NULL AND montant IS NOT NULL AND retard IS NOT NULL AND plainte IS NOT NULL)"""


def _normal_equations(names: list[str], features_: list[str]) -> str:
    """Coefficients and standard errors from the centred cross products, eliminated step by step beside the unit matrix."""
    n = len(names)
    cross = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})::DOUBLE" for b in names) + "]" for a in names)
    unit = ", ".join("[" + ", ".join("1.0::DOUBLE" if i == j else "0.0::DOUBLE" for j in range(n)) + "]" for i in range(n))
    own = ", ".join(f"covar_pop({a}, y)::DOUBLE" for a in names)
    means = ", ".join(f"avg({a})::DOUBLE" for a in names)
    listed = ", ".join(f"'{f}'" for f in features_)
    return f"""WITH RECURSIVE held AS (SELECT * FROM {_STUDY_ROWS}),
        made AS (SELECT [{cross}] AS c, [{unit}] AS u, [{own}] AS o, [{means}] AS m, avg(y)::DOUBLE AS my, var_pop(y)::DOUBLE AS vy,
            count(*) AS rows FROM held),
        steps AS (
            SELECT 1 AS k, list_transform(list_zip(c, u), lambda r: list_concat(r[1], r[2])) AS a FROM made
            UNION ALL SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / a[k][k])
                ELSE list_transform(list_zip(r, a[k]), lambda p: p[1] - p[2] * r[k] / a[k][k]) END) FROM steps WHERE k <= {n}),
        inverse AS (SELECT list_transform(a, lambda r: r[{n + 1}:{2 * n}]) AS v FROM steps WHERE k = {n + 1}),
        fit AS (SELECT *, list_transform(v, lambda r: list_dot_product(r, o)) AS b FROM inverse, made),
        told AS (SELECT *, (vy - list_dot_product(b, o)) * rows / (rows - {n + 1}) AS s2 FROM fit)
        SELECT feature, {near('coefficient', 4)} AS coefficient, {near('std_error', 4)} AS std_error FROM (
            SELECT unnest([{listed}]) AS feature, unnest(b) AS coefficient,
                unnest(list_transform(v, lambda r, i: sqrt(r[i] * s2 / rows))) AS std_error FROM told
            UNION ALL SELECT 'const', my - list_dot_product(b, m),
                sqrt(s2 / rows * (1 + list_dot_product(m, list_transform(v, lambda r: list_dot_product(r, m))))) FROM told)"""


_FIT_SQL = f"""WITH l AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, avg(x) AS mx,
        count(*) AS n FROM {_NOTED}),
    s AS (SELECT any_value(a) AS a, any_value(b) AS b, any_value(sxx) AS sxx, any_value(mx) AS mx, any_value(n) AS n,
        sum((y - a - b * x) * (y - a - b * x)) / (any_value(n) - 2) AS s2 FROM {_NOTED}, l)
    SELECT 'delai_commande' AS feature, {near('b', 5)} AS coefficient, {near('sqrt(s2 / sxx)', 5)} AS std_error FROM s
    UNION ALL SELECT 'const', {near('a', 5)}, {near('sqrt(s2 * (1.0 / n + mx * mx / sxx))', 5)} FROM s"""


@query("ml_linear_regression_fit", _FIT_SQL)
def simple_fit(data: Data):
    """The simple regression through the ML estimator."""
    table = models.feature_table(data("performance_retard_satisfaction"), ["delai_commande"], "note_client")
    fitted = models.linear_model(table, "note_client")
    return _rounded(models.coefficient_table(fitted, ["delai_commande"], table), "coefficient", "std_error", digits=5)


_STUDY_FEATURES = [
    "delai_commande", "montant_commande_apres_promotion", "retard_livraison", "plainte", "type_plainte_Price",
    "type_plainte_Product",
]


@query("ml_multiple_regression", f"SELECT * FROM ({_normal_equations(_STUDY[:6], _STUDY_FEATURES)})")
def multiple(data: Data):
    """Coefficients and standard errors of the satisfaction study."""
    whole, names = _satisfaction(data)
    fitted = models.fitted_table(whole, names, "note_client").where("NOT dropped").drop("dropped")
    return _rounded(fitted, "coefficient", "std_error", digits=4)


@query(
    "ml_multiple_regression_collinear",
    f"""SELECT *, false AS dropped FROM ({_normal_equations(_STUDY[:6], _STUDY_FEATURES)})
        UNION ALL SELECT unnest(['type_plainte_Delivery', 'deux_delais']), NULL, NULL, true""",
)
def multiple_collinear(data: Data):
    """The study with all dummies, which add up to the complaint flag, and with the delay twice: both are named and left out."""
    whole, names = _satisfaction(data)
    whole = whole.withColumns(
        {
            "type_plainte_Delivery": F.col("plainte") - F.col("type_plainte_Price") - F.col("type_plainte_Product"),
            "deux_delais": F.col("delai_commande") * 2 + 1,
        }
    )
    fitted = models.fitted_table(whole, [*names, "type_plainte_Delivery", "deux_delais"], "note_client")
    return _rounded(fitted, "coefficient", "std_error", digits=4)


@query(
    "ml_multiple_regression_metrics",
    f"""WITH b AS (SELECT map_from_entries(list(ROW(feature, coefficient))) AS b FROM ({_normal_equations(_STUDY[:6], _STUDY_FEATURES).replace(', 4)', ', 12)')})),
        e AS (SELECT y, y - b['const'] - {" - ".join(f"b['{f}'] * {c}" for f, c in zip(_STUDY_FEATURES, _STUDY))} AS e FROM {_STUDY_ROWS}, b)
        SELECT {near('avg(abs(e))', 4)} AS mae, {near('sqrt(avg(e * e))', 4)} AS rmse,
            {near('1 - sum(e * e) / (var_pop(y) * count(y))', 4)} AS r2, count(y) AS rows FROM e""",
)
def multiple_metrics(data: Data):
    whole, names = _satisfaction(data)
    model, _, table, _ = models.least_squares(whole, names, "note_client")
    return _rounded(models.regression_metrics(model.transform(table), "note_client"), "mae", "rmse", "r2", digits=4)


@query(
    "ml_one_hot_vectors",
    """WITH d AS (SELECT l_partkey AS valeur, row_number() OVER (ORDER BY l_partkey) - 1 AS place
          FROM (SELECT DISTINCT l_partkey FROM lineitem)), t AS (SELECT count(*) AS taille FROM d)
        SELECT l_orderkey, l_linenumber, CAST(taille - 1 AS INT) AS taille, CASE WHEN place > 0 THEN CAST(place - 1 AS INT) END AS place
        FROM lineitem JOIN d ON l_partkey = valeur, t""",
)
def encoded_products(data: Data):
    """Every product of the order lines as a sparse vector with a place for each product but the first."""
    lines = data.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    coded = features.one_hot_vectors(lines, "l_partkey", "vecteur", drop_first=True)
    told = F.from_json(F.to_json(F.struct("vecteur")), "vecteur struct<size int, indices array<int>, values array<double>>")
    parts = coded.select("l_orderkey", "l_linenumber", told["vecteur"].alias("v"))
    return parts.select("l_orderkey", "l_linenumber", F.col("v.size").alias("taille"), F.get("v.indices", F.lit(0)).alias("place"))


@query(
    "ml_one_hot",
    """SELECT id_satisfaction, CASE WHEN type_plainte = 'Price' THEN 1 ELSE 0 END AS "type_plainte_Price",
       CASE WHEN type_plainte = 'Product' THEN 1 ELSE 0 END AS "type_plainte_Product" FROM stg_satisfaction""",
)
def encoded(data: Data):
    reviews = data("stg_satisfaction").select("id_satisfaction", "type_plainte")
    return features.one_hot(reviews, "type_plainte", COMPLAINTS, drop_first=True)[0]


@query(
    "ml_standardise",
    "SELECT " + ", ".join(
        near(f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0)", 6) + f" AS {c}" for c in BREAKDOWNS
    ) + f" FROM {_MACHINES}",
)
def scaled(data: Data):
    table = data("impacts_pannes_machines_par_mois").select(*BREAKDOWNS)
    return _rounded(features.standardise(table, BREAKDOWNS), *BREAKDOWNS)


@query(
    "ml_split_random",
    """SELECT id_commande, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(id_commande AS VARCHAR)), 1, 8) AS UBIGINT) % 10000
       < 2000 THEN 'test' ELSE 'train' END AS part FROM stg_commandes""",
)
def random_split(data: Data):
    """Rows of the hash split: every order is in exactly one part."""
    train, test = features.split_random(data("stg_commandes"), "id_commande")
    return train.select("id_commande", F.lit("train").alias("part")).unionByName(
        test.select("id_commande", F.lit("test").alias("part"))
    )


_MONTHS = f"""(SELECT d.annee, d.mois, p.categorie, {total('montant_commande_apres_promotion')} AS ca_ventes
    FROM ventes f JOIN mrt_dim_produits p USING (id_produit) JOIN mrt_dim_dates d ON d.date_jour = f.date_commande
    GROUP BY ALL)"""


def _monthly(data: Data):
    return forecast.monthly_revenue(data("mrt_fct_commandes"), data("mrt_dim_produits"), data("mrt_dim_dates"))


@query("ml_monthly_revenue", f"SELECT * FROM {_MONTHS}")
def monthly(data: Data):
    return _monthly(data)


@query(
    "ml_split_ordered",
    f"""SELECT categorie, annee, mois, CASE WHEN row_number() OVER (ORDER BY categorie, annee, mois) <= count(*) OVER ()
        - ceil(count(*) OVER () * 0.2) THEN 'train' ELSE 'test' END AS part FROM {_MONTHS}""",
)
def ordered_split(data: Data):
    table = written(forecast.with_month(_monthly(data)), "months")
    train, test = features.split_ordered(table, "categorie", "date")
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.select("categorie", "annee", "mois", "part")


_LAGS = f"""SELECT *, lag(ca_ventes) OVER w AS ca_ventes_prec, lag(ca_ventes, 2) OVER w AS ca_ventes_prec_2
    FROM (SELECT *, make_date(annee, mois, 1) AS date FROM {_MONTHS}) WINDOW w AS (PARTITION BY categorie ORDER BY date)"""


@query(
    "ml_lag_features",
    f"""SELECT categorie, date, ca_ventes, ca_ventes_prec, ca_ventes_prec_2,
        {near('CASE WHEN count(ca_ventes) OVER (w ROWS 2 PRECEDING) = 3 THEN avg(ca_ventes) OVER (w ROWS 2 PRECEDING) END', 4)}
            AS moyenne_mobile_3m, {near('ca_ventes / nullif(ca_ventes_prec, 0) - 1', 4)} AS variation_pourcent
        FROM ({_LAGS}) WINDOW w AS (PARTITION BY categorie ORDER BY date)""",
)
def lags(data: Data):
    """Lag, rolling mean and relative change that include the current month."""
    table = features.lag_features(forecast.with_month(_monthly(data)), "categorie", "date", "ca_ventes", leak_free=False)
    return _rounded(table, "moyenne_mobile_3m", "variation_pourcent", digits=4).select(
        "categorie", "date", "ca_ventes", "ca_ventes_prec", "ca_ventes_prec_2", "moyenne_mobile_3m", "variation_pourcent"
    )


_WINDOW = "PARTITION BY categorie ORDER BY date"


@query("window_lag", f"SELECT categorie, date, ca_ventes_prec, ca_ventes_prec_2 FROM ({_LAGS})")
def window_lag(data: Data):
    table = features.lag_features(forecast.with_month(_monthly(data)), "categorie", "date", "ca_ventes")
    return table.select("categorie", "date", "ca_ventes_prec", "ca_ventes_prec_2")


@query(
    "window_rolling_mean",
    f"""SELECT categorie, date, {near(f'''CASE WHEN count(ca_ventes) OVER ({_WINDOW} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
        THEN avg(ca_ventes) OVER ({_WINDOW} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END''', 4)} AS moyenne_mobile_3m
        FROM ({_LAGS})""",
)
def rolling_mean(data: Data):
    table = features.lag_features(forecast.with_month(_monthly(data)), "categorie", "date", "ca_ventes")
    return _rounded(table, "moyenne_mobile_3m", digits=4).select("categorie", "date", "moyenne_mobile_3m")


@query(
    "window_pct_change",
    f"SELECT categorie, date, {near('ca_ventes_prec / nullif(ca_ventes_prec_2, 0) - 1', 4)} AS variation_pourcent FROM ({_LAGS})",
)
def change(data: Data):
    table = features.lag_features(forecast.with_month(_monthly(data)), "categorie", "date", "ca_ventes")
    return _rounded(table, "variation_pourcent", digits=4).select("categorie", "date", "variation_pourcent")


@query("ml_drop_missing", "SELECT id_satisfaction, note_client, plainte FROM stg_satisfaction WHERE note_client IS NOT NULL AND plainte IS NOT NULL")
def complete(data: Data):
    return data("stg_satisfaction").select("id_satisfaction", "note_client", "plainte").dropna()


@query(
    "ml_histogram",
    f"""WITH v AS (SELECT CAST(volume_traite AS DOUBLE) AS v FROM {_MACHINES}),
        s AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
        c AS (SELECT CAST(least(floor((v - lo) / (hi - lo) * 50), 49) AS INT) AS bin, count(*) AS n FROM v, s GROUP BY ALL)
        SELECT CAST(b AS INT) AS bin, {near('lo + (hi - lo) / 50 * b', 6)} AS low, {near('lo + (hi - lo) / 50 * (b + 1)', 6)} AS high,
            ifnull(n, 0) AS rows FROM range(50) r(b) CROSS JOIN s LEFT JOIN c ON c.bin = b""",
)
def bins(data: Data):
    return _rounded(features.histogram(data("impacts_pannes_machines_par_mois"), VOLUME), "low", "high")


@query(
    "ml_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column, CAST(count({c}) AS DOUBLE) AS present, CAST(count(*) - count({c}) AS DOUBLE) AS missing,
            {near(f'avg({c})', 6)} AS mean, {near(f'stddev_samp({c})', 6)} AS std, CAST(min({c}) AS DOUBLE) AS min,
            CAST(max({c}) AS DOUBLE) AS max FROM stg_satisfaction"""
        for c in ("note_client", "temps_reponse_support")
    ),
)
def profile(data: Data):
    return _rounded(features.describe(data("stg_satisfaction"), ["note_client", "temps_reponse_support"]), "mean", "std")


@query("ml_value_counts", "SELECT note_client, count(*) AS rows FROM stg_satisfaction WHERE note_client IS NOT NULL GROUP BY ALL")
def counts(data: Data):
    return features.value_counts(data("stg_satisfaction"), "note_client")


@query(
    "ml_metrics",
    f"""WITH e AS (SELECT CAST(volume_traite AS DOUBLE) AS y, volume_traite - (SELECT avg(volume_traite) FROM {_MACHINES}) AS e
            FROM {_MACHINES})
        SELECT {near('avg(abs(e))', 6)} AS mae, {near('sqrt(avg(e * e))', 6)} AS rmse,
            {near('1 - sum(e * e) / (var_pop(y) * count(y))', 6)} AS r2, count(*) AS rows,
            (SELECT quantile_cont(volume_traite, 0.5) FROM {_MACHINES}) AS mediane FROM e""",
)
def metrics(data: Data):
    """Metrics of the constant prediction at the mean, with the median of the target."""
    from emporia.operators.ranking import interpolated_median

    table = written(data("impacts_pannes_machines_par_mois").select(VOLUME), "target")
    mean = table.agg(F.avg(VOLUME).alias("prediction"))
    scored = models.regression_metrics(table.crossJoin(F.broadcast(mean)), VOLUME)
    both = scored.crossJoin(F.broadcast(interpolated_median(table, VOLUME, "mediane", rows=table.count())))
    return _rounded(both, "mae", "rmse", "r2")


@query(
    "ml_keyword_frequency",
    f"SELECT sentiment, mots_cles, count(*) AS frequence FROM ({COMMENTS}) WHERE sentiment IN ('positif', 'negatif') GROUP BY ALL",
)
def keyword_frequency(data: Data):
    words = data("performance_commentaire").where(F.col("sentiment").isin("positif", "negatif"))
    return words.groupBy("sentiment", "mots_cles").agg(F.count(F.lit(1)).alias("frequence"))


@query("ml_keyword_totals", f"SELECT mots_cles, count(*) AS frequence FROM ({COMMENTS}) WHERE sentiment <> 'neutre' GROUP BY ALL")
def keyword_totals(data: Data):
    words = data("performance_commentaire").where(F.col("sentiment") != "neutre")
    return words.groupBy("mots_cles").agg(F.count(F.lit(1)).alias("frequence"))


def _machine_parts(data: Data):
    """Train and test rows of the breakdown study, scaled with the figures of the train rows."""
    table = data("impacts_pannes_machines_par_mois").select(
        F.concat_ws("|", "id_machine", "id_entrepot", "type_machine", "annee_mois").alias("_key"), *BREAKDOWNS, VOLUME
    )
    train, test = features.split_random(written(table, "machines"), "_key")
    stats = features.scaling(train, BREAKDOWNS)
    return tuple(
        models.feature_table(features.standardise(part, BREAKDOWNS, stats), BREAKDOWNS, VOLUME) for part in (train, test)
    )


@query("ml_breakdown_regression")
def breakdown_regression(data: Data):
    train, test = _machine_parts(data)
    return models.regression_metrics(models.linear_model(train, VOLUME).transform(test), VOLUME)


@query("ml_boosted_trees")
def boosted(data: Data):
    train, test = _machine_parts(data)
    return models.regression_metrics(models.boosted_trees(train, VOLUME).transform(test), VOLUME)


@query("ml_grid_search")
def grid(data: Data):
    """All 27 points of the grid (3 depths, 100 to 300 trees, 3 rates), each scored on 3 folds."""
    table = data("impacts_pannes_machines_par_mois").select(
        F.concat_ws("|", "id_machine", "id_entrepot", "type_machine", "annee_mois").alias("_key"), *BREAKDOWNS, VOLUME
    )
    train, _ = features.split_random(written(table, "machines"), "_key")
    return full_grid(train, tuple(BREAKDOWNS), VOLUME, "_key")


@query("ml_random_forest")
def forest(data: Data):
    """Metrics of the forest on the held-out orders."""
    whole, names = _satisfaction(data)
    train, test = features.split_random(whole, "id_commande")
    train, test = (models.feature_table(part, names, "note_client") for part in (train, test))
    return models.regression_metrics(models.random_forest(train, "note_client").transform(test), "note_client")


@query("ml_forest_importances")
def importances(data: Data):
    whole, names = _satisfaction(data)
    train, _ = features.split_random(whole, "id_commande")
    train = models.feature_table(train, names, "note_client")
    return models.importance_table(models.random_forest(train, "note_client"), names, train)


@query("ml_forecast")
def twelve_months(data: Data):
    """Twelve predicted months per category after the last month of the data."""
    months = written(_monthly(data), "months")
    last = forecast.with_month(months).agg(F.max("date")).first()[0]  # one value
    start = f"{last.year + last.month // 12}-{last.month % 12 + 1:02d}-01"
    return forecast.forecast(months, forecast.fit_forecaster(forecast.training_table(months)), start=start)


def _forecast_metrics(data: Data, leak_free: bool):
    """Metrics of the boosted trees on the last fifth of the rows in the order category, month."""
    table = written(forecast.training_table(_monthly(data), leak_free=leak_free), "training")
    train, test = features.split_ordered(table, forecast.CATEGORY, forecast.DAY)
    return models.regression_metrics(forecast.fit_forecaster(train).transform(test), forecast.REVENUE)


@query("ml_forecast_metrics")
def forecast_metrics(data: Data):
    return _forecast_metrics(data, True)


@query("ml_forecast_metrics_current_month")
def forecast_metrics_current_month(data: Data):
    """The same with mean and change that include the month itself, which the target is part of."""
    return _forecast_metrics(data, False)
