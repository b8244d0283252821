"""Calendar indicators: peaks and dips by day and week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions.semantics import cents, from_cents, round_half_away
from emporia.operators.deviation import add_zscore, deviation_label
from emporia.plans.sales import PAID, not_cancelled
from emporia.plans.warehouse import model


@model("referentiel_dates", "mrt_dim_dates")
def date_reference(days: DataFrame) -> DataFrame:
    return days


@model("v_recurrence_pics_creux", "mrt_fct_commandes")
def daily_peaks(fact: DataFrame) -> DataFrame:
    """Orders per day against the same day of the month; the daily table is bounded by the calendar."""
    day = F.col("jour")
    daily = (
        not_cancelled(fact)
        .groupBy(F.col("date_commande").alias("jour"))
        .agg(F.count(F.lit(1)).alias("nb_commandes"))
        .where(day.isNotNull())
        .withColumn("jour_du_mois", F.dayofmonth(day).cast("bigint"))
    )
    medians = daily.groupBy("jour_du_mois").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY nb_commandes)").alias("mediane_commandes")
    )
    scored = add_zscore(daily, "nb_commandes", "jour_du_mois", "_score", mean="_mean", deviation="_spread")
    score = F.col("_score")
    return scored.join(F.broadcast(medians), "jour_du_mois").select(
        "jour",
        "jour_du_mois",
        dates.monday_weekday(day).cast("bigint").alias("jour_de_semaine"),
        dates.day_name(day, labels.DAYS_FR).alias("nom_jour_fr"),
        "nb_commandes",
        round_half_away(F.col("_mean"), 2).alias("moyenne_attendue"),
        F.col("mediane_commandes").cast("double").alias("mediane_commandes"),
        round_half_away(F.col("_spread"), 2).alias("ecart_type_jour"),
        round_half_away(score, 2).alias("z_score"),
        deviation_label(score, labels.PEAK, labels.DIP, labels.NORMAL).alias("statut"),
    )


def _two_scores(daily: DataFrame) -> DataFrame:
    """Scores of daily revenue within its month of the year and within its week day."""
    scored = add_zscore(daily, "ca_journalier", "mois", "z_score_mois")
    return add_zscore(scored, "ca_journalier", "jour_semaine", "z_score_jour")


def _is_peak():
    high = (F.col("z_score_mois") >= 1.5) | (F.col("z_score_jour") >= 1.5)
    return F.when(high, labels.PEAK).otherwise(labels.NORMAL)


@model("v_tendances_temporelles_lucratives", "mrt_fct_commandes")
def revenue_peaks(fact: DataFrame) -> DataFrame:
    day = F.col("jour")
    daily = (
        not_cancelled(fact)
        .groupBy(F.col("date_commande").alias("jour"))
        .agg(from_cents(F.sum(cents(F.col(PAID)))).alias("ca_journalier"))
        .where(day.isNotNull())
        .select(
            day,
            F.year(day).cast("bigint").alias("annee"),
            F.month(day).cast("bigint").alias("mois"),
            dates.sunday_week(day).cast("bigint").alias("semaine"),
            F.dayofweek(day).cast("bigint").alias("jour_semaine"),
            "ca_journalier",
        )
    )
    best_first = F.col("ca_journalier").desc_nulls_last()

    def rank_in(group: str):
        return F.rank().over(Window.partitionBy(group).orderBy(best_first)).cast("bigint")

    return _two_scores(daily).select(
        "jour",
        "annee",
        "mois",
        "semaine",
        "jour_semaine",
        "ca_journalier",
        round_half_away(F.col("z_score_mois"), 2).alias("z_score_mois"),
        round_half_away(F.col("z_score_jour"), 2).alias("z_score_jour"),
        rank_in("mois").alias("rang_dans_mois"),
        rank_in("jour_semaine").alias("rang_dans_jour"),
        _is_peak().alias("statut_lucratif"),
    )


@model("v_recurrence_pics_creux_semaines", "mrt_fct_commandes")
def weekly_peaks(fact: DataFrame) -> DataFrame:
    """ISO weeks with at least three peak days."""
    day = F.col("date_commande")
    daily = (
        not_cancelled(fact)
        .groupBy(
            dates.iso_year(day).cast("string").alias("annee"),
            dates.iso_week_text(day).alias("semaine"),
            dates.iso_week_label(day).alias("semaine_affichee"),
            F.month(day).cast("bigint").alias("mois"),
            F.dayofweek(day).cast("bigint").alias("jour_semaine"),
        )
        .agg(from_cents(F.sum(cents(F.col(PAID)))).alias("ca_journalier"))
    )
    peak_days = F.count_if(F.col("_status") == labels.PEAK)
    return (
        _two_scores(daily)
        .withColumn("_status", _is_peak())
        .groupBy("annee", "semaine", "semaine_affichee")
        .agg(
            from_cents(F.sum(cents(F.col("ca_journalier")))).alias("ca_total_semaine"),
            peak_days.alias("nb_jours_lucratifs"),
            F.when(peak_days >= 3, labels.RICH_WEEK).otherwise(labels.PLAIN_WEEK).alias("statut_lucratif_semaine"),
        )
    )
