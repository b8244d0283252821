"""Social media and campaign indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions.semantics import round_half_away
from emporia.operators.joins import following_days_count
from emporia.plans.warehouse import model

DAYS_AFTER = 7  # the post's own day and seven more


def _mentions_when(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("volume_mentions")).otherwise(F.lit(0).cast("bigint")))


def _sentiment_sums() -> list[Column]:
    return [
        _mentions_when(F.col("sentiment_global") == word).alias(f"volumes_mentions_{name}")
        for name, word in (
            ("neutres", labels.SENTIMENTS["neutres"]),
            ("positives", labels.SENTIMENTS["positives"]),
            ("negatives", labels.SENTIMENTS["negatives"]),
        )
    ]


def _days_with_orders(posts: DataFrame, fact: DataFrame, sums: list[Column], at_least: int) -> DataFrame:
    """Sums per post day with the orders of the day and the next seven.

    Both inputs are reduced to one row per day before they meet, so the joined tables are bounded by the
    calendar whatever the number of posts and orders. ``at_least`` is what a day without any order counts.
    """
    daily = posts.groupBy("date_post").agg(*sums)
    days = daily.select("date_post").where(F.col("date_post").isNotNull())
    counts = following_days_count(days, "date_post", fact, "date_commande", DAYS_AFTER, "_n")
    orders = F.coalesce(F.greatest(F.col("_n"), F.lit(at_least)), F.lit(0)).cast("bigint")
    orders = F.when(F.col("_n").isNull(), F.lit(0)).otherwise(orders).cast("bigint")
    return daily.join(counts, "date_post", "left").select(
        F.date_format("date_post", "yyyy-MM-dd").alias("date_poste"),
        *[c for c in daily.columns if c != "date_post"],
        orders.alias("commande_7_jours"),
    )


@model("impacts_par_reseau_sur_business_7jours", "mrt_fct_posts", "mrt_fct_commandes")
def orders_after_posts_by_channel(posts: DataFrame, fact: DataFrame) -> DataFrame:
    """Mentions per channel and orders after each post day; a post day without any order counts one."""
    sums = [F.sum("volume_mentions").alias("volume_mentions_total")]
    for channel in labels.CHANNELS:
        sums.append(_mentions_when(F.lower("canal_social") == channel).alias(f"nombre_{channel}"))
    return _days_with_orders(posts, fact, sums, at_least=1)


@model("impacts_reseaux_sur_business_par_jour", "mrt_fct_posts", "mrt_fct_commandes")
def orders_after_posts_by_sentiment(posts: DataFrame, fact: DataFrame) -> DataFrame:
    sums = [*_sentiment_sums(), F.sum("volume_mentions").alias("volume_mentions_total")]
    return _days_with_orders(posts, fact, sums, at_least=0)


@model("impacts_reseaux_sur_business", "mrt_fct_posts", "mrt_fct_commandes", "mrt_fct_satisfaction")
def mentions_and_orders_by_month(posts: DataFrame, fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mentions, orders and mean note per month with posts; all three sides are reduced to months first."""
    month = dates.month_key(F.col("date_commande")).alias("annee_mois_post")
    status = F.col("statut_commande")
    mentions = posts.groupBy(dates.month_key(F.col("date_post")).alias("annee_mois_post")).agg(
        *_sentiment_sums(), F.sum("volume_mentions").alias("volume_mentions_total")
    )
    orders = fact.groupBy(month).agg(
        F.count_if(status != labels.CANCELLED).alias("volume_commandes_viables"),
        F.count_if(status == labels.CANCELLED).alias("volume_commandes_annulees"),
        F.count(F.lit(1)).alias("volume_commandes_total"),
    )
    notes = (
        reviews.select("id_commande", "note_client")
        .join(fact.select("id_commande", "date_commande"), "id_commande")
        .groupBy(month)
        .agg(round_half_away(F.avg("note_client"), 2).alias("note_moyenne"))
    )
    return (
        mentions.join(orders, "annee_mois_post", "left")
        .join(notes, "annee_mois_post", "left")
        .select(
            "annee_mois_post",
            "volumes_mentions_neutres",
            "volumes_mentions_positives",
            "volumes_mentions_negatives",
            "volume_commandes_viables",
            "volume_commandes_annulees",
            "volume_commandes_total",
            "volume_mentions_total",
            "note_moyenne",
        )
    )


@model("performances_par_canal", "mrt_fct_campagnes")
def campaign_costs(campaigns: DataFrame) -> DataFrame:
    """Cost per click and per acquisition; a campaign without clicks or conversions is an error."""
    budget, clicks, buyers = F.sum("budget"), F.sum("clics"), F.sum("conversions")
    return campaigns.groupBy("id_campagne", "date", "canal").agg(
        budget.alias("budget"),
        clicks.alias("nombre_de_clics"),
        round_half_away(budget / clicks, 2).alias("cout_par_clic"),
        buyers.alias("nombre_acquisitions"),
        round_half_away(budget / buyers, 2).alias("cout_par_acquisition"),
    )
