"""Customer feedback indicators: notes, comments and delivery delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions.semantics import keyword, note_sentiment
from emporia.operators.joins import lookup
from emporia.plans.logistics import delivery_days, with_late_flag
from emporia.plans.sales import PAID
from emporia.plans.warehouse import model
from emporia.sources.shared import written


def _commented(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("commentaire").isNotNull()).withColumn(
        "sentiment", note_sentiment(F.col("note_client"))
    )


@model("performance_commentaire", "mrt_fct_satisfaction")
def comments(reviews: DataFrame) -> DataFrame:
    word = keyword(F.col("commentaire"), labels.COMMENT_PHRASES, default=labels.COMMENT_DEFAULT)
    return _commented(reviews).select(
        "id_commande", "note_client", "commentaire", "sentiment", word.alias("mots_cles")
    )


@model("performance_mots_cles", "mrt_fct_satisfaction")
def keywords(reviews: DataFrame) -> DataFrame:
    """Keyword of each comment and how often the keyword occurs; no keyword has no frequency."""
    word = keyword(F.col("commentaire"), labels.COMMENT_SENTENCES, whole=True)
    by_note = F.lit(None).cast("string")
    for note, fallback in labels.NOTE_KEYWORDS.items():
        by_note = F.when(F.col("note_client") == note, fallback).otherwise(by_note)
    worded = _commented(reviews).select(
        "id_commande", "commentaire", "sentiment", F.coalesce(word, by_note).alias("mots_cles")
    )
    counts = (
        worded.where(F.col("mots_cles").isNotNull()).groupBy("mots_cles").agg(F.count(F.lit(1)).alias("frequence"))
    )
    return worded.join(F.broadcast(counts), "mots_cles", "left").select(  # one row per word of the fixed list
        "id_commande", "commentaire", "sentiment", "mots_cles", "frequence"
    )


@model("performance_notes_categorie", "mrt_fct_satisfaction", "mrt_fct_commandes", "mrt_dim_produits")
def notes_by_category(reviews: DataFrame, fact: DataFrame, products: DataFrame) -> DataFrame:
    """Mean note and number of reviews per product and month; products are named after the reduction."""
    noted = reviews.select("id_commande", "note_client").join(
        fact.where(F.col("id_produit").isNotNull()).select("id_commande", "id_produit", "date_commande"), "id_commande"
    )
    monthly = noted.groupBy("id_produit", dates.month_key(F.col("date_commande")).alias("mois_commande")).agg(
        F.avg("note_client").alias("note_moyenne"), F.count(F.lit(1)).alias("nb_avis")
    )
    return monthly.join(products.select("id_produit", "categorie"), "id_produit").select(
        "categorie", "id_produit", "mois_commande", "note_moyenne", "nb_avis"
    )


@model("performance_notes_produit", "mrt_fct_satisfaction", "mrt_fct_commandes", "mrt_dim_produits")
def notes_by_product(reviews: DataFrame, fact: DataFrame, products: DataFrame, more_than: int = 5) -> DataFrame:
    """Noted orders of the products with more than ``more_than`` notes."""
    noted = (
        reviews.where(F.col("note_client").isNotNull())
        .select("id_commande", "note_client")
        .join(
            fact.where(F.col("id_produit").isNotNull()).select(
                "id_commande", "date_commande", "date_livraison_estimee", "id_produit"
            ),
            "id_commande",
        )
    )
    noted = written(noted, "noted")  # read twice: to find the products and to list their orders
    often = noted.groupBy("id_produit").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than)
    # One right side, unique on the product: the frequent products with their names.
    named = often.select("id_produit").join(products.select("id_produit", "produit", "categorie"), "id_produit")
    return lookup(noted, named, "id_produit", "inner").select(
        "id_commande",
        "note_client",
        "date_commande",
        "date_livraison_estimee",
        dates.month_key(F.col("date_commande")).alias("mois_annee"),
        "id_produit",
        F.col("produit").alias("nom_produit"),
        "categorie",
    )


@model("performance_retard_satisfaction", "mrt_fct_commandes", "mrt_fct_satisfaction")
def delay_and_notes(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviewed orders with their delivery delay and whether it is above the median of all orders."""
    delayed = with_late_flag(fact).select(
        "id_commande",
        "date_commande",
        "date_livraison_estimee",
        dates.month_key(F.col("date_livraison_estimee")).alias("annee_mois"),
        delivery_days().alias("delai_commande"),
        PAID,
        "mediane",
        "retard_livraison",
    )
    return delayed.join(reviews.select("id_commande", "note_client", "plainte", "type_plainte"), "id_commande")
