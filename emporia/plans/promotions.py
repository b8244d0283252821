"""Promotion indicators: effect on the amount paid and sensitivity of the volume sold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.semantics import cents, from_cents, round_half_away, sum_exact
from emporia.operators.ranking import global_rank
from emporia.plans.sales import PAID, not_cancelled
from emporia.plans.warehouse import model
from emporia.sources.shared import written


@model("performances_des_promotions", "mrt_fct_commandes")
def promotion_orders(fact: DataFrame) -> DataFrame:
    return not_cancelled(fact).select(
        "id_commande",
        "date_commande",
        "statut_commande",
        "quantite",
        "prix_unitaire_avant_promotion",
        "montant_commande_avant_promotion",
        "id_promotion",
        "promotion_oui_non",
        "type_promotion",
        "valeur_promotion",
        PAID,
    )


@model("v_effets_promotions", "mrt_fct_commandes", "mrt_dim_produits")
def promotion_effect(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Catalogue amount against paid amount per product; orders without a product form one group."""
    offer = F.col("id_promotion")
    listed = F.coalesce("quantite", F.lit(0)) * F.coalesce("prix_unitaire_avant_promotion", F.lit(0.0))
    totals = not_cancelled(fact).groupBy("id_produit").agg(
        sum_exact(listed).cast("double").alias("montant_sans_promo"),
        from_cents(F.sum(F.coalesce(cents(F.col(PAID)), F.lit(0)))).alias("montant_reel"),
        F.count_if(offer.isNotNull()).alias("nb_commandes_avec_promo"),
        F.count_if(offer.isNull()).alias("nb_commandes_sans_promo"),
    )
    named = totals.join(products.select("id_produit", "produit", "categorie", "marque"), "id_produit", "left")
    promoted, plain = F.col("nb_commandes_avec_promo"), F.col("nb_commandes_sans_promo")
    paid, full = F.col("montant_reel"), F.col("montant_sans_promo")
    return named.select(
        "id_produit",
        "produit",
        "categorie",
        "marque",
        promoted,
        plain,
        (promoted + plain).alias("nb_commandes_totales"),
        round_half_away(F.try_divide(promoted, promoted + plain) * 100, 2).alias("part_commandes_promo_pct"),
        full,
        paid,
        round_half_away(F.try_divide(paid - full, full) * 100, 2).alias("effet_promo_pct"),
    )


@model("v_sensibilite_promotions", "mrt_fct_commandes", "mrt_dim_produits")
def promotion_sensitivity(fact: DataFrame, products: DataFrame, min_quantity: int = 50) -> DataFrame:
    """Share of quantity and revenue sold with a promotion, for products that sold at least ``min_quantity``."""
    promoted = F.col("id_promotion").isNotNull()
    paid = cents(F.col(PAID))
    zero = F.lit(0).cast("bigint")
    totals = (
        not_cancelled(fact)
        .where(F.col("id_produit").isNotNull())
        .groupBy("id_produit")
        .agg(
            F.sum(F.when(promoted, F.coalesce("quantite", zero)).otherwise(zero)).alias("quantite_en_promo"),
            F.sum(F.when(promoted, zero).otherwise(F.coalesce("quantite", zero))).alias("quantite_hors_promo"),
            F.sum(F.coalesce(paid, zero)).alias("_all"),
            F.sum(F.when(promoted, F.coalesce(paid, zero)).otherwise(zero)).alias("_promoted"),
            F.sum("quantite").alias("_quantity"),
            F.sum(F.when(promoted, paid).otherwise(zero)).alias("_promoted_paid"),
            F.sum(paid).alias("_paid"),
        )
        .where(F.col("_quantity") >= min_quantity)
    )
    named = totals.join(products.select("id_produit", "produit", "categorie"), "id_produit")
    items = named.select(
        "id_produit",
        "produit",
        "categorie",
        "quantite_en_promo",
        "quantite_hors_promo",
        from_cents(F.col("_all")).alias("ca_total"),
        from_cents(F.col("_promoted")).alias("ca_promo"),
        F.try_divide("quantite_en_promo", "_quantity").alias("taux_sensibilite_volume"),
        F.try_divide("_promoted_paid", "_paid").alias("taux_sensibilite_valeur"),
    )
    items = written(items, "items")
    return global_rank(items, "taux_sensibilite_volume", "rang_sensibilite_volume", rows=items.count())
