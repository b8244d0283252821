"""Star schema: facts, dimensions and the favourite-product relation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions.semantics import (
    amount_due,
    fill_blank,
    gross_amount,
    is_blank,
    product_code,
    promotion_value,
    round_money,
)
from emporia.operators.joins import lookup
from emporia.plans.warehouse import CALENDAR_SPAN, ORDER_MONTH, model


def _copy(df: DataFrame) -> DataFrame:
    return df


def orders_between(fact: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Orders from ``first_day`` to ``last_day``; where the fact lies in months, only their folders are read."""
    first, last = F.to_date(F.lit(first_day)), F.to_date(F.lit(last_day))
    if ORDER_MONTH in fact.columns:
        fact = fact.where(F.col(ORDER_MONTH).between(first_day[:7], last_day[:7])).drop(ORDER_MONTH)
    return fact.where(F.col("date_commande").between(first, last))


for _name, _staged in {
    "mrt_dim_clients": "stg_clients",
    "mrt_dim_entrepots": "stg_entrepots",
    "mrt_fct_campagnes": "stg_campagnes",
    "mrt_fct_machines": "stg_entrepots_machines",
    "mrt_fct_posts": "stg_posts",
    "mrt_fct_satisfaction": "stg_satisfaction",
}.items():
    model(_name, _staged, table=True)(_copy)


@model("mrt_dim_dates", CALENDAR_SPAN, table=True)
def calendar_days(span: DataFrame) -> DataFrame:
    """One row per day between the first and the last day."""
    day = F.col("date_jour")
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("date_jour")).select(
        day,
        F.year(day).cast("bigint").alias("annee"),
        F.month(day).cast("bigint").alias("mois"),
        F.dayofmonth(day).cast("bigint").alias("jour"),
        dates.day_name(day).alias("jour_semaine"),
        dates.month_key(day).alias("annee_mois"),
    )


@model("mrt_dim_produits", "stg_produits", table=True)
def products(staged: DataFrame) -> DataFrame:
    return staged.select(
        "id_produit",
        "produit",
        fill_blank(F.col("marque"), F.lit(labels.UNKNOWN_BRAND)).alias("marque"),
        "categorie",
        fill_blank(F.col("sous_categorie"), F.col("categorie")).alias("sous_categorie"),
        fill_blank(F.col("variation"), F.lit(labels.UNKNOWN_VARIATION)).alias("variation"),
        "prix",
    )


@model("mrt_dim_promotions", "stg_promotions", table=True)
def promotions(staged: DataFrame) -> DataFrame:
    value = promotion_value(F.col("type_promotion"), F.col("valeur_promotion"))
    return staged.withColumn("valeur_promotion", value)


@model(
    "mrt_fct_commandes",
    "stg_commandes",
    "stg_details_commandes",
    "mrt_dim_produits",
    "mrt_dim_promotions",
    table=True,
)
def orders(orders: DataFrame, lines: DataFrame, products: DataFrame, promotions: DataFrame) -> DataFrame:
    """One row per order with its line, price, promotion and amounts before and after the promotion.

    Every right side is unique on its key, so no left join changes the number of orders and Catalyst drops the
    joins whose columns a query does not use. The order id joins two tables aggregated on it without a further
    shuffle; prices and promotions go through the lookup that spreads hot products and missing promotions.
    """
    prices = products.select("id_produit", F.col("prix").alias("prix_unitaire_avant_promotion"))
    offers = promotions.select(F.col("id_promotion").alias("_offer"), "type_promotion", "valeur_promotion")
    # The key is taken as written while the flag ignores blanks: "P012 " counts as promoted but finds no offer.
    code = F.concat(F.lit("PROM"), F.substring("id_promotion", 2, 1_000_000))
    promoted = ~is_blank(F.col("id_promotion"))
    joined = orders.withColumn("_offer", code).join(lines, "id_commande", "left")
    joined = lookup(joined, prices, "id_produit", sample=lines)
    joined = lookup(joined, offers, "_offer", sample=orders.select(code.alias("_offer")))
    gross = gross_amount(F.col("quantite"), F.col("prix_unitaire_avant_promotion"))
    return joined.select(
        "id_commande",
        "id_client",
        "id_entrepot_depart",
        "date_commande",
        "statut_commande",
        "mode_de_paiement",
        "numero_tracking",
        "date_livraison_estimee",
        "emballage_special",
        "id_produit",
        "quantite",
        "prix_unitaire_avant_promotion",
        round_money(gross).alias("montant_commande_avant_promotion"),
        F.when(promoted, F.col("_offer")).alias("id_promotion"),
        promoted.alias("promotion_oui_non"),
        "type_promotion",
        "valeur_promotion",
        amount_due(gross, F.col("type_promotion"), F.col("valeur_promotion")).alias(
            "montant_commande_apres_promotion"
        ),
    )


@model("mrt_rel_produits_favoris", "stg_clients", "stg_produits", table=True)
def favourites(clients: DataFrame, products: DataFrame) -> DataFrame:
    """One row per client and listed favourite; a client without a list has no row."""
    listed = clients.select("id_client", F.explode(F.split("favoris", ",")).alias("_text")).select(
        "id_client", product_code(F.col("_text")).alias("id_produit_favori")
    )
    names = products.select(
        F.col("id_produit").alias("id_produit_favori"), F.col("produit").alias("nom_produit_favori")
    )
    return lookup(listed, names, "id_produit_favori").select("id_client", "id_produit_favori", "nom_produit_favori")
