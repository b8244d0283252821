"""Products bought by the same clients, and favourite products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import labels
from emporia.functions.semantics import age_band, round_half_away
from emporia.operators.affinity import affinity_pairs
from emporia.operators.joins import lookup
from emporia.plans.sales import not_cancelled
from emporia.plans.warehouse import model


def described_pairs(
    purchases: DataFrame, products: DataFrame, by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Product pairs with names, support and the confidence of either direction."""
    pairs = listed = affinity_pairs(purchases, "id_client", "id_produit", by)
    for side in (1, 2):
        details = products.select(
            F.col("id_produit").alias(f"item_{side}"),
            F.col("produit").alias(f"produit_libelle_{side}"),
            F.col("categorie").alias(f"categorie_{side}"),
            F.col("marque").alias(f"marque_{side}"),
        )
        pairs = lookup(pairs, details, f"item_{side}", "inner", sample=listed)

    def confidence(side: int):
        share = F.try_divide("support", f"holders_{side}")
        return share if digits is None else round_half_away(share, digits)

    return pairs.select(
        *by,
        F.col("item_1").alias("produit_1"),
        "produit_libelle_1",
        "categorie_1",
        "marque_1",
        F.col("item_2").alias("produit_2"),
        "produit_libelle_2",
        "categorie_2",
        "marque_2",
        F.col("support").alias("nb_clients_ayant_les_deux"),
        F.col("holders_1").alias("nb_clients_produit_1"),
        F.col("holders_2").alias("nb_clients_produit_2"),
        confidence(1).alias("confiance_1_vers_2"),
        confidence(2).alias("confiance_2_vers_1"),
        F.col("median_support").alias("mediane_clients_par_paire"),
    )


def _purchases(fact: DataFrame) -> DataFrame:
    return not_cancelled(fact).select("id_client", "id_produit").dropna()


def _with_client(fact: DataFrame, clients: DataFrame) -> DataFrame:
    return lookup(_purchases(fact).distinct(), clients, "id_client", "inner", sample=fact.select("id_client"))


@model("v_produits_achetes_ensemble", "mrt_fct_commandes", "mrt_dim_produits")
def pairs(fact: DataFrame, products: DataFrame) -> DataFrame:
    return described_pairs(_purchases(fact), products, digits=4)


@model("v_produits_achetes_ensemble_par_genre", "mrt_fct_commandes", "mrt_dim_clients", "mrt_dim_produits")
def pairs_by_gender(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    grouped = _with_client(fact, clients.select("id_client", "genre"))
    return described_pairs(grouped, products, ["genre"])


@model("v_produits_achetes_ensemble_par_tranche_age", "mrt_fct_commandes", "mrt_dim_clients", "mrt_dim_produits")
def pairs_by_age(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    band = age_band(F.col("age"), labels.AGE_CODES).alias("tranche_age")
    grouped = _with_client(fact, clients.select("id_client", band))
    return described_pairs(grouped, products, ["tranche_age"])


@model("v_produits_favoris", "mrt_rel_produits_favoris", "mrt_dim_produits")
def favourite_products(favourites: DataFrame, products: DataFrame) -> DataFrame:
    counts = (
        favourites.where(F.col("id_produit_favori").isNotNull())
        .groupBy("id_produit_favori")
        .agg(F.count_distinct("id_client").alias("nb_clients_ayant_favori"))
    )
    details = products.select(
        F.col("id_produit").alias("id_produit_favori"),
        F.col("produit").alias("nom_produit_favoris"),
        "categorie",
        "sous_categorie",
    )
    return counts.join(details, "id_produit_favori").select(
        "id_produit_favori", "nom_produit_favoris", "categorie", "sous_categorie", "nb_clients_ayant_favori"
    )
