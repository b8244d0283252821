"""Sales indicators: volume and revenue per product, category, gender and age band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions import labels
from emporia.functions.semantics import age_band, cents, from_cents, is_blank, sum_exact
from emporia.operators.joins import lookup
from emporia.operators.ranking import global_rank
from emporia.operators.segmentation import median_segmentation
from emporia.plans.warehouse import model
from emporia.sources.shared import written

VOLUME, REVENUE = "quantite_totale", "chiffre_affaires"
PAID = "montant_commande_apres_promotion"


def not_cancelled(fact: DataFrame) -> DataFrame:
    """Orders that are not cancelled; an unknown status goes too."""
    return fact.where(F.col("statut_commande") != labels.CANCELLED)


def product_sales(
    fact: DataFrame, products: DataFrame, attributes: list[str], by: str | None = None, group: Column | None = None,
    clients: DataFrame | None = None,
) -> DataFrame:
    """Quantity and paid amount per product (and client group).

    Orders are reduced to one row per product and group before product attributes are joined, so the only
    full-size join is the one that finds the client's group; a hot product is a handful of rows by then.
    """
    orders = not_cancelled(fact).where(F.col("id_produit").isNotNull())
    if clients is not None:
        known = clients.select("id_client", *([group.alias(by)] if by else []))
        orders = lookup(
            orders.select("id_client", "id_produit", "quantite", PAID), known, "id_client", "inner",
            sample=fact.select("id_client"),
        )
    keys = ["id_produit", *([by] if by else [])]
    totals = orders.groupBy(*keys).agg(
        F.sum(F.coalesce("quantite", F.lit(0))).alias(VOLUME),
        F.sum(F.coalesce(cents(F.col(PAID)), F.lit(0))).alias("_cents"),
    )
    return totals.join(products.select("id_produit", *attributes), "id_produit")


def sales_per(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.groupBy(*keys).agg(
        F.sum(VOLUME).alias(VOLUME), from_cents(F.sum("_cents")).alias(REVENUE)
    )


def _with_revenue(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.select(*keys, VOLUME, from_cents(F.col("_cents")).alias(REVENUE))


def _band() -> Column:
    return age_band(F.col("age"))


FACT_CLIENTS_PRODUCTS = ("mrt_fct_commandes", "mrt_dim_clients", "mrt_dim_produits")


@model("v_segmentation_produits", "mrt_fct_commandes", "mrt_dim_produits")
def product_segments(fact: DataFrame, products: DataFrame) -> DataFrame:
    items = _with_revenue(product_sales(fact, products, ["produit"]), ["id_produit", "produit"])
    return median_segmentation(
        items,
        VOLUME,
        REVENUE,
        medians=("mediane_quantite", "mediane_chiffre_affaires"),
        segments=labels.PRODUCT_SEGMENTS,
        segment_name="segment_produit",
    )


@model("v_segmentation_categories", *FACT_CLIENTS_PRODUCTS)
def category_segments(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    items = sales_per(product_sales(fact, products, ["categorie"], clients=clients), ["categorie"])
    return median_segmentation(
        items, VOLUME, REVENUE, segments=labels.CATEGORY_SEGMENTS, segment_name="segment_categorie"
    )


@model("tests_analyse_ventes", *FACT_CLIENTS_PRODUCTS)
def top_category_segments(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """Category segments where the three best by volume plus revenue get a label of their own."""
    items = sales_per(product_sales(fact, products, ["categorie"], clients=clients), ["categorie"])
    segments = median_segmentation(
        items,
        VOLUME,
        REVENUE,
        segments=labels.CATEGORY_SEGMENTS,
        segment_name="segment_categorie",
        total_rank="rang_global",
    )
    best = F.when(F.col("rang_global") <= 3, labels.TOP_SEGMENT).otherwise(F.col("segment_categorie"))
    return segments.withColumn("segment_categorie", best)


@model("v_produits_plebiscites_par_genre", *FACT_CLIENTS_PRODUCTS)
def products_by_gender(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    totals = product_sales(fact, products, ["produit"], "genre", F.col("genre"), clients)
    return median_segmentation(
        _with_revenue(totals, ["genre", "id_produit", "produit"]),
        VOLUME,
        REVENUE,
        ["genre"],
        segments=labels.CATEGORY_SEGMENTS,
        segment_name="segment_produit",
    )


@model("v_produits_plebiscites_par_tranche_age_simple", *FACT_CLIENTS_PRODUCTS)
def product_sales_by_age(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    totals = product_sales(fact, products, ["produit", "categorie"], "tranche_age", _band(), clients)
    return _with_revenue(totals, ["tranche_age", "id_produit", "produit", "categorie"])


@model("v_produits_plebiscites_par_tranche_age", "v_produits_plebiscites_par_tranche_age_simple")
def top_products_by_age(items: DataFrame) -> DataFrame:
    ranked = median_segmentation(items, VOLUME, REVENUE, ["tranche_age"])
    return ranked.where(F.col("rang_volume") <= 10)


@model("v_categories_plebiscitees_par_tranche_age_simple", *FACT_CLIENTS_PRODUCTS)
def category_sales_by_age(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    totals = product_sales(fact, products, ["categorie"], "tranche_age", _band(), clients)
    return sales_per(totals, ["tranche_age", "categorie"])


@model("v_categories_plebiscitees_par_tranche_age", "v_categories_plebiscitees_par_tranche_age_simple")
def categories_by_age(items: DataFrame) -> DataFrame:
    return median_segmentation(items, VOLUME, REVENUE, ["tranche_age"])


@model("v_preferences_produits_par_age", *FACT_CLIENTS_PRODUCTS)
def preferred_products_by_age(fact: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """Top five products per age band by quantity or by catalogue value, cancelled orders included."""
    orders = fact.where(F.col("id_produit").isNotNull()).select("id_client", "id_produit", "quantite")
    known = clients.select("id_client", _band().alias("tranche_age"))
    banded = lookup(orders, known, "id_client", "inner", sample=fact.select("id_client"))
    totals = banded.groupBy("tranche_age", "id_produit").agg(F.sum("quantite").alias("total_achete"))
    priced = totals.join(products.select("id_produit", "produit", "prix"), "id_produit")
    # One price per product: quantity times price is the sum of the order values.
    value = (F.col("total_achete") * F.col("prix").cast("decimal(18,4)")).cast("double")
    items = priced.select("tranche_age", "id_produit", "produit", "total_achete", value.alias("total_CA"))
    items = written(items, "items")
    rows = items.count()
    ranked = global_rank(items, "total_achete", "rang_volume", ["tranche_age"], rows=rows)
    ranked = global_rank(ranked, "total_CA", "rang_valeur", ["tranche_age"], rows=rows, source=items)
    return ranked.where((F.col("rang_volume") <= 5) | (F.col("rang_valeur") <= 5))


@model("v_indicateurs_synthese", "mrt_fct_commandes", "mrt_fct_machines")
def summary(fact: DataFrame, machines: DataFrame) -> DataFrame:
    """One row of sales and logistics indicators."""
    status = F.col("statut_commande")
    valid, cancelled = status != labels.CANCELLED, status == labels.CANCELLED
    paid, listed = F.col(PAID), F.col("montant_commande_avant_promotion")
    offer = F.col("id_promotion")
    with_offer = valid & offer.isNotNull() & ~is_blank(offer)

    def total(condition: Column, amount: Column, otherwise: float | None = 0.0) -> Column:
        return sum_exact(F.when(condition, amount).otherwise(F.lit(otherwise)))

    def whole(amount: Column) -> Column:
        return F.round(amount).cast("double")

    sold, before = total(valid, paid), total(valid, listed)
    lost = total(cancelled, paid)
    rate = (F.lit(1.0) - sold.cast("double") / total(valid, listed, None).cast("double")) * 100
    figures = fact.agg(
        whole(sold).alias("ca_effectif"),
        whole(lost).alias("ca_annule"),
        whole(sum_exact(paid)).alias("ca_total_si_pas_annulation"),
        whole(sold).alias("ca_effectif_apres_promo"),
        whole(total(valid, listed - paid)).alias("montant_promotions"),
        whole(before).alias("ca_sans_promotion"),
        whole(total(cancelled, listed)).alias("ca_theorique_annule"),
        F.count_if(valid).alias("volume_commandes"),
        F.count_if(cancelled).alias("volume_annule"),
        F.count_if(with_offer).alias("volume_avec_promotion"),
        whole(lost).alias("montant_annule"),
        whole(total(with_offer, paid)).alias("montant_avec_promotion"),
        (F.count_if(cancelled) * F.lit(100.0) / F.count(F.lit(1))).alias("pourcentage_annulation"),
        F.round(rate.cast("decimal(28,10)"), 2).cast("double").alias("taux_promotion"),
        F.count_distinct("id_entrepot_depart").alias("nb_entrepots"),
    )
    resources = machines.agg(F.count("id_entrepot_machine").alias("nb_machines"))
    return figures.crossJoin(F.broadcast(resources))
