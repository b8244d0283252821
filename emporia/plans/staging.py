"""Staging models: the wanted columns of one cleaned source each, with fixed names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emporia.functions import labels
from emporia.plans.warehouse import model


def _whole(df: DataFrame, name: str, alias: str = "") -> str:
    """Whole number: fractions round half away from zero instead of being cut; text must parse."""
    value = f"ROUND({name})" if dict(df.dtypes)[name].startswith(("double", "float", "decimal")) else name
    return f"CAST({value} AS BIGINT) AS {alias or name}"


def _flag(name: str, yes_no: tuple[str, str]) -> str:
    """True / False for the two known words, NULL for anything else."""
    yes, no = yes_no
    return f"CASE {name} WHEN '{yes}' THEN TRUE WHEN '{no}' THEN FALSE END AS {name}"


def _date(name: str) -> str:
    return f"CAST({name} AS DATE) AS {name}"


def _double(name: str) -> str:
    return f"CAST({name} AS DOUBLE) AS {name}"


@model("stg_campagnes", "campagnes")
def campaigns(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_campagne",
        _date("date"),
        _flag("evenement_oui_non", labels.YES_NO_EN),
        "evenement_type",
        "canal",
        *[_whole(raw, name) for name in ("budget", "impressions", "clics", "conversions")],
        "CAST(ROUND(CAST(CAST(ctr AS DOUBLE) AS DECIMAL(28,10)), 4) AS DOUBLE) AS ctr",
    )


@model("stg_clients", "clients")
def clients(raw: DataFrame) -> DataFrame:
    """Personal columns are left out."""
    return raw.selectExpr(
        "id_client",
        _whole(raw, "age"),
        "genre",
        _whole(raw, "frequence_visites"),
        _date("date_inscription"),
        "favoris",
    )


@model("stg_commandes", "commandes")
def orders(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_commande",
        "id_client",
        "id_entrepot_depart",
        _date("date_commande"),
        "statut_commande",
        "id_promotion_appliquee AS id_promotion",
        "mode_de_paiement",
        "numero_tracking",
        _date("date_livraison_estimee"),
    )


@model("stg_details_commandes", "details_commandes")
def order_lines(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_commande", "id_produit", _whole(raw, "quantite"), _flag("emballage_special", labels.YES_NO_FR)
    )


@model("stg_entrepots", "entrepots")
def warehouses(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_entrepot",
        "localisation",
        _whole(raw, "capacite_max"),
        _whole(raw, "volume_stocke"),
        _double("taux_remplissage"),
        _double("temperature_moyenne_entrepot"),
    )


@model("stg_entrepots_machines", "entrepots_machines")
def machines(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id AS id_entrepot_machine",
        "id_machine",
        "id_entrepot",
        "type_machine",
        "etat_machine",
        _whole(raw, "temps_darret", "temps_arret"),
        _whole(raw, "volume_traite"),
        "mois AS annee_mois",
    )


@model("stg_posts", "posts")
def posts(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_post",
        _date("date_post"),
        "canal_social",
        _whole(raw, "volume_mentions"),
        "sentiment_global",
        "contenu_post",
    )


@model("stg_produits", "produits")
def products(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id AS id_produit", "categorie", "marque", "produit", _double("prix"), "sous_categorie", "variation"
    )


@model("stg_promotions", "promotions")
def promotions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_promotion",
        "id_produit",
        "type_promotion",
        "valeur_promotion",
        _date("date_debut"),
        _date("date_fin"),
        "responsable_promotion",
    )


@model("stg_satisfaction", "satisfaction")
def reviews(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "id_satisfaction",
        "id_commande",
        _whole(raw, "note_client"),
        "commentaire",
        _flag("plainte", labels.YES_NO_EN),
        _whole(raw, "temps_reponse_support"),
        "type_plainte",
        "employe_support",
    )
