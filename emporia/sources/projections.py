"""The ten retail source tables, derived from the benchmark tables in the test data folder.

The text below is plain SQL that Spark and the checking database both run. It keeps raw values on purpose:
text flags, NULLs, blanks, negative mentions, unknown and unparsable promotions. All rows of the benchmark
tables are kept; orders without an offer or a review come from offers and reviews under keys that no order has.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from emporia.operators.cleaning import in_order

_CODE = "LPAD(CAST({key} AS STRING), CAST(GREATEST(5, LENGTH(CAST({key} AS STRING))) AS INT), '0')"
_PROMO = "LPAD(CAST({key} AS STRING), CAST(GREATEST(3, LENGTH(CAST({key} AS STRING))) AS INT), '0')"

PRODUCT_ID = "'P' || " + _CODE.format(key="l_partkey")
# Sixty product families: enough common baskets for the product pair models.
FAMILY_ID = "'P' || " + _CODE.format(key="l_partkey % 60")

_DETAILS = """
SELECT l_orderkey AS id_commande, %s AS id_produit,
       CAST(l_quantity AS BIGINT) AS quantite,
       CASE l_returnflag WHEN 'A' THEN 'Oui' WHEN 'N' THEN 'Non' ELSE NULL END AS emballage_special,
       l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem"""

# The comments in "satisfaction" are fixed values, as in emporia/functions/labels.py.
SQL: dict[str, str] = {
    "clients": """
SELECT c_custkey AS id_client,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(18 + c_custkey % 60 AS BIGINT) END AS age,
       CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Femme'
            WHEN c_custkey % 3 = 1 THEN 'Homme' ELSE 'Autre' END AS genre,
       CAST(1 + c_custkey % 12 AS BIGINT) AS frequence_visites,
       DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS date_inscription,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN ''
            ELSE 'P' || CAST(c_custkey % 150 AS STRING) || ', ' || CAST(c_custkey % 40 AS STRING) || ' ,sans' END
            AS favoris
FROM customer""",
    "commandes": """
SELECT o_orderkey AS id_commande, o_custkey AS id_client,
       o_orderkey % 10 AS id_entrepot_depart,
       CAST(o_orderdate AS DATE) AS date_commande,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL
            WHEN o_orderstatus = 'P' THEN 'Annulée'
            WHEN o_orderstatus = 'O' THEN 'En transit' ELSE 'Livrée' END AS statut_commande,
       CASE WHEN o_orderkey % 33 = 0 THEN '   '
            WHEN o_orderkey % 39 = 0 THEN 'P012 '
            WHEN o_orderkey % 3 = 0 THEN 'P' || LPAD(CAST(1 + (o_orderkey * 7) % 150 AS STRING), 3, '0')
            WHEN o_orderkey % 3 = 1 THEN '' ELSE NULL END AS id_promotion_appliquee,
       o_orderpriority AS mode_de_paiement,
       'TRK' || CAST(o_orderkey AS STRING) AS numero_tracking,
       CAST(o_orderdate AS DATE) + CAST(1 + (o_orderkey * 7) % 12 AS INT) AS date_livraison_estimee
FROM orders""",
    "details_commandes": _DETAILS % PRODUCT_ID,
    "produits": f"""
SELECT 'P' || {_CODE.format(key="p_partkey")} AS id,
       p_type AS categorie,
       CASE WHEN p_partkey % 10 = 0 THEN ' ' WHEN p_partkey % 10 = 1 THEN NULL ELSE p_brand END AS marque,
       p_name AS produit,
       CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_retailprice END AS prix,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'SC' || CAST(p_size % 5 AS STRING) END AS sous_categorie,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS STRING) END AS variation
FROM part""",
    "promotions": f"""
SELECT CASE WHEN p_partkey % 7 = 0 THEN 'SANS' ELSE 'PROM' END || {_PROMO.format(key="p_partkey")} AS id_promotion,
       'P' || {_CODE.format(key="p_partkey")} AS id_produit,
       CASE p_partkey % 5 WHEN 0 THEN 'Cadeau' WHEN 1 THEN 'Pourcentage' WHEN 2 THEN 'Pourcentage'
            ELSE 'Remise fixe' END AS type_promotion,
       CASE WHEN p_partkey % 35 = 1 THEN 'abc' WHEN p_partkey % 45 = 3 THEN '20000€'
            WHEN p_partkey % 5 = 0 THEN 'x'
            WHEN p_partkey % 5 < 3 THEN CAST(5 + p_partkey % 40 AS STRING) || '%'
            ELSE CAST(1 + p_partkey % 30 AS STRING) || ',50 €' END AS valeur_promotion,
       DATE '1995-01-01' + CAST(p_partkey % 900 AS INT) AS date_debut,
       DATE '1996-01-01' + CAST(p_partkey % 900 AS INT) AS date_fin,
       'R' || CAST(p_partkey % 4 AS STRING) AS responsable_promotion
FROM part""",
    "entrepots": """
SELECT CAST(s_suppkey AS BIGINT) AS id_entrepot, s_name AS localisation,
       CAST(1000 + s_suppkey % 9 * 500 AS BIGINT) AS capacite_max,
       CAST(400 + s_suppkey % 7 * 90 AS BIGINT) AS volume_stocke,
       CAST(s_suppkey % 100 AS DOUBLE) / 100 AS taux_remplissage,
       CAST(12 + s_suppkey % 8 AS DOUBLE) AS temperature_moyenne_entrepot
FROM supplier""",
    "entrepots_machines": """
SELECT event_id AS id, user_id AS id_machine, user_id % 10 AS id_entrepot,
       'Type' || CAST(user_id % 4 AS STRING) AS type_machine,
       CASE event_type WHEN 'error' THEN 'En panne' WHEN 'view' THEN 'En maintenance' ELSE 'En service' END
           AS etat_machine,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(FLOOR(value) AS BIGINT) END AS temps_darret,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(FLOOR(value * 10) AS BIGINT) END AS volume_traite,
       SUBSTR(CAST(DATE '1995-01-01' + CAST(event_id % 80 * 30 AS INT) AS STRING), 1, 7) AS mois
FROM events""",
    "posts": """
SELECT event_id AS id_post,
       DATE '1994-12-01' + CAST(event_id * 13 % 2450 AS INT) AS date_post,
       CASE event_type WHEN 'view' THEN 'Instagram' WHEN 'click' THEN 'Twitter' WHEN 'signup' THEN 'TikTok'
            WHEN 'purchase' THEN 'Facebook' ELSE 'LinkedIn' END AS canal_social,
       CAST(FLOOR(value) AS BIGINT) - 1 AS volume_mentions,
       CASE event_id % 3 WHEN 0 THEN 'Neutre' WHEN 1 THEN 'Positif' ELSE 'Négatif' END AS sentiment_global,
       'post ' || CAST(event_id AS STRING) AS contenu_post
FROM events""",
    "campagnes": """
SELECT event_id AS id_campagne, CAST(ts AS DATE) AS date,
       CASE event_id % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'n/a' END AS evenement_oui_non,
       'Soldes' AS evenement_type, event_type AS canal,
       CAST(FLOOR(value * 10) AS BIGINT) AS budget,
       CAST(1000 + event_id % 500 AS BIGINT) AS impressions,
       CAST(1 + event_id % 50 AS BIGINT) AS clics,
       CAST(1 + event_id % 5 AS BIGINT) AS conversions,
       CAST(1 + event_id % 50 AS DOUBLE) / (1000 + event_id % 500) AS ctr
FROM events""",
    "satisfaction": """
SELECT o_orderkey AS id_satisfaction, CASE WHEN o_orderkey % 8 = 3 THEN -o_orderkey ELSE o_orderkey END AS id_commande,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS BIGINT) END AS note_client,
       CASE o_orderkey % 17
         WHEN 0 THEN 'Could be better.' WHEN 1 THEN 'Excellent product highly recommend!'
         WHEN 2 THEN 'Fast delivery and good service.' WHEN 3 THEN 'Good product, happy with the purchase'
         WHEN 4 THEN 'Average product, nothing special' WHEN 5 THEN 'Below average quality.'
         WHEN 6 THEN 'Delivery took too long.' WHEN 7 THEN 'Not satisfied with the service.'
         WHEN 8 THEN 'Terrible experience, will not buy again.' WHEN 9 THEN 'Great quality and service!'
         WHEN 10 THEN 'It was okay, not great.' WHEN 11 THEN 'The product arrived damaged.'
         WHEN 12 THEN 'Perfect experience, very happy!' WHEN 13 THEN 'Satisfied with the experience.'
         WHEN 14 THEN 'Customer service was unhelpful' WHEN 15 THEN 'No keyword here' ELSE NULL END AS commentaire,
       CASE o_orderkey % 4 WHEN 0 THEN 'Yes' WHEN 2 THEN 'No' ELSE NULL END AS plainte,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderkey % 48 AS BIGINT) END AS temps_reponse_support,
       CASE o_orderkey % 9 WHEN 0 THEN 'Product' WHEN 3 THEN 'Delivery' WHEN 6 THEN 'Price' ELSE NULL END
           AS type_plainte,
       'EMP' || CAST(o_orderkey % 20 AS STRING) AS employe_support
FROM orders""",
}

_BASE = {
    "clients": "customer",
    "commandes": "orders",
    "details_commandes": "lineitem",
    "produits": "part",
    "promotions": "part",
    "entrepots": "supplier",
    "entrepots_machines": "events",
    "posts": "events",
    "campagnes": "events",
    "satisfaction": "orders",
}


# Columns that the projections read.
BASE_SCHEMAS = {
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


# Columns that give the rows of a table their order; the others have one row per key, their first column.
ORDER = {
    "details_commandes": ["l_linenumber", "l_partkey", "l_suppkey", "quantite", "l_extendedprice", "emballage_special"]
}


def table_sql(name: str, families: bool = False) -> str:
    if name == "details_commandes" and families:
        return _DETAILS % FAMILY_ID
    return SQL[name]


def raw_table(spark: SparkSession, folder: str, name: str, families: bool = False) -> DataFrame:
    base = _BASE[name]
    scan = spark.read.schema(BASE_SCHEMAS[base]).parquet(f"{folder}/{base}.parquet")
    text = table_sql(name, families).replace(f"FROM {base}", "FROM {" + base + "}")
    return spark.sql(text, **{base: scan})


class RawTables(Mapping[str, DataFrame]):
    """The ten source tables by name; a table is scanned only when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str, families: bool = False) -> None:
        self._spark, self._folder, self._families = spark, folder, families

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SQL:
            raise KeyError(name)
        table = raw_table(self._spark, self._folder, name, self._families)
        return in_order(table, *ORDER.get(name, table.columns[:1]))

    def __iter__(self) -> Iterator[str]:
        return iter(SQL)

    def __len__(self) -> int:
        return len(SQL)

    def __contains__(self, name: object) -> bool:
        return name in SQL
