"""Checking SQL for the models, written from their definitions for an independent engine.

``assemble`` puts the named subqueries that a statement uses in front of it.
"""

from __future__ import annotations

import re

from emporia.functions import labels
from emporia.sources.projections import SQL, table_sql

# Amounts as whole units, of which a cent has so many, rounded half away from zero in whole numbers.
CENTS_OF = "CAST(sign({0}) * ((abs({0}) + {1} // 2) // {1}) AS DOUBLE) / 100"
NEAR = "CAST(ROUND(CAST({0} AS DECIMAL(28,10)), {1}) AS DOUBLE)"
CENTS = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def whole_cents(x: str, per_cent: int) -> str:
    return CENTS_OF.format(f"({x})", f"CAST({per_cent} AS HUGEINT)")


def near(x: str, digits: int) -> str:
    return NEAR.format(x, digits)


def total(x: str) -> str:
    return CENTS.format(x)


def _flag(column: str, yes: str, no: str) -> str:
    return f"CASE {column} WHEN '{yes}' THEN TRUE WHEN '{no}' THEN FALSE END AS {column}"


def _copy(name: str) -> str:
    return f"SELECT * FROM {name}"


def _band(names: tuple[str, ...]) -> str:
    """Up to and including each limit; older or unknown ages are in the last band."""
    cases = " ".join(f"WHEN age <= {limit} THEN '{name}'" for limit, name in zip(labels.AGE_LIMITS, names))
    return f"CASE {cases} ELSE '{names[-1]}' END"


BAND, CODE = _band(labels.AGE_LABELS), _band(labels.AGE_CODES)

PARTS: dict[str, str] = {
    "stg_campagnes": f"""SELECT id_campagne, date, {_flag('evenement_oui_non', 'Yes', 'No')}, evenement_type, canal,
        CAST(ROUND(budget) AS BIGINT) AS budget, CAST(ROUND(impressions) AS BIGINT) AS impressions,
        CAST(ROUND(clics) AS BIGINT) AS clics, CAST(ROUND(conversions) AS BIGINT) AS conversions, {near('ctr', 4)} AS ctr
        FROM raw_campagnes WHERE least(budget, impressions, clics, conversions) >= 0 AND id_campagne IS NOT NULL
        AND budget IS NOT NULL AND impressions IS NOT NULL AND clics IS NOT NULL AND conversions IS NOT NULL""",
    "stg_clients": "SELECT id_client, age, genre, frequence_visites, date_inscription, favoris FROM raw_clients",
    "stg_commandes": """SELECT id_commande, id_client, id_entrepot_depart, date_commande, statut_commande,
        id_promotion_appliquee AS id_promotion, mode_de_paiement, numero_tracking, date_livraison_estimee
        FROM raw_commandes""",
    "stg_details_commandes": f"""SELECT id_commande, id_produit, quantite, {_flag('emballage_special', 'Oui', 'Non')}
        FROM (SELECT * FROM raw_details_commandes WHERE id_commande IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY id_commande ORDER BY l_linenumber, l_partkey, l_suppkey,
                  quantite, l_extendedprice, emballage_special NULLS FIRST) = 1)
        WHERE quantite >= 0 AND id_produit IS NOT NULL""",
    "stg_entrepots": "SELECT * FROM raw_entrepots",
    "stg_entrepots_machines": """SELECT id AS id_entrepot_machine, id_machine, id_entrepot, type_machine, etat_machine,
        ifnull(temps_darret, 0) AS temps_arret, ifnull(volume_traite, 0) AS volume_traite, mois AS annee_mois
        FROM raw_entrepots_machines""",
    "stg_posts": "SELECT * FROM raw_posts WHERE volume_mentions >= 0",
    "stg_produits": """SELECT id AS id_produit, categorie, marque, produit, prix, sous_categorie, variation
        FROM raw_produits WHERE prix >= 0""",
    "stg_promotions": "SELECT * FROM raw_promotions",
    "stg_satisfaction": f"""SELECT id_satisfaction, id_commande, note_client, commentaire, {_flag('plainte', 'Yes', 'No')},
        ifnull(temps_reponse_support, 0) AS temps_reponse_support, type_plainte, employe_support
        FROM raw_satisfaction""",
    "mrt_dim_clients": _copy("stg_clients"),
    "mrt_dim_entrepots": _copy("stg_entrepots"),
    "mrt_fct_campagnes": _copy("stg_campagnes"),
    "mrt_fct_machines": _copy("stg_entrepots_machines"),
    "mrt_fct_posts": _copy("stg_posts"),
    "mrt_fct_satisfaction": _copy("stg_satisfaction"),
    "mrt_dim_dates": """SELECT CAST(d AS DATE) AS date_jour, CAST(year(d) AS BIGINT) AS annee,
        CAST(month(d) AS BIGINT) AS mois, CAST(day(d) AS BIGINT) AS jour, dayname(d) AS jour_semaine,
        strftime(d, '%Y-%m') AS annee_mois
        FROM (SELECT unnest(generate_series(min(date_commande), max(date_commande), INTERVAL 1 DAY)) AS d
              FROM raw_commandes)""",
    "mrt_dim_produits": """SELECT id_produit, produit, ifnull(nullif(trim(marque), ''), 'Divers') AS marque, categorie,
        ifnull(nullif(trim(sous_categorie), ''), categorie) AS sous_categorie,
        ifnull(nullif(trim(variation), ''), 'Variation inconnue') AS variation, prix FROM stg_produits""",
    "mrt_dim_promotions": """SELECT * REPLACE (CASE type_promotion
            WHEN 'Pourcentage' THEN TRY_CAST(rtrim(valeur_promotion, '%') AS DOUBLE) / 100
            WHEN 'Remise fixe' THEN TRY_CAST(regexp_replace(replace(valeur_promotion, ',', '.'), '[^0-9.]', '', 'g')
                AS DOUBLE) END AS valeur_promotion) FROM stg_promotions""",
    "priced": """SELECT o.*, l.emballage_special, l.id_produit, l.quantite, p.prix,
        CAST(round(p.prix * 10000) AS HUGEINT) * l.quantite AS brut,
        coalesce(trim(o.id_promotion), '') <> '' AS promotion_oui_non, r.type_promotion, r.valeur_promotion
        FROM stg_commandes o
        LEFT JOIN stg_details_commandes l USING (id_commande)
        LEFT JOIN mrt_dim_produits p ON p.id_produit = l.id_produit
        LEFT JOIN mrt_dim_promotions r ON r.id_promotion = 'PROM' || substr(o.id_promotion, 2)""",
    "reduced": """SELECT *, CAST(round(valeur_promotion * 10000) AS HUGEINT) AS remise,
        1000000 - CAST(round(valeur_promotion * 1000000) AS HUGEINT) AS reste FROM priced""",
    "discounted": """SELECT *, CASE
            WHEN type_promotion = 'Remise fixe' THEN CASE WHEN brut >= remise THEN (brut - remise) * 1000000 WHEN brut < remise THEN 0 END
            WHEN type_promotion = 'Pourcentage' THEN CASE WHEN reste >= 0 THEN brut * reste WHEN reste < 0 THEN 0 END
            ELSE brut * 1000000 END AS net FROM reduced""",
    "mrt_fct_commandes": f"""SELECT id_commande, id_client, id_entrepot_depart, date_commande, statut_commande,
        mode_de_paiement, numero_tracking, date_livraison_estimee, emballage_special, id_produit, quantite,
        prix AS prix_unitaire_avant_promotion, {whole_cents('brut', 100)} AS montant_commande_avant_promotion,
        CASE WHEN promotion_oui_non THEN 'PROM' || substr(id_promotion, 2) END AS id_promotion, promotion_oui_non,
        type_promotion, valeur_promotion, {whole_cents('net', 100_000_000)} AS montant_commande_apres_promotion
        FROM discounted""",
    "mrt_rel_produits_favoris": """SELECT f.id_client, f.id_produit_favori, p.produit AS nom_produit_favori
        FROM (SELECT id_client, 'P' || lpad(nullif(regexp_extract(trim(t), 'P?([0-9]+)', 1), ''), 5, '0')
                  AS id_produit_favori
              FROM (SELECT id_client, unnest(string_split(favoris, ',')) AS t FROM stg_clients)) f
        LEFT JOIN stg_produits p ON p.id_produit = f.id_produit_favori""",
    "ventes": "SELECT * FROM mrt_fct_commandes WHERE NOT statut_commande = 'Annulée'",
    "ventes_clients": f"""SELECT v.*, c.genre, {BAND} AS tranche_age, {CODE} AS code_age, p.produit, p.categorie
        FROM ventes v JOIN mrt_dim_clients c USING (id_client) JOIN mrt_dim_produits p USING (id_produit)""",
    "delais": """SELECT *, CAST(date_diff('day', date_commande, date_livraison_estimee) AS BIGINT) AS delai,
        strftime(date_commande, '%Y-%m') AS mois_commande FROM mrt_fct_commandes""",
    "mediane": "SELECT quantile_cont(delai, 0.5) AS mediane FROM delais",
}


def _sales(keys: str, source: str = "ventes_clients") -> str:
    return f"""SELECT {keys}, CAST(SUM(coalesce(quantite, 0)) AS BIGINT) AS quantite_totale,
        {total('coalesce(montant_commande_apres_promotion, 0)')} AS chiffre_affaires FROM {source} GROUP BY ALL"""


def _segments(keys: str, by: str, names: tuple[str, ...] | None, column: str, source: str = "ventes_clients",
              mid: tuple[str, str] = ("mediane_volume", "mediane_ca")) -> str:
    part = f"PARTITION BY {by}" if by else ""
    text = f"""SELECT *, rank() OVER ({part} ORDER BY quantite_totale DESC) AS rang_volume,
        rank() OVER ({part} ORDER BY chiffre_affaires DESC) AS rang_valeur,
        quantile_disc(quantite_totale, 0.5) OVER ({part}) AS {mid[0]},
        quantile_disc(chiffre_affaires, 0.5) OVER ({part}) AS {mid[1]} FROM ({_sales(keys, source)})"""
    if by:
        text += f" WHERE {by} IS NOT NULL"
    if names:
        sold, paid = f"quantite_totale >= {mid[0]}", f"chiffre_affaires >= {mid[1]}"
        both, volume, value, neither = names
        text = f"""SELECT *, CASE WHEN {sold} AND {paid} THEN '{both}' WHEN {sold} THEN '{volume}'
            WHEN {paid} THEN '{value}' ELSE '{neither}' END AS {column} FROM ({text})"""
    return text


FOUR = labels.CATEGORY_SEGMENTS
CATEGORY = _segments("categorie", "", FOUR, "segment_categorie")


def _pairs(by: str, digits: int | None) -> str:
    """Pair support by self-join of the distinct purchases; ``by`` is an expression over the client, or empty."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    source = (
        f"SELECT DISTINCT {group}id_client, id_produit FROM ventes JOIN (SELECT id_client, genre, {CODE} AS tranche_age"
        " FROM mrt_dim_clients) USING (id_client)"
        if by
        else "SELECT DISTINCT id_client, id_produit FROM ventes"
    )
    same = f" AND a.{by} = b.{by}" if by else ""
    equal = f" AND h{{0}}.{by} = s.{by}" if by else ""

    def share(n: int) -> str:
        ratio = f"CAST(s.n AS DOUBLE) / h{n}.n"
        return near(ratio, digits) if digits else ratio

    return f"""WITH achats AS ({source}),
        porteurs AS (SELECT {group}id_produit, count(*) AS n FROM achats GROUP BY ALL),
        paires AS (SELECT {'a.' + by + ',' if by else ''} a.id_produit AS x, b.id_produit AS y, count(*) AS n
            FROM achats a JOIN achats b ON a.id_client = b.id_client AND a.id_produit < b.id_produit{same} GROUP BY ALL),
        s AS (SELECT *, quantile_disc(n, 0.5) OVER ({part}) AS m FROM paires)
    SELECT {'s.' + by + ',' if by else ''} x AS produit_1, p1.produit AS produit_libelle_1, p1.categorie AS categorie_1,
        p1.marque AS marque_1, y AS produit_2, p2.produit AS produit_libelle_2, p2.categorie AS categorie_2,
        p2.marque AS marque_2, s.n AS nb_clients_ayant_les_deux, h1.n AS nb_clients_produit_1,
        h2.n AS nb_clients_produit_2, {share(1)} AS confiance_1_vers_2, {share(2)} AS confiance_2_vers_1,
        s.m AS mediane_clients_par_paire
    FROM s JOIN porteurs h1 ON h1.id_produit = x{equal.format(1)} JOIN porteurs h2 ON h2.id_produit = y{equal.format(2)}
    JOIN mrt_dim_produits p1 ON p1.id_produit = x JOIN mrt_dim_produits p2 ON p2.id_produit = y WHERE s.n >= 3"""


_SCORES = """(ca - avg(ca) OVER (PARTITION BY mois)) / nullif(stddev_samp(ca) OVER (PARTITION BY mois), 0) AS zm,
        (ca - avg(ca) OVER (PARTITION BY jour_semaine)) / nullif(stddev_samp(ca) OVER (PARTITION BY jour_semaine), 0)
        AS zj"""


def _sentiment_sums(source: str, key: str) -> str:
    names = (("neutres", "Neutre"), ("positives", "Positif"), ("negatives", "Négatif"))
    sums = ", ".join(
        f"CAST(coalesce(sum(volume_mentions) FILTER (sentiment_global = '{v}'), 0) AS BIGINT) AS volumes_mentions_{n}"
        for n, v in names
    )
    return f"SELECT {key}, {sums}, CAST(sum(volume_mentions) AS BIGINT) AS volume_mentions_total FROM {source} GROUP BY ALL"


_AFTER = """(SELECT count(*) FROM mrt_fct_commandes c
        WHERE c.date_commande >= d.jour AND c.date_commande <= d.jour + 7)"""

# Fixed values, listed once in emporia/functions/labels.py.
_WORDS = "(VALUES {}) AS w(i, texte, mot)".format(
    ", ".join(f"({i}, '{text}', '{word}')" for i, (text, word) in enumerate(labels.COMMENT_PHRASES))
)
_SENTENCES = "(VALUES {}) AS w(texte, mot)".format(
    ", ".join(f"('{text}', '{word}')" for text, word in labels.COMMENT_SENTENCES)
)
_MOOD = "CASE WHEN note_client >= 3 THEN 'positif' WHEN note_client <= 2 THEN 'negatif' ELSE 'neutre' END"
COMMENTS = f"""SELECT id_commande, note_client, commentaire, {_MOOD} AS sentiment,
        ifnull((SELECT arg_min(mot, i) FROM {_WORDS} WHERE contains(lower(commentaire), texte)), 'bad') AS mots_cles
        FROM mrt_fct_satisfaction WHERE commentaire IS NOT NULL"""

_PROMO_SUM = "CAST(coalesce(sum(quantite) FILTER (id_promotion IS {0}), 0) AS BIGINT)"

MODEL_SQL: dict[str, str] = {
    **{name: f"SELECT * FROM {name}" for name in PARTS if name.startswith(("stg_", "mrt_"))},
    "capacites_par_entrepot": "SELECT * FROM stg_entrepots",
    "referentiel_dates": "SELECT * FROM mrt_dim_dates",
    "v_segmentation_produits": _segments(
        "id_produit, produit", "", labels.PRODUCT_SEGMENTS, "segment_produit",
        "ventes JOIN mrt_dim_produits USING (id_produit)", ("mediane_quantite", "mediane_chiffre_affaires")),
    "v_segmentation_categories": CATEGORY,
    "tests_analyse_ventes": f"""SELECT * REPLACE (CASE WHEN rang_global <= 3 THEN 'Vraie Star' ELSE segment_categorie END
        AS segment_categorie) FROM (SELECT *, rank() OVER (ORDER BY quantite_totale + chiffre_affaires DESC)
        AS rang_global FROM ({CATEGORY}))""",
    "v_produits_plebiscites_par_genre": _segments("genre, id_produit, produit", "genre", FOUR, "segment_produit"),
    "v_produits_plebiscites_par_tranche_age_simple": _sales("tranche_age, id_produit, produit, categorie"),
    "v_produits_plebiscites_par_tranche_age": "SELECT * FROM ("
    + _segments("tranche_age, id_produit, produit, categorie", "tranche_age", None, "") + ") WHERE rang_volume <= 10",
    "v_categories_plebiscitees_par_tranche_age_simple": _sales("tranche_age, categorie"),
    "v_categories_plebiscitees_par_tranche_age": _segments("tranche_age, categorie", "tranche_age", None, ""),
    "v_preferences_produits_par_age": f"""SELECT *, rank() OVER (PARTITION BY tranche_age ORDER BY total_achete DESC)
            AS rang_volume, rank() OVER (PARTITION BY tranche_age ORDER BY "total_CA" DESC) AS rang_valeur
        FROM (SELECT {BAND} AS tranche_age, id_produit, p.produit, CAST(sum(quantite) AS BIGINT) AS total_achete,
                  CAST(sum(CAST(quantite * p.prix AS DECIMAL(18,4))) AS DOUBLE) AS "total_CA"
              FROM mrt_fct_commandes f JOIN mrt_dim_clients USING (id_client) JOIN mrt_dim_produits p USING (id_produit)
              GROUP BY ALL) QUALIFY rang_volume <= 5 OR rang_valeur <= 5""",
    "v_indicateurs_synthese": f"""WITH f AS (SELECT *, statut_commande <> 'Annulée' AS ok, statut_commande = 'Annulée' AS ko,
            CAST(montant_commande_apres_promotion AS DECIMAL(18,4)) AS net_d,
            CAST(montant_commande_avant_promotion AS DECIMAL(18,4)) AS brut_d FROM mrt_fct_commandes)
        SELECT CAST(round(sum(net_d) FILTER (ok)) AS DOUBLE) AS ca_effectif,
            CAST(round(sum(net_d) FILTER (ko)) AS DOUBLE) AS ca_annule,
            CAST(round(sum(net_d)) AS DOUBLE) AS ca_total_si_pas_annulation,
            CAST(round(sum(net_d) FILTER (ok)) AS DOUBLE) AS ca_effectif_apres_promo,
            CAST(round(sum(brut_d - net_d) FILTER (ok)) AS DOUBLE) AS montant_promotions,
            CAST(round(sum(brut_d) FILTER (ok)) AS DOUBLE) AS ca_sans_promotion,
            CAST(round(sum(brut_d) FILTER (ko)) AS DOUBLE) AS ca_theorique_annule,
            count(*) FILTER (ok) AS volume_commandes, count(*) FILTER (ko) AS volume_annule,
            count(*) FILTER (ok AND promotion_oui_non) AS volume_avec_promotion,
            CAST(round(sum(net_d) FILTER (ko)) AS DOUBLE) AS montant_annule,
            CAST(round(sum(net_d) FILTER (ok AND promotion_oui_non)) AS DOUBLE) AS montant_avec_promotion,
            CAST(count(*) FILTER (ko) AS DOUBLE) * 100 / count(*) AS pourcentage_annulation,
            {near('(1 - CAST(sum(net_d) FILTER (ok) AS DOUBLE) / CAST(sum(brut_d) FILTER (ok) AS DOUBLE)) * 100', 2)}
                AS taux_promotion,
            (SELECT count(DISTINCT id_entrepot_depart) FROM mrt_fct_commandes) AS nb_entrepots,
            (SELECT count(DISTINCT id_entrepot_machine) FROM mrt_fct_machines) AS nb_machines
        FROM f""",
    "performances_des_promotions": """SELECT id_commande, date_commande, statut_commande, quantite,
        prix_unitaire_avant_promotion, montant_commande_avant_promotion, id_promotion, promotion_oui_non, type_promotion,
        valeur_promotion, montant_commande_apres_promotion FROM ventes""",
    "v_effets_promotions": f"""SELECT e.id_produit, p.produit, p.categorie, p.marque, avec AS nb_commandes_avec_promo,
        tout - avec AS nb_commandes_sans_promo, tout AS nb_commandes_totales,
        {near('CAST(avec AS DOUBLE) / tout * 100', 2)} AS part_commandes_promo_pct, plein AS montant_sans_promo,
        paye AS montant_reel, {near('(paye - plein) / nullif(plein, 0) * 100', 2)} AS effet_promo_pct
        FROM (SELECT id_produit, count(*) AS tout, count(id_promotion) AS avec,
              CAST(sum(CAST(ifnull(quantite * prix_unitaire_avant_promotion, 0) AS DECIMAL(18,4))) AS DOUBLE) AS plein,
              {total('ifnull(montant_commande_apres_promotion, 0)')} AS paye FROM ventes GROUP BY id_produit) e
        LEFT JOIN mrt_dim_produits p ON p.id_produit = e.id_produit""",
    "v_sensibilite_promotions": f"""SELECT id_produit, produit, categorie,
        {_PROMO_SUM.format('NOT NULL')} AS quantite_en_promo, {_PROMO_SUM.format('NULL')} AS quantite_hors_promo,
        coalesce({total('montant_commande_apres_promotion')}, 0) AS ca_total,
        {total('CASE WHEN id_promotion IS NULL THEN 0 ELSE ifnull(montant_commande_apres_promotion, 0) END')} AS ca_promo,
        CAST({_PROMO_SUM.format('NOT NULL')} AS DOUBLE) / sum(quantite) AS taux_sensibilite_volume,
        {total('CASE WHEN id_promotion IS NULL THEN 0 ELSE montant_commande_apres_promotion END').replace(' AS DOUBLE)', ' * 100 AS DOUBLE)')}
            / nullif(CAST(SUM(CAST(montant_commande_apres_promotion AS DECIMAL(18,2))) * 100 AS DOUBLE), 0)
            AS taux_sensibilite_valeur,
        rank() OVER (ORDER BY CAST({_PROMO_SUM.format('NOT NULL')} AS DOUBLE) / sum(quantite) DESC)
            AS rang_sensibilite_volume
        FROM ventes JOIN mrt_dim_produits USING (id_produit) GROUP BY id_produit, produit, categorie
        HAVING sum(quantite) >= 50""",
    "v_produits_achetes_ensemble": _pairs("", 4),
    "v_produits_achetes_ensemble_par_genre": _pairs("genre", None),
    "v_produits_achetes_ensemble_par_tranche_age": _pairs("tranche_age", None),
    "v_produits_favoris": """SELECT id_produit AS id_produit_favori, produit AS nom_produit_favoris, categorie,
        sous_categorie, count(DISTINCT id_client) AS nb_clients_ayant_favori
        FROM mrt_dim_produits JOIN mrt_rel_produits_favoris ON id_produit_favori = id_produit
        GROUP BY id_produit, produit, categorie, sous_categorie""",
    "v_recurrence_pics_creux": f"""WITH j AS (SELECT date_commande AS jour, count(*) AS n FROM ventes GROUP BY ALL),
        s AS (SELECT *, avg(n) OVER w AS moy, quantile_disc(n, 0.5) OVER w AS med, stddev_samp(n) OVER w AS ecart
              FROM j WINDOW w AS (PARTITION BY day(jour))),
        z AS (SELECT *, (n - moy) / nullif(ecart, 0) AS z FROM s)
        SELECT jour, CAST(day(jour) AS BIGINT) AS jour_du_mois, CAST(isodow(jour) AS BIGINT) AS jour_de_semaine,
            ['Lundi', 'Mardi', 'Mercredi', 'Jeudi', 'Vendredi', 'Samedi', 'Dimanche'][isodow(jour)] AS nom_jour_fr,
            n AS nb_commandes, {near('moy', 2)} AS moyenne_attendue, CAST(med AS DOUBLE) AS mediane_commandes,
            {near('ecart', 2)} AS ecart_type_jour, {near('z', 2)} AS z_score,
            CASE WHEN z <= -1.5 THEN 'creux' WHEN z >= 1.5 THEN 'pic' ELSE 'normal' END AS statut FROM z""",
    "v_tendances_temporelles_lucratives": f"""WITH j AS (SELECT date_commande AS jour,
              {total('montant_commande_apres_promotion')} AS ca FROM ventes GROUP BY ALL),
        d AS (SELECT *, CAST(month(jour) AS BIGINT) AS mois, CAST(dayofweek(jour) + 1 AS BIGINT) AS jour_semaine FROM j),
        z AS (SELECT *, {_SCORES} FROM d)
        SELECT jour, CAST(year(jour) AS BIGINT) AS annee, mois, CAST(strftime(jour, '%U') AS BIGINT) AS semaine,
            jour_semaine, ca AS ca_journalier, {near('zm', 2)} AS z_score_mois, {near('zj', 2)} AS z_score_jour,
            rank() OVER (PARTITION BY mois ORDER BY ca DESC NULLS LAST) AS rang_dans_mois,
            rank() OVER (PARTITION BY jour_semaine ORDER BY ca DESC NULLS LAST) AS rang_dans_jour,
            CASE WHEN zm >= 1.5 OR zj >= 1.5 THEN 'pic' ELSE 'normal' END AS statut_lucratif FROM z""",
    "v_recurrence_pics_creux_semaines": f"""WITH d AS (SELECT strftime(date_commande, '%G') AS annee,
              strftime(date_commande, '%V') AS semaine, strftime(date_commande, '%G-S%V') AS semaine_affichee,
              month(date_commande) AS mois, dayofweek(date_commande) AS jour_semaine,
              {total('montant_commande_apres_promotion')} AS ca FROM ventes GROUP BY ALL),
        z AS (SELECT *, {_SCORES} FROM d)
        SELECT annee, semaine, semaine_affichee, {total('ca')} AS ca_total_semaine,
            count(*) FILTER (zm >= 1.5 OR zj >= 1.5) AS nb_jours_lucratifs,
            CASE WHEN count(*) FILTER (zm >= 1.5 OR zj >= 1.5) >= 3 THEN 'Semaine lucrative' ELSE 'Semaine normale' END
                AS statut_lucratif_semaine FROM z GROUP BY annee, semaine, semaine_affichee""",
    "impacts_pannes_machines_par_mois": """SELECT m.*, localisation, moyen AS delai_moyen_livraison_entrepot_mois
        FROM (SELECT id_machine, id_entrepot, type_machine, annee_mois,
                CAST(coalesce(sum(temps_arret) FILTER (etat_machine = 'En panne'), 0) AS BIGINT) AS temps_arret_panne,
                count(*) FILTER (etat_machine = 'En panne') AS nb_pannes_machines,
                CAST(sum(volume_traite) AS BIGINT) AS volume_traite FROM mrt_fct_machines GROUP BY ALL) m
        LEFT JOIN (SELECT id_entrepot_depart, mois_commande, avg(delai) AS moyen FROM delais GROUP BY ALL) d
            ON d.id_entrepot_depart = m.id_entrepot AND d.mois_commande = m.annee_mois
        LEFT JOIN mrt_dim_entrepots e ON e.id_entrepot = m.id_entrepot""",
    "performances_entrepots_par_mois": """SELECT e.id_entrepot, localisation, v.annee_mois,
        CAST(ifnull(volume, 0) AS BIGINT) AS total_volumes, ifnull(retards, 0) AS nb_retards
        FROM mrt_dim_entrepots e
        LEFT JOIN (SELECT id_entrepot, annee_mois, sum(volume_traite) AS volume FROM mrt_fct_machines GROUP BY ALL) v
            ON v.id_entrepot = e.id_entrepot
        LEFT JOIN (SELECT id_entrepot_depart, mois_commande, count(*) FILTER (delai > mediane) AS retards
                   FROM delais, mediane GROUP BY ALL) c
            ON c.id_entrepot_depart = e.id_entrepot AND c.mois_commande = v.annee_mois""",
    "performances_machines_par_mois": """SELECT id_entrepot, localisation, annee_mois, id_machine, type_machine,
        volume_traite FROM mrt_dim_entrepots JOIN mrt_fct_machines USING (id_entrepot)""",
    "repartition_commandes_par_entrepot_par_mois": """SELECT id_entrepot, localisation, mois_commande AS annee_mois,
        count(*) AS nombre_commandes FROM delais JOIN mrt_dim_entrepots ON id_entrepot = id_entrepot_depart GROUP BY ALL""",
    "performance_commentaire": COMMENTS,
    "performance_mots_cles": f"""WITH c AS (SELECT id_commande, commentaire, {_MOOD} AS sentiment,
            ifnull(mot, CASE note_client WHEN 5 THEN 'perfect' WHEN 3 THEN 'mediocre' END) AS mots_cles
            FROM mrt_fct_satisfaction LEFT JOIN {_SENTENCES} ON texte = lower(commentaire)
            WHERE commentaire IS NOT NULL)
        SELECT *, CASE WHEN mots_cles IS NOT NULL THEN count(*) OVER (PARTITION BY mots_cles) END AS frequence FROM c""",
    "performance_notes_categorie": """SELECT categorie, id_produit, mois_commande, avg(note_client) AS note_moyenne,
        count(*) AS nb_avis FROM delais JOIN mrt_fct_satisfaction USING (id_commande)
        JOIN mrt_dim_produits USING (id_produit) GROUP BY ALL""",
    "performance_notes_produit": """SELECT id_commande, note_client, date_commande, date_livraison_estimee,
        mois_commande AS mois_annee, id_produit, p.produit AS nom_produit, p.categorie
        FROM (SELECT * FROM delais JOIN mrt_fct_satisfaction USING (id_commande)
              WHERE note_client IS NOT NULL QUALIFY count(*) OVER (PARTITION BY id_produit) > 5)
        JOIN mrt_dim_produits p USING (id_produit)""",
    "performance_retard_satisfaction": """SELECT id_commande, date_commande, date_livraison_estimee,
        strftime(date_livraison_estimee, '%Y-%m') AS annee_mois, delai AS delai_commande,
        montant_commande_apres_promotion, mediane, delai > mediane AS retard_livraison, note_client, plainte, type_plainte
        FROM mrt_fct_satisfaction JOIN delais USING (id_commande), mediane""",
    "impacts_par_reseau_sur_business_7jours": f"""WITH d AS (SELECT date_post AS jour,
            CAST(sum(volume_mentions) AS BIGINT) AS volume_mentions_total, """
    + ", ".join(
        f"CAST(coalesce(sum(volume_mentions) FILTER (canal_social ILIKE '{c}'), 0) AS BIGINT) AS nombre_{c}"
        for c in ("instagram", "twitter", "tiktok", "facebook", "linkedin")
    )
    + f""" FROM mrt_fct_posts GROUP BY ALL)
        SELECT * EXCLUDE (jour), CAST(jour AS VARCHAR) AS date_poste,
            CASE WHEN jour IS NULL THEN 0 ELSE greatest({_AFTER}, 1) END AS commande_7_jours FROM d""",
    "impacts_reseaux_sur_business_par_jour": f"""WITH d AS ({_sentiment_sums('mrt_fct_posts', 'date_post AS jour')})
        SELECT * EXCLUDE (jour), CAST(jour AS VARCHAR) AS date_poste, {_AFTER} AS commande_7_jours FROM d""",
    "impacts_reseaux_sur_business": f"""WITH m AS (
            {_sentiment_sums('mrt_fct_posts', "strftime(date_post, '%Y-%m') AS annee_mois_post")}),
        c AS (SELECT mois_commande, count(*) FILTER (statut_commande <> 'Annulée') AS volume_commandes_viables,
                count(*) FILTER (statut_commande = 'Annulée') AS volume_commandes_annulees,
                count(*) AS volume_commandes_total FROM delais GROUP BY ALL),
        n AS (SELECT mois_commande, {near('avg(note_client)', 2)} AS note_moyenne
              FROM delais JOIN mrt_fct_satisfaction USING (id_commande) GROUP BY ALL)
        SELECT m.*, volume_commandes_viables, volume_commandes_annulees, volume_commandes_total, note_moyenne
        FROM m LEFT JOIN c ON c.mois_commande = annee_mois_post LEFT JOIN n ON n.mois_commande = annee_mois_post""",
    "performances_par_canal": f"""SELECT id_campagne, date, canal, CAST(sum(budget) AS BIGINT) AS budget,
        CAST(sum(clics) AS BIGINT) AS nombre_de_clics, {near('CAST(sum(budget) AS DOUBLE) / sum(clics)', 2)} AS cout_par_clic,
        CAST(sum(conversions) AS BIGINT) AS nombre_acquisitions,
        {near('CAST(sum(budget) AS DOUBLE) / sum(conversions)', 2)} AS cout_par_acquisition
        FROM mrt_fct_campagnes GROUP BY ALL""",
}


def assemble(body: str, families: bool = False) -> str:
    """``body`` with every subquery it needs, directly or through another one, as leading CTEs."""
    library = {**{f"raw_{name}": table_sql(name, families) for name in SQL}, **PARTS}
    names = re.compile(r"\b(" + "|".join(sorted(library, key=len, reverse=True)) + r")\b")
    ordered: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in dict.fromkeys(names.findall(text)):
            if name != own and name not in ordered:
                need(library[name], name)
                if name not in ordered:
                    ordered.append(name)

    need(body)
    if not ordered:
        return body
    leading = ", ".join(f"{name} AS ({library[name]})" for name in ordered)
    own = re.match(r"\s*WITH\s+", body)
    return f"WITH {leading}, {body[own.end():]}" if own else f"WITH {leading} {body}"
