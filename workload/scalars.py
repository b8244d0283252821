"""Queries for scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emporia.functions import dates, semantics
from workload.oracle import near, whole_cents
from workload.registry import Data, query


def scalar(name: str, model: str, key: str, sql: dict[str, str], make):
    """A query that returns the key of ``model`` and one column per expression."""
    text = ", ".join(f"{expression} AS {column}" for column, expression in sql.items())

    @query(f"fn_{name}", f"SELECT {key}, {text} FROM {model}")
    def run(data: Data):
        columns: dict[str, Column] = make()
        return data(model).select(key, *[value.alias(column) for column, value in columns.items()])


C = F.col
ORDER_DAY = "date_commande"

scalar(
    "cast", "stg_campagnes", "id_campagne",
    {"entier": "CAST(round(budget / 8.0) AS BIGINT)", "reel": "CAST(budget AS DOUBLE)", "texte": "CAST(date AS VARCHAR)"},
    lambda: {"entier": F.round(C("budget") / 8).cast("bigint"), "reel": C("budget").cast("double"), "texte": C("date").cast("string")},
)
scalar(
    "try_cast", "stg_promotions", "id_promotion",
    {"valeur": "TRY_CAST(replace(valeur_promotion, '%', '') AS DOUBLE)"},
    lambda: {"valeur": F.replace(C("valeur_promotion"), F.lit("%"), F.lit("")).try_cast("double")},
)
scalar(
    "safe_divide", "mrt_fct_machines", "id_entrepot_machine",
    {"rapport": near("CAST(volume_traite AS DOUBLE) / nullif(temps_arret, 0)", 6)},
    lambda: {"rapport": semantics.round_half_away(F.try_divide("volume_traite", "temps_arret"), 6)},
)
scalar(
    "round", "mrt_fct_commandes", "id_commande",
    {"deux": whole_cents("CAST(round(prix_unitaire_avant_promotion * 10000) AS HUGEINT) * quantite * 125", 100_000),
     "zero": near("quantite * prix_unitaire_avant_promotion * 0.125", 0)},
    lambda: {
        "deux": semantics.round_money(C("quantite") * C("prix_unitaire_avant_promotion") * 0.125),
        "zero": semantics.round_half_away(C("quantite") * C("prix_unitaire_avant_promotion") * 0.125, 0),
    },
)
scalar(
    "greatest", "mrt_fct_commandes", "id_commande",
    {"borne": "CASE WHEN montant_commande_apres_promotion < 5000 THEN 5000 ELSE montant_commande_apres_promotion END"},
    lambda: {"borne": semantics.at_least(C("montant_commande_apres_promotion"), 5000)},
)
scalar(
    "coalesce", "mrt_fct_commandes", "id_commande",
    {"q": "ifnull(quantite, 0)", "m": "ifnull(montant_commande_apres_promotion, 0)"},
    lambda: {"q": F.coalesce("quantite", F.lit(0).cast("bigint")), "m": F.coalesce("montant_commande_apres_promotion", F.lit(0.0))},
)
scalar("mod", "stg_commandes", "id_commande", {"r": "(dayofweek(date_commande) + 6) % 7 + 1"},
       lambda: {"r": ((F.dayofweek(ORDER_DAY) + 5) % 7 + 1).cast("bigint")})
scalar("trim", "stg_commandes", "id_commande", {"t": "trim(id_promotion)"}, lambda: {"t": semantics.strip(C("id_promotion"))})
scalar("lower", "stg_satisfaction", "id_satisfaction", {"t": "lower(commentaire)"}, lambda: {"t": F.lower("commentaire")})
scalar("replace", "stg_promotions", "id_promotion", {"t": "replace(valeur_promotion, ',', '.')"},
       lambda: {"t": F.replace(C("valeur_promotion"), F.lit(","), F.lit("."))})
scalar("regexp_replace", "stg_promotions", "id_promotion", {"t": "regexp_replace(valeur_promotion, '[^0-9.]', '', 'g')"},
       lambda: {"t": F.regexp_replace("valeur_promotion", r"[^\d\.]", "")})
scalar("regexp_extract", "stg_clients", "id_client", {"t": "nullif(regexp_extract(favoris, 'P([0-9]+)', 1), '')"},
       lambda: {"t": semantics.extract(C("favoris"), r"P(\d+)")})
scalar("lpad", "stg_clients", "id_client", {"t": "lpad(CAST(id_client AS VARCHAR), 3, '0')"},
       lambda: {"t": F.lpad(C("id_client").cast("string"), 3, "0")})
scalar("concat", "stg_commandes", "id_commande", {"t": "numero_tracking || '-' || id_promotion"},
       lambda: {"t": F.concat("numero_tracking", F.lit("-"), "id_promotion")})
scalar("substr", "stg_commandes", "id_commande", {"t": "substr(id_promotion, 2)"},
       lambda: {"t": F.substring("id_promotion", 2, 1000)})
scalar("split", "stg_clients", "id_client", {"n": "CAST(len(string_split(favoris, ',')) AS BIGINT)", "premier": "string_split(favoris, ',')[1]"},
       lambda: {"n": F.when(C("favoris").isNotNull(), F.size(F.split("favoris", ","))).cast("bigint"), "premier": F.get(F.split("favoris", ","), 0)})
scalar("sequence", "stg_commandes", "id_commande", {"n": "CAST(len(generate_series(date_commande, date_livraison_estimee, INTERVAL 1 DAY)) AS BIGINT)"},
       lambda: {"n": F.size(F.sequence(ORDER_DAY, "date_livraison_estimee")).cast("bigint")})
scalar("array_offset", "stg_clients", "id_client", {"deuxieme": "string_split(favoris, ',')[2]"},
       lambda: {"deuxieme": F.get(F.split("favoris", ","), 1)})
scalar("date_add", "stg_posts", "id_post", {"fin": "date_post + 7"}, lambda: {"fin": F.date_add("date_post", 7)})
scalar("date_diff", "stg_commandes", "id_commande", {"jours": "date_diff('day', date_commande, date_livraison_estimee)"},
       lambda: {"jours": F.datediff("date_livraison_estimee", ORDER_DAY).cast("bigint")})
scalar("extract", "stg_commandes", "id_commande", {"a": "year(date_commande)", "m": "month(date_commande)", "j": "day(date_commande)"},
       lambda: {"a": F.year(ORDER_DAY).cast("bigint"), "m": F.month(ORDER_DAY).cast("bigint"), "j": F.dayofmonth(ORDER_DAY).cast("bigint")})
scalar("week_dayofweek", "stg_commandes", "id_commande",
       {"semaine": "CAST(strftime(date_commande, '%U') AS BIGINT)", "jour": "dayofweek(date_commande) + 1"},
       lambda: {"semaine": dates.sunday_week(C(ORDER_DAY)).cast("bigint"), "jour": F.dayofweek(ORDER_DAY).cast("bigint")})
scalar("format_date", "stg_commandes", "id_commande",
       {"mois": "strftime(date_commande, '%Y-%m')", "jour": "strftime(date_commande, '%Y-%m-%d')", "nom": "dayname(date_commande)"},
       lambda: {"mois": dates.month_key(C(ORDER_DAY)), "jour": F.date_format(ORDER_DAY, "yyyy-MM-dd"), "nom": dates.day_name(C(ORDER_DAY))})
scalar("iso_week", "stg_commandes", "id_commande",
       {"a": "strftime(date_commande, '%G')", "s": "strftime(date_commande, '%V')", "t": "strftime(date_commande, '%G-S%V')"},
       lambda: {"a": dates.iso_year(C(ORDER_DAY)).cast("string"), "s": dates.iso_week_text(C(ORDER_DAY)), "t": dates.iso_week_label(C(ORDER_DAY))})


@query("fn_to_date", "SELECT event_id, CAST(ts AS DATE) AS jour FROM events")
def to_date(data: Data):
    return data.table("events").select("event_id", F.to_date("ts").alias("jour"))


scalar("make_date", "mrt_dim_dates", "date_jour", {"premier": "make_date(annee, mois, 1)"},
       lambda: {"premier": F.make_date("annee", "mois", F.lit(1))})
scalar("bool_to_int", "mrt_fct_commandes", "id_commande",
       {"promo": "CAST(promotion_oui_non AS BIGINT)", "montant": "CAST(trunc(montant_commande_apres_promotion) AS BIGINT)"},
       lambda: {"promo": C("promotion_oui_non").cast("bigint"), "montant": C("montant_commande_apres_promotion").cast("bigint")})
