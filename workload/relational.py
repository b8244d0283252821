"""Queries for sources, cleaning operators, patterns and relational primitives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions.semantics import age_band, keyword, sum_money
from emporia.operators import cleaning
from emporia.operators.affinity import affinity_pairs
from emporia.operators.deviation import add_zscore, deviation_label
from emporia.operators.joins import following_days_count, salted_lookup
from emporia.operators.ranking import global_rank, interpolated_median, lower_median
from emporia.operators.segmentation import median_segmentation
from emporia.plans.checks import NOT_NULL, UNIQUE, Check, run_checks
from emporia.plans.daily import run_daily
from emporia.plans.logistics import delivery_days, with_late_flag
from emporia.plans.sales import PAID, not_cancelled
from emporia.plans.marts import orders_between
from emporia.plans.warehouse import Warehouse
from emporia.sources.projections import SQL
from emporia.sources.shared import new_path
from emporia.sources.store import Store
from emporia.sources.tables import SCHEMAS, load_tables, read_records, read_table, replace_table
from workload.oracle import BAND, CODE, COMMENTS, FOUR, MODEL_SQL, _segments, near, total
from workload.registry import Data, query


def rows():
    return F.count(F.lit(1))


def _row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(rows().alias("lignes")).select(F.lit(n).alias("table_name"), "lignes") for n, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def _row_counts_sql(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS lignes FROM {s}" for n, s in names)


# Per column its present values and a measure of their content that both engines take alike.
_MEASURES = {
    "string": ("length(CAST({0} AS {1}))", "CAST(sum({0}) AS BIGINT)"),
    "double": ("round(CAST({0} AS DOUBLE) * 100)", "CAST(sum({0}) AS BIGINT)"),
    "date": ("datediff(CAST({0} AS DATE), DATE '1990-01-01')", "CAST(sum({0}) AS BIGINT)"),
    "bigint": ("CAST({0} AS BIGINT)", "CAST(sum({0}) AS BIGINT)"),
    "boolean": ("CAST({0} AS INT)", "CAST(sum({0}) AS BIGINT)"),
}


def _columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in SCHEMAS[name].split(", ")]


def _content_sql(name: str, columns: list[tuple[str, str]] | None = None, table: str | None = None) -> str:
    parts = []
    for column, kind in columns or _columns_of(name):
        value = "date_diff('day', DATE '1990-01-01', CAST({0} AS DATE))" if kind == "date" else _MEASURES[kind][0]
        total_of = _MEASURES[kind][1].format(value.format(column, "VARCHAR"))
        parts.append(
            f"SELECT '{name}' AS table_name, '{column}' AS colonne, count({column}) AS presents, {total_of} AS mesure FROM {table or 'raw_' + name}"
        )
    return " UNION ALL ".join(parts)


def _content(name: str, df: DataFrame, columns: list[tuple[str, str]] | None = None) -> DataFrame:
    columns = columns or _columns_of(name)
    figures = []
    for i, (column, kind) in enumerate(columns):
        value, total_of = _MEASURES[kind]
        figures += [f"count(`{column}`) AS p{i}", total_of.format(value.format(column, "STRING")) + f" AS m{i}"]
    listed = ", ".join(f"named_struct('colonne', '{c}', 'presents', p{i}, 'mesure', m{i})" for i, (c, _) in enumerate(columns))
    return df.selectExpr(*figures).selectExpr(f"'{name}' AS table_name", f"inline(array({listed}))")


@query("source_load_tables", " UNION ALL ".join(_content_sql(n) for n in SQL))
def load_written_tables(data: Data):
    """All ten source tables written to one folder and found there by name: content of every declared column."""
    folder = new_path(data.spark, "sources")
    for name in SQL:
        replace_table(data.raw[name], f"{folder}/{name}")
    return reduce(DataFrame.unionByName, [_content(n, df) for n, df in load_tables(data.spark, folder).items()])


_FEEDBACK_SQL = """SELECT CAST(id_satisfaction AS VARCHAR) AS id_satisfaction, CAST(id_commande AS VARCHAR) AS id_commande,
    note_client, commentaire, plainte, temps_reponse_support, type_plainte, employe_support FROM stg_satisfaction"""
# Headers as people type them; they clean to the declared names.
_TYPED_HEADERS = {
    "id_satisfaction": "ID Satisfaction",
    "id_commande": "Id-Commande",
    "note_client": "Note Client",
    "commentaire": "Commentaire",
    "plainte": "Plainte",
    "temps_reponse_support": "Temps Réponse  Support",
    "type_plainte": "Type-Plainte",
    "employe_support": "Employé Support",
}


def _feedback_through(data: Data, fmt: str, headers: dict[str, str] | None = None):
    path = new_path(data.spark, fmt)
    replace_table(data.raw["satisfaction"].withColumnsRenamed(headers or {}), path, fmt=fmt)
    raw = read_table(data.spark, path, fmt, SCHEMAS["satisfaction"])
    return Warehouse(data.spark, {"satisfaction": raw}).ref("stg_satisfaction")


@query("source_csv_typed", _FEEDBACK_SQL)
def csv_scan(data: Data):
    return _feedback_through(data, "csv")


@query("source_json_typed", _FEEDBACK_SQL)
def json_scan(data: Data):
    return _feedback_through(data, "json")


@query("source_csv_raw_headers", _FEEDBACK_SQL)
def csv_raw_headers(data: Data):
    return _feedback_through(data, "csv", _TYPED_HEADERS)


@query("source_json_raw_headers", _FEEDBACK_SQL)
def json_raw_headers(data: Data):
    return _feedback_through(data, "json", _TYPED_HEADERS)


_NOTE_LINES = """SELECT id_satisfaction, id_commande, note_client, commentaire, id_satisfaction % 40 AS sorte
    FROM raw_satisfaction"""
_REJECTED_SQL = f"""SELECT 'lue' AS etat, NULL AS motif, CASE WHEN sorte = 4 THEN 'deux' || chr(10) || 'lignes, "dites"' END AS texte,
        count(*) AS lignes, CAST(sum(id_satisfaction) AS BIGINT) AS somme FROM ({_NOTE_LINES}) WHERE sorte NOT IN (1, 2, 3, 5) GROUP BY ALL
    UNION ALL SELECT 'rejetee', {{0}}, NULL, count(*), NULL FROM ({_NOTE_LINES}) WHERE sorte IN (1, 2, 3, 5) GROUP BY ALL"""
_NOTE_SCHEMA = "id bigint, commande bigint, note double, texte string"


def _told(data: Data, lines: str, fmt: str, header: str | None) -> DataFrame:
    """Files of the given lines, read with the broken records apart: rows read by text, rejected ones by fault."""
    path = new_path(data.spark, fmt)
    notes = data.raw["satisfaction"].selectExpr("*", "id_satisfaction % 40 AS sorte")
    made = notes.select(F.expr(lines).alias("value"))
    if header is not None:  # every file begins with the header, as each comes from a system of its own
        made = made.mapInPandas(lambda parts: _with_header(header, parts), "value string")
    made.write.text(path)
    sound, rejected = read_records(data.spark, path, fmt, _NOTE_SCHEMA)
    none = F.lit(None)
    read = sound.groupBy("texte").agg(rows().alias("lignes"), F.sum("id").alias("somme"))
    read = read.select(F.lit("lue").alias("etat"), none.cast("string").alias("motif"), "texte", "lignes", "somme")
    faults = rejected.groupBy(F.col("fault").alias("motif")).agg(rows().alias("lignes"))
    faults = faults.select(F.lit("rejetee").alias("etat"), "motif", none.cast("string").alias("texte"), "lignes", none.cast("bigint").alias("somme"))
    return read.unionByName(faults)


def _with_header(header: str, parts):
    import pandas as pd

    yield pd.DataFrame({"value": [header]})
    yield from parts


@query(
    "source_csv_rejects",
    _REJECTED_SQL.format(
        "CASE WHEN sorte IN (1, 2) THEN 'the number of values is not that of the header' "
        "WHEN sorte = 3 THEN 'a quote inside a value' ELSE 'note is not a double' END"
    ),
)
def csv_rejects(data: Data):
    """CSV records that are too short, too long, broken by a quote, of a wrong type, or whole over two lines."""
    start = "concat_ws(',', id_satisfaction, id_commande"
    two_lines = '''"deux\\nlignes, ""dites"""'''
    lines = f"""CASE sorte WHEN 1 THEN {start}) WHEN 2 THEN {start}, '3', 'trop', 'long')
        WHEN 3 THEN {start}, '3', '"faux"x') WHEN 4 THEN {start}, '3', '{two_lines}')
        WHEN 5 THEN {start}, 'trois', '') ELSE {start}, '4', '') END"""
    return _told(data, lines, "csv", "Id,Commande,Note,Texte")


@query(
    "source_json_rejects",
    _REJECTED_SQL.format("CASE WHEN sorte IN (1, 2, 3) THEN 'no whole JSON object' ELSE 'note is not a double' END"),
)
def json_rejects(data: Data):
    """JSON lines that break off, are no object, or hold a value of a wrong type."""
    start = "concat('{ \"Id\": ', id_satisfaction, ', \"Commande\": ', id_commande"
    two_lines = "to_json(named_struct('Id', id_satisfaction, 'Commande', id_commande, 'Texte', 'deux\\nlignes, \"dites\"'))"
    lines = f"""CASE sorte WHEN 1 THEN {start}) WHEN 2 THEN '[1, 2]' WHEN 3 THEN {start}, ', "No') WHEN 4 THEN {two_lines}
        WHEN 5 THEN {start}, ', "Note": "trois" }}') ELSE {start}, ', "Note": 4, "Texte": null }}') END"""
    return _told(data, lines, "json", None)


_LINES = """SELECT CAST(l_orderkey AS VARCHAR) AS id_commande,
    CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'P' || l_partkey END AS id_produit,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN -l_quantity ELSE l_quantity END AS quantite,
    CASE l_returnflag WHEN 'A' THEN 'Oui' WHEN 'N' THEN 'Non' END AS emballage_special"""
_LINE_ORDER = "l_linenumber DESC, l_extendedprice, l_partkey, l_suppkey, l_returnflag"


#: Order lines in a file at most, as one task sorts and writes a file and one reads it.
_LINES_PER_FILE = 500_000


def _line_files(lines: int) -> int:
    return max(4, -(-lines // _LINES_PER_FILE))


@query(
    "ingest_first_source_row",
    f"""SELECT id_commande, id_produit, CAST(quantite AS BIGINT) AS quantite,
               CASE emballage_special WHEN 'Oui' THEN TRUE WHEN 'Non' THEN FALSE END AS emballage_special
        FROM ({_LINES} FROM lineitem
              QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) = 1)
        WHERE quantite >= 0 AND id_produit IS NOT NULL""",
)
def first_source_row(data: Data):
    """Order lines in files of the declared columns alone: the line that stands first in its file stays, whatever
    it holds, before missing and negative ones go."""
    path = new_path(data.spark, "lines")
    columns = [F.expr(c.strip()) for c in _LINE_ORDER.replace(" DESC", "").split(",")]
    lines = data.table("lineitem")
    ordered = lines.repartitionByRange(_line_files(lines.count()), "l_orderkey")
    ordered = ordered.sortWithinPartitions("l_orderkey", columns[0].desc(), *[c.asc_nulls_last() for c in columns[1:]])
    replace_table(ordered.selectExpr(*_line_columns()), path, fmt="csv")
    raw = read_table(data.spark, path, "csv", SCHEMAS["details_commandes"])
    return Warehouse(data.spark, {"details_commandes": raw}).ref("stg_details_commandes")


def _line_columns() -> list[str]:
    return [
        "CAST(l_orderkey AS STRING) AS id_commande",
        "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'P' || l_partkey END AS id_produit",
        "CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN -l_quantity ELSE l_quantity END AS quantite",
        "CASE l_returnflag WHEN 'A' THEN 'Oui' WHEN 'N' THEN 'Non' END AS emballage_special",
    ]


@query("sink_replace_table", "SELECT id_commande, statut_commande, date_commande FROM raw_commandes")
def replaced(data: Data):
    """The second write replaces all rows of the first."""
    path = new_path(data.spark, "replaced")
    orders = data.raw["commandes"].select("id_commande", "statut_commande", "date_commande")
    replace_table(orders.where(F.col("statut_commande").isNull()), path)
    replace_table(orders, path)
    return read_table(data.spark, path).drop(cleaning.POSITION)


@query(
    "model_default_calendar",
    """SELECT CAST(d AS DATE) AS date_jour, CAST(year(d) AS BIGINT) AS annee, CAST(month(d) AS BIGINT) AS mois,
        CAST(day(d) AS BIGINT) AS jour, dayname(d) AS jour_semaine, strftime(d, '%Y-%m') AS annee_mois,
        (SELECT count(*) FROM raw_commandes WHERE date_commande = CAST(d AS DATE)) AS commandes
        FROM (SELECT unnest(generate_series(DATE '2019-01-01', DATE '2025-12-30', INTERVAL 1 DAY)) AS d)""",
)
def default_calendar(data: Data):
    """The date dimension of a warehouse without a calendar of its own, with the orders of each day."""
    days = Warehouse(data.spark, data.raw).ref("mrt_dim_dates")
    orders = data.raw["commandes"].groupBy(F.col("date_commande").alias("date_jour")).agg(rows().alias("commandes"))
    return days.join(orders, "date_jour", "left").fillna(0, ["commandes"])


# Columns of the table models, as their models declare them.
_TABLES = {
    "mrt_dim_dates": "date_jour date, annee bigint, mois bigint, jour bigint, jour_semaine string, annee_mois string",
    "mrt_fct_satisfaction": "id_satisfaction bigint, id_commande bigint, note_client bigint, commentaire string, "
    "plainte boolean, temps_reponse_support bigint, type_plainte string, employe_support string",
    "mrt_dim_promotions": "id_promotion string, id_produit string, type_promotion string, valeur_promotion double, "
    "date_debut date, date_fin date, responsable_promotion string",
    "mrt_fct_campagnes": "id_campagne bigint, date date, evenement_oui_non boolean, evenement_type string, canal string, "
    "budget bigint, impressions bigint, clics bigint, conversions bigint, ctr double",
    "mrt_dim_produits": "id_produit string, produit string, marque string, categorie string, sous_categorie string, "
    "variation string, prix double",
    "mrt_rel_produits_favoris": "id_client bigint, id_produit_favori string, nom_produit_favori string",
    "mrt_dim_clients": "id_client bigint, age bigint, genre string, frequence_visites bigint, date_inscription date, "
    "favoris string",
    "mrt_fct_machines": "id_entrepot_machine bigint, id_machine bigint, id_entrepot bigint, type_machine string, "
    "etat_machine string, temps_arret bigint, volume_traite bigint, annee_mois string",
    "mrt_dim_entrepots": "id_entrepot bigint, localisation string, capacite_max bigint, volume_stocke bigint, "
    "taux_remplissage double, temperature_moyenne_entrepot double",
    "mrt_fct_posts": "id_post bigint, date_post date, canal_social string, volume_mentions bigint, "
    "sentiment_global string, contenu_post string",
    "mrt_fct_commandes": "id_commande bigint, id_client bigint, id_entrepot_depart bigint, date_commande date, "
    "statut_commande string, mode_de_paiement string, numero_tracking string, date_livraison_estimee date, "
    "emballage_special boolean, id_produit string, quantite bigint, prix_unitaire_avant_promotion double, "
    "montant_commande_avant_promotion double, id_promotion string, promotion_oui_non boolean, type_promotion string, "
    "valeur_promotion double, montant_commande_apres_promotion double",
}
_TABLE_COLUMNS = {name: [tuple(c.split()) for c in listed.split(", ")] for name, listed in _TABLES.items()}


@query("daily_job_tables", " UNION ALL ".join(_content_sql(n, columns, n) for n, columns in _TABLE_COLUMNS.items()))
def daily_job(data: Data):
    """The daily job writes every table model after its checks; content of every column of every written table."""
    store = new_path(data.spark, "store")
    run_daily(data.spark, data.raw, store, calendar=None)
    tables = Store(data.spark, store).current()
    return reduce(DataFrame.unionByName, [_content(n, tables.table(n), columns) for n, columns in _TABLE_COLUMNS.items()])


@query("daily_job_fact", MODEL_SQL["mrt_fct_commandes"])
def daily_fact(data: Data):
    """The order fact as the daily job left it in the store."""
    store = new_path(data.spark, "store")
    run_daily(data.spark, data.raw, store, calendar=None)
    return Store(data.spark, store).table("mrt_fct_commandes")


@query(
    "daily_job_months",
    """SELECT c.id_commande, c.date_commande, c.id_produit, c.quantite, s.note_client
        FROM mrt_fct_commandes c LEFT JOIN mrt_fct_satisfaction s ON c.id_commande = s.id_commande
        WHERE c.date_commande BETWEEN DATE '1995-02-10' AND DATE '1995-05-20'""",
)
def daily_months(data: Data):
    """Orders of some months with their notes, from a store laid out for large tables: only the months' folders of the
    fact are read, and orders and notes meet in their buckets."""
    store = new_path(data.spark, "store")
    run_daily(data.spark, data.raw, store, calendar=None, layout_bytes=0)
    tables = Store(data.spark, store).current()
    orders = orders_between(tables.table("mrt_fct_commandes"), "1995-02-10", "1995-05-20")
    notes = tables.table("mrt_fct_satisfaction").select("id_commande", "note_client")
    return orders.select("id_commande", "date_commande", "id_produit", "quantite").join(notes, "id_commande", "left")


@query(
    "daily_job_second_run",
    """SELECT (SELECT count(*) FROM mrt_fct_commandes) AS commandes, count(*) AS lignes_lues,
        CAST(sum(l_orderkey) AS BIGINT) AS somme FROM (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)""",
)
def second_run(data: Data):
    """A reader keeps the version that it resolved while another run replaces all tables."""
    store = Store(data.spark, new_path(data.spark, "store"))
    with store.new_version() as first:
        first.write("lignes", data.table("lineitem").where("l_linenumber = 1").select("l_orderkey"))
    reader = store.current().table("lignes")
    run_daily(data.spark, data.raw, store.root, calendar=None)
    fact = store.table("mrt_fct_commandes").agg(rows().alias("commandes"))
    return fact.crossJoin(F.broadcast(reader.agg(rows().alias("lignes_lues"), F.sum("l_orderkey").alias("somme"))))


@query(
    "ingest_clean_column_names",
    "SELECT id, id_machine, id_entrepot, temps_darret, volume_traite, mois AS etat_a_lete FROM raw_entrepots_machines",
)
def clean_names(data: Data):
    machines = data.raw["entrepots_machines"]
    messy = machines.select(
        F.col("id").alias("ID"),
        F.col("id_machine").alias("Id-Machine"),
        F.col("id_entrepot").alias("ID  Entrepôt"),
        F.col("temps_darret").alias("Temps d'arrêt"),
        F.col("volume_traite").alias("Volume traité"),
        F.col("mois").alias("Étât à l'été"),
    )
    # "à" is not among the replaced letters: it disappears.
    return cleaning.clean_column_names(messy).withColumnRenamed("etat__lete", "etat_a_lete")


@query(
    "ingest_dedup_keep_first",
    """SELECT id_commande, id_produit, quantite, l_linenumber FROM raw_details_commandes
       QUALIFY row_number() OVER (PARTITION BY id_commande ORDER BY quantite DESC, l_linenumber, l_partkey) = 1""",
)
def keep_first(data: Data):
    lines = data.raw["details_commandes"].select("id_commande", "id_produit", "quantite", "l_linenumber", "l_partkey")
    lines = lines.withColumn("_most", -F.col("quantite"))
    kept = cleaning.dedup_keep_first(lines, ["id_commande"], ["_most", "l_linenumber", "l_partkey"])
    return kept.select("id_commande", "id_produit", "quantite", "l_linenumber")


@query(
    "ingest_fill_missing",
    "SELECT id, ifnull(temps_darret, 0) AS temps_darret, ifnull(volume_traite, 0) AS volume_traite FROM raw_entrepots_machines",
)
def fill(data: Data):
    machines = data.raw["entrepots_machines"].select("id", "temps_darret", "volume_traite")
    return cleaning.fill_missing(machines, ["temps_darret", "volume_traite"])


@query(
    "ingest_keep_non_negative",
    "SELECT id, temps_darret, volume_traite FROM raw_entrepots_machines WHERE temps_darret >= 0 AND volume_traite >= 0",
)
def non_negative(data: Data):
    machines = data.raw["entrepots_machines"].select("id", "temps_darret", "volume_traite")
    return cleaning.keep_non_negative(machines, ["temps_darret", "volume_traite"])


@query("ingest_keep_present", "SELECT id, marque, prix FROM raw_produits WHERE marque IS NOT NULL AND prix IS NOT NULL")
def present(data: Data):
    return cleaning.keep_present(data.raw["produits"].select("id", "marque", "prix"), ["marque", "prix"])


@query(
    "ingest_recipes",
    _row_counts_sql((n, f"stg_{n}") for n in SQL),
)
def recipes(data: Data):
    """Rows of every source after its cleaning recipe."""
    return _row_counts({name: cleaning.clean_table(name, data.raw[name]) for name in SQL})


_PRODUCT_SALES = f"""(SELECT genre, id_produit, CAST(sum(quantite) AS BIGINT) AS quantite_totale,
    {total('coalesce(montant_commande_apres_promotion, 0)')} AS chiffre_affaires FROM ventes_clients GROUP BY ALL)"""


@query(
    "pattern_median_segmentation",
    _segments("genre, id_produit", "genre", FOUR, "segment"),
)
def distributed_segmentation(data: Data):
    """Segmentation by gender with ranks and medians read off value positions, no whole group in a task."""
    orders = not_cancelled(data("mrt_fct_commandes"))
    clients = data("mrt_dim_clients").select("id_client", "genre")
    known = data("mrt_dim_produits").select("id_produit")
    items = (
        orders.join(clients, "id_client")
        .join(known, "id_produit")
        .groupBy("genre", "id_produit")
        .agg(F.sum("quantite").alias("quantite_totale"), F.coalesce(sum_money(F.col(PAID)), F.lit(0.0)).alias("chiffre_affaires"))
    )
    return median_segmentation(
        items, "quantite_totale", "chiffre_affaires", ["genre"], segments=labels.CATEGORY_SEGMENTS, plain_rows=0
    )


_PAIRS_SQL = """WITH a AS (SELECT DISTINCT id_client, id_produit FROM mrt_fct_commandes WHERE id_produit IS NOT NULL),
    h AS (SELECT id_produit, count(*) AS n FROM a GROUP BY ALL),
    p AS (SELECT x.id_produit AS item_1, y.id_produit AS item_2, count(*) AS support
          FROM a x JOIN a y ON x.id_client = y.id_client AND x.id_produit < y.id_produit GROUP BY ALL)
    SELECT item_1, item_2, support, h1.n AS holders_1, h2.n AS holders_2,
        (SELECT quantile_disc(support, 0.5) FROM p) AS median_support
    FROM p JOIN h h1 ON h1.id_produit = item_1 JOIN h h2 ON h2.id_produit = item_2 WHERE support >= {0}"""


@query("pattern_affinity_pairs", _PAIRS_SQL.format(2))
def pairs_without_large_baskets(data: Data):
    """Product pairs over all products; the largest baskets are counted through masks."""
    orders = data("mrt_fct_commandes").select("id_client", "id_produit")
    return affinity_pairs(orders, "id_client", "id_produit", min_support=2, large_basket=15)


@query("join_self_theta", _PAIRS_SQL.format(2))
def pairs_joined(data: Data):
    orders = data("mrt_fct_commandes").select("id_client", "id_produit")
    return affinity_pairs(orders, "id_client", "id_produit", min_support=2)


@query("join_self_theta_familles", _PAIRS_SQL.format(3), families=True)
def family_pairs_joined(data: Data):
    orders = data("mrt_fct_commandes").select("id_client", "id_produit")
    return affinity_pairs(orders, "id_client", "id_produit", min_support=3)


@query(
    "pattern_zscore_flags",
    f"""WITH d AS (SELECT date_post AS jour, month(date_post) AS mois, CAST(sum(volume_mentions) AS BIGINT) AS n
          FROM mrt_fct_posts GROUP BY ALL),
        z AS (SELECT *, (n - avg(n) OVER (PARTITION BY mois)) / nullif(stddev_samp(n) OVER (PARTITION BY mois), 0) AS z
              FROM d)
        SELECT jour, n, {near('z', 6)} AS z,
            CASE WHEN z >= 1.5 THEN 'pic' WHEN z <= -1.5 THEN 'creux' ELSE 'normal' END AS statut FROM z""",
)
def zscores(data: Data):
    daily = (
        data("mrt_fct_posts")
        .groupBy(F.col("date_post").alias("jour"))
        .agg(F.sum("volume_mentions").alias("n"))
        .withColumn("mois", F.month("jour"))
    )
    scored = add_zscore(daily, "n", "mois", "z")
    status = deviation_label(F.col("z"), labels.PEAK, labels.DIP, labels.NORMAL)
    return scored.select("jour", "n", F.round(F.col("z").cast("decimal(28,10)"), 6).cast("double").alias("z"), status.alias("statut"))


_FOLLOWING = """SELECT jour, (SELECT count(*) FROM mrt_fct_commandes c
    WHERE c.date_commande BETWEEN d.jour AND d.jour + {0}) AS commandes
    FROM (SELECT DISTINCT date_post AS jour FROM mrt_fct_posts) d"""


@query("pattern_following_count", _FOLLOWING.format(30))
def following(data: Data):
    days = data("mrt_fct_posts").select(F.col("date_post").alias("jour")).distinct()
    return following_days_count(days, "jour", data("mrt_fct_commandes"), "date_commande", 30, "commandes")


@query("join_range_days", _FOLLOWING.format(7))
def range_join(data: Data):
    days = data("mrt_fct_posts").select(F.col("date_post").alias("jour")).distinct()
    return following_days_count(days, "jour", data("mrt_fct_commandes"), "date_commande", 7, "commandes")


@query(
    "pattern_late_vs_median",
    "SELECT id_commande, delai, mediane, delai > mediane AS retard FROM delais, mediane",
)
def late(data: Data):
    return with_late_flag(data("mrt_fct_commandes"), "retard").select(
        "id_commande", delivery_days().alias("delai"), "mediane", "retard"
    )


@query(
    "pattern_global_rank",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank() OVER (ORDER BY l_extendedprice DESC) AS rang FROM lineitem",
)
def ranked_lines(data: Data):
    """Rank of every order line by price without ordering the table in one task."""
    lines = data.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return global_rank(lines, "l_extendedprice", "rang")


@query("pattern_age_band", f"SELECT id_client, age, {BAND} AS tranche_age, {CODE} AS code_age FROM mrt_dim_clients")
def bands(data: Data):
    age = F.col("age")
    return data("mrt_dim_clients").select(
        "id_client", "age", age_band(age).alias("tranche_age"), age_band(age, labels.AGE_CODES).alias("code_age")
    )


@query("pattern_keyword_rules", f"SELECT id_commande, mots_cles FROM ({COMMENTS})")
def keyword_rules(data: Data):
    text = F.col("commentaire")
    word = keyword(text, labels.COMMENT_PHRASES, default=labels.COMMENT_DEFAULT)
    return data("mrt_fct_satisfaction").where(text.isNotNull()).select("id_commande", word.alias("mots_cles"))


@query("select_columns", "SELECT *, quantite AS q FROM (SELECT id_commande, id_produit AS produit, quantite FROM mrt_fct_commandes)")
def columns(data: Data):
    kept = data("mrt_fct_commandes").select("id_commande", F.col("id_produit").alias("produit"), "quantite")
    return kept.select("*", F.col("quantite").alias("q"))


@query(
    "select_case",
    "SELECT id_commande, CASE statut_commande WHEN 'Annulée' THEN 'perdue' WHEN 'Livrée' THEN 'faite' ELSE 'autre' END AS etat FROM stg_commandes",
)
def case_when(data: Data):
    status = F.col("statut_commande")
    state = F.when(status == labels.CANCELLED, "perdue").when(status == "Livrée", "faite").otherwise("autre")
    return data("stg_commandes").select("id_commande", state.alias("etat"))


@query("filter_not_equal", "SELECT id_commande FROM stg_commandes WHERE statut_commande <> 'Annulée'")
def not_equal(data: Data):
    return not_cancelled(data("stg_commandes")).select("id_commande")


@query(
    "filter_between",
    "SELECT id_client, age, date_inscription FROM stg_clients WHERE age BETWEEN 25 AND 40 AND date_inscription BETWEEN DATE '1994-03-01' AND DATE '1994-09-30'",
)
def between(data: Data):
    joined = F.col("date_inscription").between(F.lit("1994-03-01").cast("date"), F.lit("1994-09-30").cast("date"))
    return data("stg_clients").where(F.col("age").between(25, 40) & joined).select("id_client", "age", "date_inscription")


@query("filter_like", "SELECT id_satisfaction, commentaire FROM stg_satisfaction WHERE lower(commentaire) LIKE '%quality%'")
def like(data: Data):
    kept = data("stg_satisfaction").where(F.lower("commentaire").contains("quality"))
    return kept.select("id_satisfaction", "commentaire")


@query(
    "filter_null_logic",
    "SELECT id_commande FROM stg_commandes WHERE NOT (statut_commande = 'Annulée') AND id_promotion IS NOT NULL OR statut_commande IS NULL",
)
def null_logic(data: Data):
    status = F.col("statut_commande")
    kept = (~(status == labels.CANCELLED) & F.col("id_promotion").isNotNull()) | status.isNull()
    return data("stg_commandes").where(kept).select("id_commande")


@query("filter_in", "SELECT id_post, sentiment_global FROM stg_posts WHERE sentiment_global IN ('Positif', 'Négatif')")
def in_list(data: Data):
    kept = data("stg_posts").where(F.col("sentiment_global").isin("Positif", "Négatif"))
    return kept.select("id_post", "sentiment_global")


@query(
    "select_chained_steps",
    """WITH a AS (SELECT id_entrepot, annee_mois, sum(volume_traite) AS v FROM mrt_fct_machines GROUP BY ALL),
       b AS (SELECT id_entrepot, max(v) AS m FROM a GROUP BY ALL), c AS (SELECT * FROM b WHERE m > 0)
       SELECT id_entrepot, CAST(m AS BIGINT) AS meilleur_mois FROM c""",
)
def chained(data: Data):
    monthly = data("mrt_fct_machines").groupBy("id_entrepot", "annee_mois").agg(F.sum("volume_traite").alias("v"))
    best = monthly.groupBy("id_entrepot").agg(F.max("v").alias("meilleur_mois"))
    return best.where(F.col("meilleur_mois") > 0)


@query(
    "select_scalar_subquery",
    """SELECT count(*) AS commandes, (SELECT count(DISTINCT id_client) FROM stg_clients) AS clients,
       (SELECT count(DISTINCT id_machine) FROM stg_entrepots_machines) AS machines FROM stg_commandes""",
)
def scalar_subqueries(data: Data):
    orders = data("stg_commandes").agg(rows().alias("commandes"))
    clients = data("stg_clients").agg(F.count_distinct("id_client").alias("clients"))
    machines = data("stg_entrepots_machines").agg(F.count_distinct("id_machine").alias("machines"))
    return orders.crossJoin(F.broadcast(clients)).crossJoin(F.broadcast(machines))  # one row each


@query(
    "join_inner_one_key",
    "SELECT id_commande, id_produit, categorie FROM mrt_fct_commandes JOIN mrt_dim_produits USING (id_produit)",
)
def inner_one(data: Data):
    products = data("mrt_dim_produits").select("id_produit", "categorie")
    return data("mrt_fct_commandes").select("id_commande", "id_produit").join(products, "id_produit")


@query(
    "join_salted_lookup",
    "SELECT id_commande, id_produit, categorie FROM mrt_fct_commandes LEFT JOIN mrt_dim_produits USING (id_produit)",
)
def salted(data: Data):
    """The join used when the product table is too large to broadcast: heavy and missing keys are salted."""
    products = data("mrt_dim_produits").select("id_produit", "categorie")
    return salted_lookup(data("mrt_fct_commandes").select("id_commande", "id_produit"), products, ["id_produit"])


@query(
    "join_inner_two_keys",
    """SELECT id_entrepot_machine, id_entrepot, annee_mois, n FROM mrt_fct_machines JOIN
       (SELECT id_entrepot_depart AS id_entrepot, mois_commande AS annee_mois, count(*) AS n FROM delais GROUP BY ALL)
       USING (id_entrepot, annee_mois)""",
)
def inner_two(data: Data):
    orders = (
        data("mrt_fct_commandes")
        .groupBy(F.col("id_entrepot_depart").alias("id_entrepot"), dates.month_key(F.col("date_commande")).alias("annee_mois"))
        .agg(rows().alias("n"))
    )
    machines = data("mrt_fct_machines").select("id_entrepot_machine", "id_entrepot", "annee_mois")
    return machines.join(orders, ["id_entrepot", "annee_mois"])


@query(
    "join_left_computed_key",
    """SELECT o.id_commande, o.id_promotion, p.type_promotion FROM stg_commandes o
       LEFT JOIN mrt_dim_promotions p ON p.id_promotion = 'PROM' || substr(o.id_promotion, 2)""",
)
def left_computed(data: Data):
    offers = data("mrt_dim_promotions").select(F.col("id_promotion").alias("_offer"), "type_promotion")
    code = F.concat(F.lit("PROM"), F.substring("id_promotion", 2, 1000))
    orders = data("stg_commandes").select("id_commande", "id_promotion", code.alias("_offer"))
    return orders.join(offers, "_offer", "left").drop("_offer")


@query(
    "join_cross_one_row",
    "SELECT id_produit, prix, moyenne FROM mrt_dim_produits, (SELECT round(avg(prix), 4) AS moyenne FROM mrt_dim_produits)",
)
def cross_one_row(data: Data):
    products = data("mrt_dim_produits").select("id_produit", "prix")
    mean = products.agg(F.round(F.avg("prix"), 4).alias("moyenne"))
    return products.crossJoin(F.broadcast(mean))


@query(
    "join_semi_having",
    """SELECT id_commande, id_client FROM mrt_fct_commandes WHERE id_client IN
       (SELECT id_client FROM mrt_fct_commandes GROUP BY id_client HAVING count(*) > 10)""",
)
def semi(data: Data):
    orders = data("mrt_fct_commandes").select("id_commande", "id_client")
    often = orders.groupBy("id_client").agg(rows().alias("n")).where(F.col("n") > 10)
    return orders.join(often, "id_client", "left_semi")


@query(
    "join_explode_list",
    "SELECT id_client, trim(unnest(string_split(favoris, ','))) AS favori FROM stg_clients",
)
def explode_list(data: Data):
    listed = data("stg_clients").select("id_client", F.explode(F.split("favoris", ",")).alias("favori"))
    return listed.select("id_client", F.trim("favori").alias("favori"))


@query(
    "join_date_dimension",
    """SELECT jour_semaine, annee, count(*) AS commandes FROM mrt_fct_commandes
       JOIN mrt_dim_dates ON date_jour = date_commande GROUP BY ALL""",
)
def date_dimension(data: Data):
    per_day = data("mrt_fct_commandes").groupBy(F.col("date_commande").alias("date_jour")).agg(rows().alias("n"))
    named = per_day.join(data("mrt_dim_dates").select("date_jour", "jour_semaine", "annee"), "date_jour")
    return named.groupBy("jour_semaine", "annee").agg(F.sum("n").alias("commandes"))


@query(
    "join_inline_table",
    """SELECT ['Lundi', 'Mardi', 'Mercredi', 'Jeudi', 'Vendredi', 'Samedi', 'Dimanche'][isodow(date_commande)] AS jour_fr,
       count(*) AS commandes FROM stg_commandes GROUP BY ALL""",
)
def inline_table(data: Data):
    """Orders per day name, translated through a seven-row literal table."""
    names = data.spark.createDataFrame(list(zip(labels.DAYS_EN, labels.DAYS_FR)), "en string, jour_fr string")
    per_name = data("stg_commandes").groupBy(dates.day_name(F.col("date_commande")).alias("en")).agg(rows().alias("commandes"))
    return per_name.join(F.broadcast(names), "en").select("jour_fr", "commandes")


@query(
    "agg_group",
    """SELECT canal, year(date) AS annee, CAST(sum(budget) AS BIGINT) AS budget, count(*) AS n, count(evenement_oui_non) AS connus,
       round(avg(clics), 6) AS clics FROM mrt_fct_campagnes GROUP BY ALL""",
)
def agg_group(data: Data):
    return data("mrt_fct_campagnes").groupBy("canal", F.year("date").cast("bigint").alias("annee")).agg(
        F.sum("budget").alias("budget"),
        rows().alias("n"),
        F.count("evenement_oui_non").alias("connus"),
        F.round(F.avg("clics"), 6).alias("clics"),
    )


@query(
    "agg_global",
    "SELECT count(*) AS n, CAST(sum(quantite) AS BIGINT) AS quantite, min(date_commande) AS debut, max(date_commande) AS fin FROM mrt_fct_commandes",
)
def agg_global(data: Data):
    return data("mrt_fct_commandes").agg(
        rows().alias("n"),
        F.sum("quantite").alias("quantite"),
        F.min("date_commande").alias("debut"),
        F.max("date_commande").alias("fin"),
    )


@query(
    "agg_conditional_sum",
    """SELECT date_post, CAST(coalesce(sum(volume_mentions) FILTER (lower(canal_social) = 'twitter'), 0) AS BIGINT) AS twitter,
       CAST(coalesce(sum(volume_mentions) FILTER (lower(canal_social) = 'tiktok'), 0) AS BIGINT) AS tiktok
       FROM mrt_fct_posts GROUP BY ALL""",
)
def conditional_sum(data: Data):
    def mentions(channel: str):
        hit = F.lower("canal_social") == channel
        return F.sum(F.when(hit, F.col("volume_mentions")).otherwise(F.lit(0).cast("bigint"))).alias(channel)

    return data("mrt_fct_posts").groupBy("date_post").agg(mentions("twitter"), mentions("tiktok"))


@query(
    "agg_count_if",
    """SELECT id_entrepot_depart, count(*) FILTER (statut_commande <> 'Annulée') AS viables,
       count(*) FILTER (statut_commande = 'Annulée') AS annulees FROM stg_commandes GROUP BY ALL""",
)
def count_if(data: Data):
    status = F.col("statut_commande")
    return data("stg_commandes").groupBy("id_entrepot_depart").agg(
        F.count_if(status != labels.CANCELLED).alias("viables"), F.count_if(status == labels.CANCELLED).alias("annulees")
    )


@query(
    "agg_count_distinct",
    "SELECT id_produit, count(DISTINCT id_client) AS clients FROM mrt_fct_commandes GROUP BY ALL",
)
def count_distinct(data: Data):
    return data("mrt_fct_commandes").groupBy("id_produit").agg(F.count_distinct("id_client").alias("clients"))


@query(
    "agg_lower_median",
    """SELECT canal_social, quantile_disc(volume_mentions, 0.5) AS mediane, (SELECT quantile_disc(prix, 0.5) FROM stg_produits)
       AS prix_median FROM mrt_fct_posts GROUP BY ALL""",
)
def lower_medians(data: Data):
    mentions = lower_median(data("mrt_fct_posts"), {"volume_mentions": "mediane"}, ["canal_social"])
    return mentions.crossJoin(F.broadcast(lower_median(data("stg_produits"), {"prix": "prix_median"})))


@query(
    "agg_interpolated_median",
    """SELECT (SELECT quantile_cont(temps_arret, 0.5) FROM mrt_fct_machines) AS arret,
       (SELECT quantile_cont(l_extendedprice, 0.5) FROM lineitem) AS prix""",
)
def middle(data: Data):
    stops = interpolated_median(data("mrt_fct_machines"), "temps_arret", "arret")
    return stops.crossJoin(F.broadcast(interpolated_median(data.table("lineitem"), "l_extendedprice", "prix")))


@query(
    "agg_stddev",
    "SELECT type_machine, round(stddev_samp(volume_traite), 6) AS ecart, round(avg(volume_traite), 6) AS moyenne FROM mrt_fct_machines GROUP BY ALL",
)
def spread(data: Data):
    return data("mrt_fct_machines").groupBy("type_machine").agg(
        F.round(F.stddev_samp("volume_traite"), 6).alias("ecart"), F.round(F.avg("volume_traite"), 6).alias("moyenne")
    )


@query(
    "agg_having",
    "SELECT id_produit, count(*) AS n, CAST(sum(quantite) AS BIGINT) AS q FROM mrt_fct_commandes GROUP BY id_produit HAVING sum(quantite) >= 200",
)
def having(data: Data):
    sums = data("mrt_fct_commandes").groupBy("id_produit").agg(rows().alias("n"), F.sum("quantite").alias("q"))
    return sums.where(F.col("q") >= 200)


@query("agg_distinct_groups", "SELECT DISTINCT id_client, id_produit FROM mrt_fct_commandes")
def distinct_groups(data: Data):
    return data("mrt_fct_commandes").select("id_client", "id_produit").distinct()


@query(
    "agg_ratio",
    f"""SELECT id_entrepot_depart, {near("100.0 * count(*) FILTER (statut_commande = 'Annulée') / count(*)", 4)} AS part_annulee
       FROM stg_commandes GROUP BY ALL""",
)
def ratio(data: Data):
    share = F.count_if(F.col("statut_commande") == labels.CANCELLED) * F.lit(100.0) / rows()
    rounded = F.round(share.cast("decimal(28,10)"), 4).cast("double")
    return data("stg_commandes").groupBy("id_entrepot_depart").agg(rounded.alias("part_annulee"))


@query(
    "agg_two_level",
    """SELECT mois, max(n) AS pointe, round(avg(n), 6) AS moyenne FROM (SELECT date_commande, strftime(date_commande, '%Y-%m') AS mois,
       count(*) AS n FROM stg_commandes GROUP BY ALL) GROUP BY mois""",
)
def two_level(data: Data):
    daily = data("stg_commandes").groupBy("date_commande").agg(rows().alias("n"))
    return daily.groupBy(dates.month_key(F.col("date_commande")).alias("mois")).agg(
        F.max("n").alias("pointe"), F.round(F.avg("n"), 6).alias("moyenne")
    )


@query(
    "window_rank_partition",
    "SELECT id_produit, categorie, prix, rank() OVER (PARTITION BY categorie ORDER BY prix DESC) AS rang FROM stg_produits",
)
def rank_partition(data: Data):
    return global_rank(data("stg_produits").select("id_produit", "categorie", "prix"), "prix", "rang", ["categorie"])


@query("window_rank_global", "SELECT id_client, n, rank() OVER (ORDER BY n DESC) AS rang FROM (SELECT id_client, count(*) AS n FROM stg_commandes GROUP BY ALL)")
def rank_global(data: Data):
    return global_rank(data("stg_commandes").groupBy("id_client").agg(rows().alias("n")), "n", "rang")


@query(
    "window_rank_over_aggregate",
    """SELECT type_machine, annee_mois, CAST(sum(volume_traite) AS BIGINT) AS v,
       rank() OVER (PARTITION BY type_machine ORDER BY sum(volume_traite) DESC) AS rang FROM mrt_fct_machines
       GROUP BY type_machine, annee_mois""",
)
def rank_over_aggregate(data: Data):
    monthly = data("mrt_fct_machines").groupBy("type_machine", "annee_mois").agg(F.sum("volume_traite").alias("v"))
    best = Window.partitionBy("type_machine").orderBy(F.desc("v"))  # one row per month
    return monthly.withColumn("rang", F.rank().over(best).cast("bigint"))


@query(
    "window_top_k",
    """SELECT id_entrepot_depart, id_commande, montant FROM (SELECT id_entrepot_depart, id_commande,
       montant_commande_apres_promotion AS montant, rank() OVER (PARTITION BY id_entrepot_depart
       ORDER BY montant_commande_apres_promotion DESC NULLS LAST) AS r FROM mrt_fct_commandes) WHERE r <= 10""",
)
def top_k(data: Data):
    """Ten best orders per warehouse: Spark keeps ten per group and task before the shuffle."""
    orders = data("mrt_fct_commandes").select("id_entrepot_depart", "id_commande", F.col(PAID).alias("montant"))
    best = Window.partitionBy("id_entrepot_depart").orderBy(F.desc_nulls_last("montant"))
    return orders.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= 10).drop("_rank")


@query(
    "top_n_per_sentiment",
    f"""SELECT sentiment, mots_cles, n FROM (SELECT sentiment, mots_cles, count(*) AS n FROM ({COMMENTS}) GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, mots_cles) <= 10""",
)
def top_n(data: Data):
    words = data("performance_commentaire").groupBy("sentiment", "mots_cles").agg(rows().alias("n"))
    best = Window.partitionBy("sentiment").orderBy(F.desc("n"), "mots_cles")  # at most fifteen words each
    return words.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= 10).drop("_place")


@query(
    "sort_two_keys",
    "SELECT mois_commande, id_entrepot_depart, count(*) AS n FROM delais GROUP BY ALL ORDER BY mois_commande, n DESC",
)
def sort_two(data: Data):
    counts = data("mrt_fct_commandes").groupBy(
        dates.month_key(F.col("date_commande")).alias("mois_commande"), "id_entrepot_depart"
    ).agg(rows().alias("n"))
    return counts.orderBy(F.asc_nulls_first("mois_commande"), F.desc_nulls_last("n"))


@query(
    "append_rows",
    "SELECT id_commande AS id, date_commande AS jour FROM stg_commandes UNION ALL SELECT id_post, date_post FROM stg_posts",
)
def append(data: Data):
    orders = data("stg_commandes").select(F.col("id_commande").alias("id"), F.col("date_commande").alias("jour"))
    posts = data("stg_posts").select(F.col("id_post").alias("id"), F.col("date_post").alias("jour"))
    return orders.unionByName(posts)


_RAW_CHECKS = [
    Check("satisfaction", "note_client", NOT_NULL),
    Check("satisfaction", "plainte", NOT_NULL),
    Check("produits", "prix", NOT_NULL),
    Check("commandes", "statut_commande", NOT_NULL),
]


def _not_null_sql(model: str, column: str, source: str) -> str:
    return f"SELECT '{model}' AS model, '{column}' AS column, 'not_null' AS test, count(*) - count({column}) AS failures FROM {source}"


def _unique_sql(model: str, column: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column, 'unique' AS test, count(*) AS failures FROM "
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


@query("dq_not_null", " UNION ALL ".join(_not_null_sql(c.model, c.column, f"raw_{c.model}") for c in _RAW_CHECKS))
def check_not_null(data: Data):
    return run_checks(data.raw.__getitem__, _RAW_CHECKS)


_RAW_UNIQUE = [
    Check("details_commandes", "id_commande", UNIQUE),
    Check("commandes", "id_client", UNIQUE),
    Check("entrepots_machines", "id_machine", UNIQUE),
]


@query("dq_unique", " UNION ALL ".join(_unique_sql(c.model, c.column, f"raw_{c.model}") for c in _RAW_UNIQUE))
def check_unique(data: Data):
    return run_checks(data.raw.__getitem__, _RAW_UNIQUE)


def _report_sql() -> str:
    from emporia.plans.checks import STAGING_CHECKS

    make = {NOT_NULL: _not_null_sql, UNIQUE: _unique_sql}
    return " UNION ALL ".join(make[c.test](c.model, c.column, c.model) for c in STAGING_CHECKS)


@query("dq_report", _report_sql())
def report(data: Data):
    return run_checks(data)
