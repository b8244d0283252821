"""Source tables: declared schemas, typed scans, presence checks and the replacing sink."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.cleaning import ACCENTED, PLAIN, POSITION, clean_column_names
from emporia.sources.store import Layout, Store, is_store

# Declared raw schemas, after column names were cleaned. Dates may still be text.
SCHEMAS: dict[str, str] = {
    "campagnes": "id_campagne string, date date, evenement_oui_non string, evenement_type string, canal string, "
    "budget double, impressions double, clics double, conversions double, ctr double",
    "clients": "id_client string, age double, genre string, frequence_visites double, date_inscription date, "
    "favoris string",
    "commandes": "id_commande string, id_client string, id_entrepot_depart string, date_commande date, "
    "statut_commande string, id_promotion_appliquee string, mode_de_paiement string, numero_tracking string, "
    "date_livraison_estimee date",
    "details_commandes": "id_commande string, id_produit string, quantite double, emballage_special string",
    "entrepots": "id_entrepot string, localisation string, capacite_max double, volume_stocke double, "
    "taux_remplissage double, temperature_moyenne_entrepot double",
    "entrepots_machines": "id string, id_machine string, id_entrepot string, type_machine string, "
    "etat_machine string, temps_darret double, volume_traite double, mois string",
    "posts": "id_post string, date_post date, canal_social string, volume_mentions double, "
    "sentiment_global string, contenu_post string",
    "produits": "id string, categorie string, marque string, produit string, prix double, sous_categorie string, "
    "variation string",
    "promotions": "id_promotion string, id_produit string, type_promotion string, valeur_promotion string, "
    "date_debut date, date_fin date, responsable_promotion string",
    "satisfaction": "id_satisfaction string, id_commande string, note_client double, commentaire string, "
    "plainte string, temps_reponse_support double, type_plainte string, employe_support string",
}


#: Name of the only table in the store that a replaced table is.
CONTENT = "content"


def schema_of(name: str) -> T.StructType:
    return T._parse_datatype_string(SCHEMAS[name])  # type: ignore[return-value]


def _positioned(df: DataFrame) -> DataFrame:
    """Rows with their place: file, block of the file and row within the task, which grows along a block."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.withColumn(POSITION, place)


def _typed(value: Column, name: str, kind: T.DataType) -> Column:
    """Text as ``kind``: blank is missing, and a value that does not parse is an error in any session."""
    if isinstance(kind, T.StringType):
        return value
    text = F.nullif(F.trim(value), F.lit(""))
    made = text.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{name} is not a {kind.simpleString()}: "), text))
    return F.when(text.isNotNull() & made.isNull(), wrong).otherwise(made)


def _clean_key(name: Column) -> Column:
    """The same names as :func:`emporia.operators.cleaning.clean_name`."""
    words = F.regexp_replace(F.lower(F.translate(name, ACCENTED, PLAIN)), "[ -]+", "_")
    # the characters that are left without the plain ones go; a regular expression takes several times as long
    others = F.translate(words, "abcdefghijklmnopqrstuvwxyz0123456789_", "")
    return F.call_function("translate", words, others, F.lit(""))


_BROKEN = "_broken_record"
_FAULT, _TEXT = "_fault", "_text"


def _odd_quotes(spark: SparkSession, path: str) -> DataFrame:
    """``_file`` of the CSV files with an odd number of quotes: one of them never closes, or stands alone."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select("_metadata.file_path", quotes.alias("quotes"))
    counted = lines.groupBy(F.col("file_path").alias("_file")).agg(F.sum("quotes").alias("quotes"))
    return counted.where(F.col("quotes") % 2 == 1).select("_file")


def _csv_texts(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """Every record as text columns, with what is wrong with it in ``_fault`` and its text in ``_text``.

    Records may run over several lines, so a file is read by one task. A record is wrong when it has fewer or more
    values than the header, when a value begins with a quote that the record does not close, and when it runs over
    several lines in a file where some quote never closes: there it may have swallowed others.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False}
    header = spark.read.csv(path, **options).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _BROKEN]])
    # with column pruning the number of values would not be compared
    whole = spark.read.schema(schema).option("columnPruning", False).option("columnNameOfCorruptRecord", _BROKEN)
    df = _positioned(whole.csv(path, mode="PERMISSIVE", **options))
    names = clean_column_names(df.select(*[f"`{c}`" for c in header])).columns
    df = df.toDF(*names, _BROKEN, POSITION)
    quote, no = F.lit('"'), F.lit(False)
    values = [F.col(c) for c in names]
    single = [
        F.coalesce(v.startswith('"') & (~v.endswith('"') | ((F.length(v) - F.length(F.replace(v, quote))) % 2 == 1)), no)
        for v in values
    ]
    broken_lines = reduce(Column.__or__, [F.coalesce(v.rlike("[\\r\\n]"), no) for v in values])
    open_quotes = _odd_quotes(spark, path)
    df = df.join(open_quotes, df[POSITION]["file_path"] == open_quotes["_file"], "left")
    fault = (
        F.when(F.col(_BROKEN).isNotNull(), F.lit("the number of values is not that of the header"))
        .when(reduce(Column.__or__, single), F.lit("a quote inside a value"))
        .when(F.col("_file").isNotNull() & broken_lines, F.lit("several lines in a file with an open quote"))
    )
    text = F.coalesce(_BROKEN, F.concat_ws(",", *[F.coalesce(v, F.lit("")) for v in values]))
    return df.withColumns({_FAULT: fault, _TEXT: text}), {name: F.col(name) for name in names}, names


def _once(df: DataFrame, **made: Column) -> DataFrame:
    """``df`` with further columns that are computed once a row, however many columns and filters use them.

    The optimiser would put an expression in the place of each use of its column; it does not carry one over a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in made.items()]))))


def _spellings(held: DataFrame, wanted: list[str]) -> tuple[list[str], dict[str, str]]:
    """Which of the wanted names the maps ``_held`` have, all where there is no map; and up to two ways to write each."""
    keys = held.select(F.explode_outer(F.map_keys("_held")).alias("key")).distinct()
    name = _clean_key(F.col("key"))
    met = keys.groupBy(F.when(name.isin(wanted), name).alias("name")).agg(F.min("key").alias("a"), F.max("key").alias("b"))
    rows = met.collect()  # a row for each wanted name, and one for all others
    here = {r["name"] for r in rows}
    spelled = {key: r["name"] for r in rows if r["name"] is not None for key in (r["a"], r["b"])}
    return [c for c in wanted if c in here or not rows], spelled


def _clean_known(key: Column, spelled: dict[str, str]) -> Column:
    """The cleaned key; the ones in ``spelled`` are known."""
    cases = [F.when(key == raw, F.lit(name)) for raw, name in spelled.items()]
    return F.coalesce(*cases, _clean_key(key))


def _json_texts(
    spark: SparkSession, path: str, wanted: list[str]
) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """Every line as a map from cleaned names to text; one pass finds which of the wanted names occur.

    A line that is no JSON object is wrong.
    """
    lines = _positioned(spark.read.text(path)).where(F.trim("value") != "")
    # as the only element of a list, because what follows a whole object would be passed over
    read = _once(lines, _listed=F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]"))))
    listed, opened = F.col("_listed"), F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    one = listed.isNotNull() & opened & F.try_variant_get(listed, "$[1]", "variant").isNull()
    whole = _once(read, _whole=one)
    held = _once(whole, _held=F.when(F.col("_whole"), F.from_json("value", "map<string,string>")))
    found, spelled = _spellings(held.where(F.col("_held").isNotNull()), wanted)
    named = F.transform_keys("_held", lambda k, _: _clean_known(k, spelled))
    fault = F.when(~F.col("_whole"), F.lit("no whole JSON object"))
    df = _once(held, fields=named).select("fields", POSITION, fault.alias(_FAULT), F.col("value").alias(_TEXT))
    return df, {c: F.element_at("fields", F.lit(c)) for c in wanted}, found


def _records(spark: SparkSession, path: str, fmt: str, schema: str | None, optional: Iterable[str]):
    """Rows of text with their faults, and a typed column for each declared one."""
    if schema is None:
        raise ValueError(f"{fmt} source {path} needs a declared schema")
    path = _content(spark, path)
    declared = T._parse_datatype_string(schema)
    wanted = [f.name for f in declared]
    df, texts, found = _csv_texts(spark, path) if fmt == "csv" else _json_texts(spark, path, wanted)
    missing = [c for c in wanted if c not in found and c not in set(optional)]
    if missing:
        raise ValueError(f"{fmt} source {path} has no column {', '.join(missing)}")
    nothing = F.lit(None).cast("string")
    return df, [(f, texts[f.name] if f.name in found else nothing) for f in declared]


def _content(spark: SparkSession, path: str) -> str:
    """Where the rows of the table at ``path`` are now: a replaced table keeps them in a version."""
    if not is_store(spark, path):
        return path
    version = Store(spark, path).current()
    if version is None:
        raise ValueError(f"no complete table at {path}")
    return version.path(CONTENT)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, optional: Iterable[str] = ()
) -> DataFrame:
    """One typed scan with every row's place in the source.

    Text formats need a declared schema of cleaned names. Their columns are read as text under whatever names the
    files have, the names are cleaned, and the declared columns are cast. A declared column that no row has is an
    error unless it is ``optional``; so are, as soon as their rows are read, a value that does not parse and a broken
    record. :func:`read_records` sets such rows aside instead.
    """
    if fmt not in ("csv", "json"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return _positioned(reader.format(fmt).load(_content(spark, path)))
    df, columns = _records(spark, path, fmt, schema, optional)
    told = F.concat(F.lit("broken record, "), F.col(_FAULT), F.lit(": "), F.col(_TEXT))
    # a filter, because a column that nobody selects would not be computed
    sound = df.where(F.when(F.col(_FAULT).isNotNull(), F.raise_error(told)).otherwise(F.lit(True)))
    typed = [_typed(text, f.name, f.dataType).alias(f.name) for f, text in columns]
    return sound.select(*typed, POSITION)


def read_records(
    spark: SparkSession, path: str, fmt: str, schema: str, optional: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The typed rows that can be read, and those that cannot: ``file, fault, text``. Together they are all records.

    A record is set aside when it is broken (see :func:`read_table`) or when a value of it does not parse.
    """
    df, columns = _records(spark, path, fmt, schema, optional)
    faults = [F.col(_FAULT)]
    for f, text in columns:
        if not isinstance(f.dataType, T.StringType):
            held = F.nullif(F.trim(text), F.lit(""))
            wrong = held.isNotNull() & held.try_cast(f.dataType).isNull()
            faults.append(F.when(wrong, F.lit(f"{f.name} is not a {f.dataType.simpleString()}")))
    df = df.withColumn(_FAULT, F.coalesce(*faults))
    typed = [_typed(text, f.name, f.dataType).alias(f.name) for f, text in columns]
    sound = df.where(F.col(_FAULT).isNull()).select(*typed, POSITION)
    rejected = df.where(F.col(_FAULT).isNotNull())
    return sound, rejected.select(F.col(f"{POSITION}.file_path").alias("file"), F.col(_FAULT).alias("fault"), F.col(_TEXT).alias("text"))


def load_tables(
    spark: SparkSession, folder: str, names: list[str] | None = None, fmt: str = "parquet", suffix: str = ""
) -> dict[str, DataFrame]:
    """Scans for all named source tables below ``folder``; a missing one fails before anything is planned.

    Where the folder is a store, all scans are of its current version.
    """
    names = list(names or SCHEMAS)
    version = Store(spark, folder).current() if is_store(spark, folder) else None
    found: dict[str, DataFrame] = {}
    missing = []
    for name in names:
        path = version.path(name) if version is not None else f"{folder.rstrip('/')}/{name}{suffix}"
        try:
            found[name] = read_table(spark, path, fmt, SCHEMAS.get(name) if fmt in ("csv", "json") else None)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    if missing:
        raise ValueError(f"no data found for source tables: {', '.join(missing)}")
    return found


def replace_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write ``df`` as the whole new content of the table at ``path``, without the place of its rows.

    The table is a store of its own (:mod:`emporia.sources.store`): the new content counts when it is complete, a job
    that fails leaves the old one as it was, and readers at work keep theirs. :func:`read_table` reads it.
    """
    store = Store(df.sparkSession, path)
    with store.new_version() as version:
        version.write(CONTENT, df.drop(POSITION), Layout(tuple(partition_by or ())), fmt)
    store.clean()
