"""Hand-computed edge cases, mostly where two engines share a default that the models must not use."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporia.functions import dates, labels
from emporia.functions import semantics as sem
from emporia.operators.cleaning import clean_column_names, clean_name, in_order
from emporia.plans.staging import _flag
from emporia.plans.warehouse import Warehouse


def one(spark, value):
    return spark.range(1).select(value.alias("v")).first()["v"]


def text(value):
    return F.lit(value).cast("string")


def number(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    ("kind", "raw", "expected"),
    [
        ("Pourcentage", "10%", 0.1),
        ("Remise fixe", "5,50 €", 5.5),
        ("Pourcentage", "abc", None),
        ("Pourcentage", "10,5%", None),
        ("Cadeau", "x", None),
        ("Remise fixe", "", None),
        (None, "10%", None),
    ],
)
def test_promotion_value(spark, kind, raw, expected):
    assert one(spark, sem.promotion_value(text(kind), text(raw))) == expected


@pytest.mark.parametrize(
    ("gross", "kind", "value", "expected"),
    [
        (None, "Remise fixe", 5.0, None),
        (20.0, "Remise fixe", 20000.0, 0.0),
        (20.0, "Pourcentage", None, None),
        (20.0, "Pourcentage", 0.1, 18.0),
        (20.0, None, None, 20.0),
        (20.0, "Cadeau", None, 20.0),
        (1.005, None, None, 1.01),
        (14.35, "Pourcentage", 0.123, 12.58),
        (14.35, "Remise fixe", 1.7651, 12.58),
    ],
)
def test_amount_due(spark, gross, kind, value, expected):
    assert one(spark, sem.amount_due(number(gross), text(kind), number(value))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("12", "P00012"), (" P7 ", "P00007"), ("123456", "P12345"), ("sans", None), ("", None), (None, None)],
)
def test_product_code(spark, raw, expected):
    assert one(spark, sem.product_code(text(raw))) == expected


@pytest.mark.parametrize(
    ("age", "label", "code"),
    [
        (24, "Moins de 25 ans", "moins_25"),
        (25, "25–40 ans", "entre_25_40"),
        (40, "25–40 ans", "entre_25_40"),
        (41, "41–60 ans", "entre_41_60"),
        (60, "41–60 ans", "entre_41_60"),
        (61, "Plus de 60 ans", "plus_60"),
        (None, "Plus de 60 ans", "plus_60"),
    ],
)
def test_age_band(spark, age, label, code):
    value = F.lit(age).cast("bigint")
    assert one(spark, sem.age_band(value)) == label
    assert one(spark, sem.age_band(value, labels.AGE_CODES)) == code


@pytest.mark.parametrize(("value", "blank"), [(None, True), ("", True), (" \t\n", True), (" a ", False)])
def test_blank(spark, value, blank):
    assert one(spark, sem.is_blank(text(value))) is blank
    assert one(spark, sem.fill_blank(text(value), F.lit("x"))) == ("x" if blank else value)


def test_first_keyword_rule_wins(spark):
    word = sem.keyword(text("Could be BETTER, excellent product"), labels.COMMENT_PHRASES, default="bad")
    assert one(spark, word) == "passable"
    assert one(spark, sem.keyword(text("nothing"), labels.COMMENT_PHRASES, default="bad")) == "bad"
    assert one(spark, sem.keyword(text("nothing"), labels.COMMENT_SENTENCES, whole=True)) is None


@pytest.mark.parametrize(("note", "mood"), [(1, "negatif"), (2, "negatif"), (3, "positif"), (None, "neutre")])
def test_note_sentiment(spark, note, mood):
    assert one(spark, sem.note_sentiment(F.lit(note).cast("bigint"))) == mood


@pytest.mark.parametrize(("raw", "expected"), [("Yes", True), ("No", False), ("n/a", None), (None, None)])
def test_flag(spark, raw, expected):
    row = spark.range(1).select(text(raw).alias("v")).selectExpr(_flag("v", labels.YES_NO_EN)).first()
    assert row["v"] is expected


def test_calendar_numbers(spark):
    day = F.to_date(F.lit("2024-01-06"))
    assert one(spark, dates.sunday_week(day)) == 0
    assert one(spark, dates.sunday_week(F.to_date(F.lit("2024-01-07")))) == 1
    assert one(spark, dates.iso_week_label(F.to_date(F.lit("2024-12-30")))) == "2025-S01"
    sunday = F.to_date(F.lit("2024-01-07"))
    assert one(spark, dates.monday_weekday(sunday)) == 7
    assert one(spark, dates.day_name(sunday, labels.DAYS_FR)) == "Dimanche"
    assert one(spark, dates.day_name(sunday)) == "Sunday"


def test_weeks_agree_with_the_standard_library(spark):
    start = dt.date(1995, 1, 1)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    rows = spark.range(11_000).select(day.alias("d"), dates.sunday_week(day).alias("u"), dates.iso_week_label(day).alias("g"))
    for row in rows.collect():
        assert row["u"] == int(row["d"].strftime("%U")) and row["g"] == row["d"].strftime("%G-S%V")


def test_clean_names(spark):
    assert [clean_name(n) for n in ("Temps d'arrêt", "ID-Client", "Catégorie", "ÔÂÉ  x")] == [
        "temps_darret",
        "id_client",
        "categorie",
        "oae_x",
    ]
    with pytest.raises(ValueError, match="collide"):
        clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "A-b"]))


def test_staging_rounds_fractions(spark):
    clients = spark.createDataFrame(
        [("a", 12.5, "x", 1.4, "2024-01-01", None)],
        "id_client string, age double, genre string, frequence_visites double, date_inscription string, favoris string",
    )
    row = Warehouse(spark, {"clients": in_order(clients, "id_client")}).ref("stg_clients").first()
    assert (row["age"], row["frequence_visites"], row["date_inscription"]) == (13, 1, dt.date(2024, 1, 1))


def test_favourites_keep_entries_without_a_code(spark):
    clients = spark.createDataFrame(
        [("a", "P7, sans"), ("b", None), ("c", "")], "id_client string, favoris string"
    ).selectExpr("id_client", "1D AS age", "'x' AS genre", "1D AS frequence_visites", "'2024-01-01' AS date_inscription", "favoris")
    products = spark.createDataFrame(
        [("P00007", "c", "m", "lampe", 1.0, "s", "v")],
        "id string, categorie string, marque string, produit string, prix double, sous_categorie string, variation string",
    )
    rows = Warehouse(
        spark, {"clients": in_order(clients, "id_client"), "produits": in_order(products, "id")}
    ).ref("mrt_rel_produits_favoris").collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(
        [("a", "P00007", "lampe"), ("a", None, None), ("c", None, None)], key=str
    )


def test_date_dimension_default_span(spark):
    days = Warehouse(spark, {}).ref("mrt_dim_dates")
    first, last, rows = days.selectExpr("min(date_jour)", "max(date_jour)", "count(*)").first()
    assert (first, last, rows) == (dt.date(2019, 1, 1), dt.date(2025, 12, 30), 2556)
