"""Column helpers where Spark's default differs from the warehouse semantics the models need.

Everything else is used straight from ``pyspark.sql.functions``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emporia.functions import labels

CENTS = 100


def at_least(value: Column, floor: float) -> Column:
    """Larger of the two, NULL when the value is NULL (``greatest`` would return the floor)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor).cast("double")))


def round_money(amount: Column) -> Column:
    """Two decimals, half away from zero, decided once on the decimal value and not on the binary double."""
    return F.round(amount.cast("decimal(38,10)"), 2).cast("double")


def gross_amount(quantity: Column, price: Column) -> Column:
    """Exact decimal product of whole units and a price of up to four decimals."""
    return price.cast("decimal(13,4)") * quantity.cast("decimal(10,0)")


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero on its decimal text."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def cents(amount: Column) -> Column:
    """Two-decimal amount as whole cents.

    Sums of cents do not depend on row order or on task retries, and their buffer is a fixed-width long that
    hash aggregation updates in place.
    """
    return F.round(amount * CENTS).cast("bigint")


def from_cents(total: Column) -> Column:
    return total / F.lit(float(CENTS))


def sum_money(amount: Column) -> Column:
    """Exact sum of two-decimal amounts within a group."""
    return from_cents(F.sum(cents(amount)))


def sum_exact(amount: Column) -> Column:
    """Exact decimal sum, for unrounded products and for totals over the whole table."""
    return F.sum(amount.cast("decimal(18,4)"))


def strip(text: Column) -> Column:
    """Trim every kind of white space (``trim`` removes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"\S")


def fill_blank(text: Column, default: Column) -> Column:
    return F.when(is_blank(text), default).otherwise(text)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """Regular expression group, NULL when nothing matches (Spark returns an empty string)."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def promotion_value(kind: Column, text: Column) -> Column:
    """Numeric promotion value: ``10%`` -> 0.10, ``5,50 €`` -> 5.50, NULL when it does not parse."""
    percent = F.replace(text, F.lit("%"), F.lit("")).try_cast("double") / F.lit(100.0)
    digits = F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), r"[^\d.]", "")
    return F.when(kind == labels.PERCENT_OFF, percent).when(
        kind == labels.AMOUNT_OFF, digits.try_cast("double")
    )


def amount_due(gross: Column, kind: Column, value: Column) -> Column:
    """Amount after the promotion: fixed reduction or share of the gross amount, never below zero.

    All steps are decimal, so the only rounding is the one to cents.
    """
    exact = gross.cast("decimal(24,4)")
    rest = F.lit(1).cast("decimal(1,0)") - value.cast("decimal(9,6)")
    return (
        F.when(kind == labels.AMOUNT_OFF, at_least(round_money(exact - value.cast("decimal(13,4)")), 0.0))
        .when(kind == labels.PERCENT_OFF, at_least(round_money(exact * rest), 0.0))
        .otherwise(round_money(exact))
    )


def age_band(age: Column, names: tuple[str, ...] = labels.AGE_LABELS) -> Column:
    """Age band label; a missing age falls in the last band."""
    band = None
    for limit, name in zip(labels.AGE_LIMITS, names):
        band = F.when(age <= limit, name) if band is None else band.when(age <= limit, name)
    return band.otherwise(names[-1])


def note_sentiment(note: Column) -> Column:
    return F.when(note >= 3, "positif").when(note <= 2, "negatif").otherwise("neutre")


def keyword(text: Column, rules, *, whole: bool = False, default: str | None = None) -> Column:
    """First rule whose phrase is contained in (or equals) the lower-cased text."""
    lowered = F.lower(text)
    picked = None
    for phrase, word in rules:
        hit = lowered == phrase if whole else lowered.contains(phrase)
        picked = F.when(hit, word) if picked is None else picked.when(hit, word)
    return picked.otherwise(F.lit(default))


def product_code(text: Column) -> Column:
    """``P`` and five digits from a loosely written product id, NULL without digits."""
    return F.concat(F.lit("P"), F.lpad(extract(strip(text), r"P?(\d+)"), 5, "0"))
