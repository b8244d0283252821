"""Text values that the data carries or that reports show. All are fixed values."""

from __future__ import annotations

# Flags and states found in the source tables.
CANCELLED = "Annulée"
BROKEN_DOWN = "En panne"
YES_NO_EN = ("Yes", "No")
YES_NO_FR = ("Oui", "Non")
PERCENT_OFF = "Pourcentage"
AMOUNT_OFF = "Remise fixe"
SENTIMENTS = {"neutres": "Neutre", "positives": "Positif", "negatives": "Négatif"}
CHANNELS = ("instagram", "twitter", "tiktok", "facebook", "linkedin")

# Replacements for blank product attributes.
UNKNOWN_BRAND = "Divers"
UNKNOWN_VARIATION = "Variation inconnue"

# Age bands, upper bound included; the last label also takes a missing age.
AGE_LIMITS = (24, 40, 60)
AGE_LABELS = ("Moins de 25 ans", "25–40 ans", "41–60 ans", "Plus de 60 ans")
AGE_CODES = ("moins_25", "entre_25_40", "entre_41_60", "plus_60")

# Quadrant labels as (high/high, high volume, high value, low/low).
CATEGORY_SEGMENTS = ("Star", "Populaire peu rentable", "Premium discret", "Faible")
PRODUCT_SEGMENTS = ("Star", "Populaire peu rentable", "Premium peu vendu", "Flop")
TOP_SEGMENT = "Vraie Star"

# Deviation labels.
PEAK, DIP, NORMAL = "pic", "creux", "normal"
RICH_WEEK, PLAIN_WEEK = "Semaine lucrative", "Semaine normale"

# Day names, Monday first.
DAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
DAYS_FR = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")

# Phrase contained in a lower-cased comment -> keyword; the first match wins.
COMMENT_PHRASES = (
    ("better", "passable"),
    ("excellent product", "excellent"),
    ("fast delivery", "efficient"),
    ("good product", "satisfying"),
    ("average product", "average"),
    ("below average", "poor"),
    ("delivery took too long", "slow"),
    ("not satisfied", "unsatisfied"),
    ("terrible experience", "terrible"),
    ("great quality", "great"),
    ("okay", "bof"),
    ("product arrived damaged", "damaged"),
    ("perfect experience", "perfect"),
    ("satisfied with the experience", "satisfied"),
)
COMMENT_DEFAULT = "bad"

# Whole lower-cased comment -> keyword.
COMMENT_SENTENCES = (
    ("could be better.", "mediocre"),
    ("excellent product highly recommend!", "excellent"),
    ("fast delivery and good service.", "efficient"),
    ("good product, happy with the purchase", "satisfying"),
    ("average product, nothing special", "average"),
    ("below average quality.", "poor"),
    ("delivery took too long.", "slow"),
    ("not satisfied with the service.", "unsatisfied"),
    ("terrible experience, will not buy again.", "terrible"),
    ("great quality and service!", "great"),
    ("it was okay, not great.", "bof"),
    ("the product arrived damaged.", "damaged"),
    ("perfect experience, very happy!", "perfect"),
    ("satisfied with the experience.", "satisfied"),
)
# Keyword for a comment without a known sentence, by note.
NOTE_KEYWORDS = {5: "perfect", 3: "mediocre"}
