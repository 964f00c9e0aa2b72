"""Text standardisers. Every function takes a Column and gives a Column."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters that are folded in store names and in categories.
NAME_ACCENTS = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇáàãâäéèêëíìîïóòõôöúùûüç"
CATEGORY_ACCENTS = "ÁÀÂÃÉÊÍÓÔÕÚÇáàâãéêíóôõúç"

# Keyword, standard category, category group. The first keyword found wins.
CATEGORY_RULES = [
    ("MED", "Medicamento", "Saude e Higiene"),
    ("PETISC", "Petisco", "Alimentacao"),
    ("RA", "Racao", "Alimentacao"),
    ("HIG", "Higiene", "Saude e Higiene"),
    ("BRINQ", "Brinquedo", "Bem-estar"),
    ("ACESS", "Acessorio", "Bem-estar"),
    ("SERV", "Servico", "Bem-estar"),
]

# Keyword, standard channel. The first keyword found wins.
CHANNEL_RULES = [
    ("WHATS", "WhatsApp"),
    ("APP", "App"),
    ("SITE", "Site"),
    ("LOJA", "Loja Fisica"),
    ("TEL", "Telefone"),
]

# Standard discount flag and its spellings in upper case.
DISCOUNT_VALUES = {
    "Sim": ["S", "SIM", "1", "X", "TRUE", "V"],
    "Nao": ["N", "NAO", "0", "FALSE", "F"],
}


def fold(col: Column, accents: str = NAME_ACCENTS) -> Column:
    """Replace each letter of ``accents`` by its base letter."""
    plain = "".join(unicodedata.normalize("NFD", letter)[0] for letter in accents)
    return F.translate(col, accents, plain)


def blank_to_null(col: Column) -> Column:
    """NULL for text that is empty or only blanks, else the trimmed text."""
    return F.nullif(F.trim(col), F.lit(""))


def is_blank(col: Column) -> Column:
    """True for NULL, empty and all-blank text."""
    return blank_to_null(col).isNull()


def upper_trimmed(col: Column, accents: str = "") -> Column:
    """Trimmed upper case; with ``accents`` given, also folded."""
    text = F.upper(F.trim(col))
    return fold(text, accents) if accents else text


def category_key(col: Column) -> Column:
    """The form of a category spelling that the keyword rules look at."""
    return F.upper(fold(col, CATEGORY_ACCENTS))


def classify(col: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Label of the first ``(keyword, label)`` whose keyword occurs in ``col``."""
    label = F.lit(default)
    for keyword, name in reversed(rules):
        label = F.when(F.contains(col, F.lit(keyword)), F.lit(name)).otherwise(label)
    return label


def map_values(col: Column, values: Mapping[str, Sequence[str]], default: str | None) -> Column:
    """Label whose list of exact values holds ``col``."""
    label = F.lit(default)
    for name, spellings in values.items():
        label = F.when(col.isin(*spellings), F.lit(name)).otherwise(label)
    return label


def standard_category(key: Column, default: str) -> Column:
    return classify(key, [(word, name) for word, name, _ in CATEGORY_RULES], default)


def category_group(key: Column, default: str) -> Column:
    return classify(key, [(word, group) for word, _, group in CATEGORY_RULES], default)


def name_key(col: Column, drop: Sequence[str] = ("/SC",), accents: str = NAME_ACCENTS) -> Column:
    """Lookup form of a store name.

    Suffixes go first, as spelled (so ``/sc`` stays); then one pass turns double
    blanks into single ones; then trim, fold and upper case.
    """
    for suffix in drop:
        col = F.replace(col, F.lit(suffix), F.lit(""))
    col = F.replace(col, F.lit("  "), F.lit(" "))
    return F.upper(fold(F.trim(col), accents))
