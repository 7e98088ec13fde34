"""Name cleaning and name-based rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nulls import as_col

# Accented Latin letters and their plain forms, position by position.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy"
# Letters that expand to two.
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss"}

# Name patterns that mark a closed facility.
CLOSED_UPPER = "CLOTUR|FERM(E|EE)?"
CLOSED_ANY_CASE = "(?i)cloture|ferme"

# Facility type by name prefix, first match wins.
FACILITY_TYPES = [
    (r"^HD\b", "HD (hôpital de district)"),
    (r"^CSI\b", "CSI (centre de santé intégré)"),
    (r"^CS\b", "CS (case de santé)"),
    (r"^(SS\b|SALLE\b|SALLE D'ACCOUCHEMENT\b)", "SS / Salle (soins/maternité)"),
    (r"^(CLINIQUE|POLYCLINIQUE)\b", "Clinique (privé)"),
    (r"^CABINET\b", "Cabinet (privé)"),
    (r"^(INFIRMERIE|INFIRM)\b", "Infirmerie (privé)"),
    (r"^CNSS\b", "CNSS"),
]
OTHER_TYPE = "Autre"


def ascii_fold(c: Column | str) -> Column:
    c = F.translate(as_col(c), ACCENTED, PLAIN)
    for letter, plain in LIGATURES.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def normalise_name(c: Column | str) -> Column:
    """Plain upper-case words separated by single spaces."""
    return F.trim(F.regexp_replace(F.upper(ascii_fold(c)), "[^A-Z0-9]+", " "))


def normalise_name_columns(df: DataFrame, suffix: str = "_NAME") -> DataFrame:
    return df.withColumns({c: normalise_name(c) for c in df.columns if c.upper().endswith(suffix)})


def clean_columns(df: DataFrame) -> DataFrame:
    """Column names in upper case, with runs of other characters turned into an underscore."""
    return df.toDF(*[re.sub(r"[^0-9A-Za-z]", "_", c.strip()).upper() for c in df.columns])


def title_case(c: Column | str) -> Column:
    return F.initcap(F.lower(as_col(c)))


def strip_country_prefix(c: Column | str, level_word: str) -> Column:
    """Drop a leading two-letter country mark and the level word (PROVINCE, ZONE DE SANTE)."""
    return F.trim(F.regexp_replace(as_col(c), f"^[A-Z]{{2}}| {level_word}", ""))


def short_admin_name(c: Column | str, drop_word: str = "province") -> Column:
    """Words of the name without `drop_word` and without the first remaining word; '' when none is left."""
    words = F.filter(F.split(as_col(c), " "), lambda w: F.upper(w) != drop_word.upper())
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_join(rest, " ")


def facility_type(name: Column | str) -> Column:
    name = F.upper(F.trim(F.regexp_replace(as_col(name), r"\s+", " ")))
    out = F.lit(OTHER_TYPE)
    for pattern, label in reversed(FACILITY_TYPES):
        out = F.when(name.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def name_is_closed(name: Column | str) -> Column:
    return F.upper(as_col(name)).rlike(CLOSED_UPPER)


def hashed_id(*cols: Column | str, length: int = 11) -> Column:
    """Stable id from names: a prefix of SHA-256, so it does not depend on the engine."""
    return F.substring(F.sha2(F.concat_ws("|", *[as_col(c) for c in cols]), 256), 1, length)
