"""Text normalisation (SC-05, SC-06, SC-15) as native Column expressions.

Spark 4.1 has no Unicode normalisation function, so the native accent
stripper removes combining marks and maps the precomposed Latin, Greek and
Cyrillic letters to their base letter, by a table derived from the Unicode
data; ``normalize_text_exact`` is an Arrow ``pandas_udf`` running NFD /
combining-mark removal / NFKC / casefold for any script.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _base_letters() -> dict[str, str]:
    """Precomposed letters of the blocks up to Greek Extended with the letter
    that is left when their marks go."""
    out = {}
    for code in (*range(0xC0, 0x530), *range(0x1E00, 0x2000)):
        parts = unicodedata.normalize("NFD", chr(code))
        base = "".join(c for c in parts if not unicodedata.combining(c))
        if len(parts) > 1 and len(base) == 1 and base.isalpha():
            out[chr(code)] = base
    return out


_BASE = _base_letters()
ACCENTED, UNACCENTED = "".join(_BASE), "".join(_BASE.values())
# Punctuation removed inside words before splitting.
INFIX_QUOTES = "['‘’]"
# Any run of characters that are not letters, digits or underscore.
NON_WORD = r"[^\p{L}\p{N}_]+"


def remove_accents(c: Column) -> Column:
    """SC-05 (native form)."""
    return F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"\p{M}+", "")


def normalize_text(c: Column) -> Column:
    """SC-06: accents off, casefold, drop quotes, non-word runs -> one space."""
    folded = F.replace(F.lower(remove_accents(c)), F.lit("ß"), F.lit("ss"))
    return F.regexp_replace(F.regexp_replace(folded, INFIX_QUOTES, ""), NON_WORD, " ")


def _exact(text: str | None) -> str | None:
    if text is None:
        return None
    s = "".join(ch for ch in unicodedata.normalize("NFD", text) if not unicodedata.combining(ch))
    s = unicodedata.normalize("NFKC", s).casefold()
    return s


@F.pandas_udf(T.StringType())
def _fold_exact(s: pd.Series) -> pd.Series:
    return s.map(_exact)


def normalize_text_exact(c: Column) -> Column:
    """SC-06 with exact Unicode folding (Arrow-batched Python)."""
    return F.regexp_replace(F.regexp_replace(_fold_exact(c), INFIX_QUOTES, ""), NON_WORD, " ")


def clean_string(c: Column) -> Column:
    """SC-15: collapse whitespace, trim; null -> ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def normalized_lines(text: Column) -> Column:
    """Array of (pos, unit) for the non-empty normalised lines of ``text``."""
    return F.filter(
        F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("pos"), F.trim(normalize_text(line)).alias("unit"))),
        lambda x: x["unit"] != "",
    )
