"""Text functions as Catalyst expressions: accents, names, phonetic keys, page types, token estimates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles that are no part of a name.
TITLES = ("don", "dona", "dna", "d", "sr", "sra", "san", "santa", "sto", "sta", "fray", "frai", "padre", "presbitero", "br", "dr", "capitan", "teniente")
# Texts of failed transcriptions; the end of a line that refers to a folio.
FAILED = r"(?i)\[transcription failed|max retries reached|finish\s?reason[:.]"
FOLIO = r"(?i)\bf(ol)?\.?\s*[0-9]{1,4}\s*\|?\s*$"
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"
#: Phonetic folding in order; capitals hold sounds that a later step must not fold again.
FOLDS = (("ch", "C"), ("ll", "L"), ("qu?", "k"), ("c(?=[ei]|$)", "s"), ("g(?=[ei]|$)", "X"), ("c", "k"), ("[zx]", "s"), ("[vw]", "b"), ("j", "X"), ("y", "i"), ("h", ""), ("C", "c"), ("L", "i"), ("X", "x"), (r"(.)\1+", "$1"))


def strip_accents(text: Column) -> Column:
    """Lower case without the accents of Latin letters."""
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def squeezed(text: Column) -> Column:
    """Lower case, white space runs as one space, trimmed; null as empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def name_tokens(name: Column) -> Column:
    cleaned = F.regexp_replace(strip_accents(F.coalesce(name, F.lit(""))), r"[^a-z0-9\s]", " ")
    return F.filter(F.split(cleaned, r"\s+"), lambda t: (t != "") & ~t.isin(*TITLES))


def normalize_name(name: Column) -> Column:
    return F.array_join(name_tokens(name), " ")


def phonetic_fold(token: Column) -> Column:
    return reduce(lambda t, step: F.regexp_replace(t, *step), FOLDS, token)


def phonetic_key(name: Column) -> Column:
    """The folded first token of a name, or an empty string."""
    return phonetic_fold(F.coalesce(F.get(name_tokens(name), F.lit(0)), F.lit("")))


def page_type(text: Column) -> Column:
    """error, blank, index or register; failures first."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, r"\n"), lambda x: F.trim(x) != "")
    tabular = F.filter(lines, lambda x: F.ltrim(x).startswith("|") | x.rlike(FOLIO))
    return (
        F.when(text.rlike(FAILED), "error")
        .when((F.size(lines) == 0) | (F.length(F.trim(text)) < 120), "blank")
        .when((F.size(lines) >= 5) & (F.size(tabular) >= 0.4 * F.size(lines)), "index")
        .otherwise("register")
    )


def token_estimate(text: Column) -> Column:
    """Words count a token for each 4.2 characters (half-even, one at least), other characters one each."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([A-Za-z0-9_]+|[^A-Za-z0-9_\s])"), F.lit(1))
    each = lambda u: F.when(u.rlike("^[A-Za-z0-9]+$"), F.greatest(F.lit(1), F.bround(F.length(u) / F.lit(4.2)).cast("long"))).otherwise(F.lit(1))
    return F.aggregate(units, F.lit(0).cast("long"), lambda a, u: a + each(u))
