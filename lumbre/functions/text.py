"""Text functions as column expressions. Two normalisers exist on purpose: one keeps the text's look, one folds it for matching."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the data model.
STOPWORDS = [
    "de", "del", "la", "las", "el", "los", "y", "en", "a", "al", "con", "sin", "tipo", "vivienda", "modelo", "proyecto",
    "manzana", "mz", "lote", "piso", "n", "no", "num", "numero", "dorm", "dormitorio", "dormitorios",
]
KEYWORDS = ["casa", "departamento", "depto", "duplex", "pareada", "pareado", "continua", "aislada", "aislado", "condominio", "edificio", "torre"]
FLAT_WORDS = ["departamento", "depto", "edificio", "torre", "condominio", "duplex"]
TERRACED_WORDS = ["pareada", "pareado", "continua"]
DETACHED_WORDS = ["aislada", "aislado"]
EMPTY_WORDS = ["", "nan", "none", "s/i", "sin informacion", "sin información", "na", "n/a", "null"]
# The file names of rated and pre-rated certificates, in lower case.
PRE_RATED_NAME = r"(^|[_\-\s])precalificad[ao]s?([_\-\s\.]|$)"
RATED_NAME = r"(^|[_\-\s])calificad[ao]s?([_\-\s\.]|$)"
#: White space as Python's strip() and \s know it.
BLANK = r"[\s\x1C-\x1F]"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


@F.pandas_udf(StringType())
def _without_marks(s: pd.Series) -> pd.Series:
    fold = lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return s.map(fold, na_action="ignore")


def _only_where_needed(col: Column, f) -> Column:
    """ASCII text passes by: the row's text reaches Python as null, which the UDF hands back."""
    odd = F.octet_length(col) != F.length(col)
    return F.when(odd, f(F.when(odd, col))).otherwise(col)


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends (Spark's trim takes blanks only)."""
    return F.regexp_replace(col, f"(?U)^{BLANK}+|{BLANK}+$", "")


def tidy(col: Column) -> Column:
    """For extracted text: null to empty; compatibility forms and ligatures resolved; blanks collapsed; ends stripped."""
    x = _only_where_needed(F.coalesce(col, F.lit("")), _nfkc)
    x = F.regexp_replace(F.replace(x, F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(x, r"\s+\n", "\n"), r"^\s+|\s+$", "")


def fold(col: Column) -> Column:
    """For matching: lower case, no diacritics, punctuation to blanks, only a-z, 0-9 and single blanks. Null stays null."""
    x = _only_where_needed(strip(F.lower(col)), _without_marks)
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9\s]", " "), r"\s+", " "))


def fold_builtin(col: Column) -> Column:
    """fold() for Spanish letters only, without Python."""
    x = F.translate(F.lower(F.trim(col)), "áéíóúüñàèìòùâêîôûäëïöç", "aeiouunaeiouaeiouaeioc")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9\s]", " "), r"\s+", " "))


def strip_marks(col: Column) -> Column:
    return _only_where_needed(col, _without_marks)


def safe_name(col: Column, default: str = "sin_nombre") -> Column:
    x = F.regexp_replace(F.regexp_replace(F.coalesce(col, F.lit("")), r"[^A-Za-z0-9_\-.]+", "_"), r"^[._]+|[._]+$", "")
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(default))


def safe_region_id(col: Column) -> Column:
    return safe_name(col, "region")


def file_name(col: Column, longest: int = 180, default: str = "ficha_sin_identificacion") -> Column:
    """A lower-case file name without accents; characters that paths forbid become underscores, other odd ones go."""
    x = F.translate(F.lower(F.trim(col)), "áéíóúñü", "aeiounu")
    for pattern, by in ((r'[/\\:*?"<>|]', "_"), (r"[^a-z0-9\-_. ]+", ""), (r"\s+", "_"), (r"_+", "_"), (r"^[._\-]+|[._\-]+$", "")):
        x = F.regexp_replace(x, pattern, by)
    return F.substring(F.coalesce(F.nullif(x, F.lit("")), F.lit(default)), 1, longest)


def download_name(commune: Column, project: Column, ident: Column, kind: Column, section: Column, action: Column) -> Column:
    return file_name(F.concat(F.lit("ficha_"), F.concat_ws("_", *[F.coalesce(c, F.lit("")) for c in (commune, project, ident, kind, section, action)])))


def after_colon(col: Column) -> Column:
    """What follows the first colon, trimmed; the whole text if there is none."""
    at = F.instr(col, ":")
    return strip(F.when(at > 0, F.substring(col, at + 1, F.length(col))).otherwise(col))


def region_text(rows: Column) -> Column:
    return F.trim(F.array_join(rows, " "))


def status_from_name(col: Column) -> Column:
    """precalificada or calificada from a file name; the longer word is looked for first."""
    x = F.lower(col)
    return F.when(x.rlike(PRE_RATED_NAME), "precalificada").when(x.rlike(RATED_NAME), "calificada")


def status(col: Column) -> Column:
    x = F.lower(strip_marks(strip(col)))
    rated = x.contains("calificacion")
    return F.when(rated & x.contains("pre"), "precalificada").when(rated, "calificada").otherwise(strip(col))


def zone(col: Column) -> Column:
    """A trailing letter A to I in upper case, else the text. `S/I` (no information) gives I: see zone_is_doubtful."""
    letter = F.upper(F.regexp_extract(strip(col), r"(?i)([A-I])\s*$", 1))
    return F.when(letter != "", letter).otherwise(strip(col))


def zone_is_doubtful(col: Column) -> Column:
    return F.lower(strip(col)).isin(*EMPTY_WORDS)


def clean_category(col: Column) -> Column:
    x = F.regexp_replace(strip(F.lower(col)), f"(?U){BLANK}+", " ")
    return F.when(~x.isin(*EMPTY_WORDS), x)


def tokens(folded: Column) -> Column:
    """Words of folded text of two letters or more that are neither stopwords nor numbers."""
    number = lambda w: F.substring(w, 1, 1).between("0", "9") & w.rlike(r"^\d+$")  # noqa: E731  the pattern only where it may hold
    return F.filter(F.split(folded, r"\s+"), lambda w: (F.length(w) >= 2) & ~w.isin(*STOPWORDS) & ~number(w))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words, joined by blanks. Neighbours are zipped, so the words are worked out a few times and not once a place."""
    out = words
    for k in range(1, n):
        count = F.greatest(F.size(words) - k, F.lit(0))
        out = F.zip_with(F.slice(out, 1, count), F.slice(words, k + 1, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def property_type(folded: Column) -> Column:
    """Flats before terraced before detached houses; parts of words count. Null if nothing fits."""
    any_of = lambda words: folded.rlike("|".join(words))
    return F.when(any_of(FLAT_WORDS), "depto").when(any_of(TERRACED_WORDS), "casa_pareada").when(any_of(DETACHED_WORDS), "casa_aislada").when(folded.contains("casa"), "casa_aislada")


def percent_text(col: Column) -> Column:
    """Two decimals with a decimal comma."""
    return F.replace(F.format_string("%.2f%%", col), F.lit("."), F.lit(","))


def is_pager(col: Column) -> Column:
    return F.trim(F.replace(col, F.lit("."), F.lit(""))).rlike(r"^[\d\s]+$")


def contains_fold(col: Column, part: str) -> Column:
    """Case-insensitive containment; null is false."""
    return F.coalesce(F.contains(F.lower(col), F.lit(part.lower())), F.lit(False))


def has_word(col: Column, word: str) -> Column:
    return F.coalesce(col.rlike(rf"\b{word}\b"), F.lit(False))
