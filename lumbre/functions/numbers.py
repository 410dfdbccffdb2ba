"""Number dialects. In one, every dot groups thousands and the comma is decimal; in the other, a dot alone is decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

PLAIN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
#: A number with grouped or plain whole part, decimal comma and percent sign, not inside a word. (?U): letters of any script are words.
NUMBER = r"(?U)(?<![\w])[-+]?(?:\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+(?:,\d+)?)%?(?![\w])"


# Fixed value: a percentage in certificate text; dots don't group its digits.
PERCENT = r"[-+]?(?:\d+(?:,\d+)?|,\d+)\s*%"


def to_double(col: Column) -> Column:
    """try_cast, but only of plain decimal text: Spark alone would take '12d' and 'nan'."""
    x = strip(col)
    return F.when(x.rlike(PLAIN), x.try_cast("double"))


def chilean(col: Column) -> Column:
    x = F.replace(F.replace(strip(F.replace(col, F.lit("%"), F.lit(""))), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return to_double(x)


def number_tokens(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(NUMBER), F.lit(0))


def first_number(col: Column) -> Column:
    return chilean(F.try_element_at(number_tokens(col), F.lit(1)))


def last_number(col: Column) -> Column:
    return chilean(F.try_element_at(number_tokens(col), F.lit(-1)))


def percent_value(col: Column) -> Column:
    """The first `n%` or `,n%` in percentage points."""
    x = F.regexp_extract(F.replace(col, F.lit("\u00a0"), F.lit(" ")), PERCENT, 0)
    return F.when(x != "", chilean(x))


def u_value(col: Column) -> Column:
    """A percentage if there is one; else the first number if the text names W/m2; else null."""
    x = F.lower(col)
    return F.when(x.contains("%"), percent_value(col)).when(x.contains("w/m2") | x.contains("w/m²"), first_number(col))


def row_numbers(col: Column, n: int = 5) -> list[Column]:
    """The first n numbers of a row's blank-separated tokens; other tokens are passed over, missing ones are null."""
    found = F.filter(F.transform(F.split(F.trim(col), r"\s+"), chilean), lambda v: v.isNotNull())
    return [F.try_element_at(found, F.lit(i + 1)) for i in range(n)]


def saving_and_label(tokens: Column) -> Column:
    """struct(saving, label): the first token that is a number and the one after it; else the first number inside the text, without a label."""
    number = F.transform(tokens, lambda t: chilean(t).isNotNull())
    at = F.array_position(number, F.lit(True)).cast("int")
    label = F.when(F.size(tokens) > at, F.try_element_at(tokens, at + 1))
    return F.when(at > 0, F.struct(chilean(F.try_element_at(tokens, at)).alias("saving"), label.alias("label"))).otherwise(F.struct(first_number(F.array_join(tokens, " ")).alias("saving"), F.lit(None).cast("string").alias("label")))


def clean_numeric(col: Column) -> Column:
    x = strip(col)
    x = F.when(x.contains(",") & x.contains("."), F.replace(x, F.lit("."), F.lit(""))).otherwise(x)
    return to_double(F.regexp_replace(F.replace(x, F.lit(","), F.lit(".")), r"[^0-9eE+\-.]", ""))


def log1p(col: Column) -> Column:
    """Null below -1, minus infinity at -1."""
    return F.when(col == -1, F.lit(float("-inf"))).when(col > -1, F.log1p(col))


def clip_low(col: Column, low: float = 0.0) -> Column:
    return F.when(col.isNotNull(), F.greatest(col, F.lit(low)))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def half_even(col: Column) -> Column:
    """The nearest whole number, halves to the even one."""
    return F.rint(col).cast("long")


def excel_column(letters: str) -> int:
    """The 0-based index of a column's letters."""
    index = 0
    for letter in letters.upper():
        if "A" <= letter <= "Z":
            index = 26 * index + ord(letter) - 64
    return index - 1
