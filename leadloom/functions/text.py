"""Cleaning of text columns.

Everything here is a column expression that stays in the JVM, apart from the
Unicode folding of names, which only non-ASCII values reach.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.schema import STATUS_NAMES

# White space as Unicode knows it. Java's \s is ASCII only, and its Unicode
# mode still leaves out the separators U+001C to U+001F.
WHITESPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def present(col: Column) -> Column:
    """Null where the text is empty; an empty string counts as missing."""
    return F.nullif(col, F.lit(""))


def clean_text(col: Column) -> Column:
    """Trim, collapse white space to single spaces, blank becomes null.

    ASCII text without control characters or double spaces, the usual case, is
    spared the costly replacement.
    """
    tidy = is_ascii(col) & ~F.contains(col, F.lit("  ")) & ~col.rlike(r"[\x00-\x1F]")
    return present(F.trim(F.when(tidy, col).otherwise(F.regexp_replace(col, WHITESPACE + "+", " "))))


def strip(col: Column) -> Column:
    """Remove white space at both ends only."""
    return F.regexp_replace(col, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def fold_case(col: Column) -> Column:
    """Full case folding, for comparing text.

    Upper- then lower-casing expands what plain lower-casing leaves alone
    (sharp s, ligatures, long s). The dotless i is set aside meanwhile, since
    upper-casing would turn it into a plain I, and final sigma becomes sigma.
    """
    dotless, aside = chr(0x131), chr(0xE000)
    # upper-casing leaves the capital sharp s alone, and lower-casing makes it a small one
    plain = F.replace(col, F.lit(chr(0x1E9E)), F.lit("ss"))
    upper = F.translate(F.upper(F.translate(plain, dotless, aside)), aside, dotless)
    folded = F.translate(F.lower(upper), chr(0x3C2), chr(0x3C3))
    return F.when(is_ascii(col), F.lower(col)).otherwise(folded)


def is_ascii(col: Column) -> Column:
    # one byte per character holds for ASCII text alone
    return F.octet_length(col) == F.char_length(col)


def normalize_email(col: Column) -> Column:
    return F.lower(clean_text(col))


def normalize_phone(col: Column) -> Column:
    """Decimal digits only; a number without any becomes null."""
    return present(F.regexp_replace(col, r"\P{Nd}+", ""))


@F.pandas_udf(T.StringType())
def _fold_unicode(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v).casefold(), na_action="ignore")


def normalize_name(col: Column) -> Column:
    """Key of a person or company name: ASCII letters and digits, single spaces.

    Accented letters become a space, as they fall outside ``a-z0-9``. Spark has
    no compatibility normalisation, so non-ASCII values take an Arrow UDF; it is
    handed null for all others.
    """
    folded = F.when(is_ascii(col), F.lower(col)).otherwise(
        _fold_unicode(F.when(~is_ascii(col), col))
    )
    return present(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")))


normalize_company = normalize_name


def normalize_status(col: Column) -> Column:
    """Stored name of a known status; other text passes through cleaned."""
    cleaned = clean_text(col)
    names = F.create_map(*[F.lit(x) for pair in STATUS_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, fold_case(cleaned)), cleaned)


def split_name(col: Column) -> Column:
    """``struct<first, rest>`` of a cleaned name, cut at its first space."""
    parts = F.split(clean_text(col), " ", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("first"), F.get(parts, F.lit(1)).alias("rest"))


def join_present(*cols: Column) -> Column:
    """Non-empty parts joined by one space, null if there are none."""
    return present(F.concat_ws(" ", *[present(c) for c in cols]))


def parse_int(col: Column) -> Column:
    """Whole part of a number in text, truncated toward zero; else null.

    Infinity and values beyond 64 bits give null.
    """
    text = clean_text(col)
    digits = "[0-9]+(?:_[0-9]+)*"
    number = rf"^[+-]?(?:{digits}\.?(?:{digits})?|\.{digits})(?:[eE][+-]?{digits})?$"
    value = F.regexp_replace(text, "_", "").try_cast("double")
    return F.when(text.rlike(number), value.try_cast("bigint"))


def required_int(col: Column, what: str) -> Column:
    """A whole number that must be there; a bad one fails the job."""
    value = F.regexp_replace(strip(col), r"(?<=[0-9])_(?=[0-9])", "")
    parsed = F.when(value.rlike("^[+-]?[0-9]+$"), value.try_cast("bigint"))
    message = F.concat(F.lit(f"{what} is not a whole number: "), F.coalesce(col, F.lit("null")))
    return F.coalesce(parsed, F.raise_error(message).cast("bigint"))


def email_domain(col: Column) -> Column:
    """Text after the last @ in lower case; null without an @ or if empty."""
    return F.when(F.contains(col, F.lit("@")), present(F.lower(F.substring_index(col, "@", -1))))


def country_key(col: Column) -> Column:
    """Country as used in a block key."""
    return strip(F.lower(col))
