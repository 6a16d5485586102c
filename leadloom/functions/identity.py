"""Who a lead is: matching name, scoring fields and block keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import (
    WHITESPACE,
    clean_text,
    country_key,
    email_domain,
    fold_case,
    join_present,
    normalize_name,
    present,
    strip,
)
from leadloom.schema import GENERIC_EMAIL_DOMAINS, PHONE_TAIL

SCORING_FIELDS = ["id", "name_tokens", "company_tokens", "email", "phone", "country_key"]


def matching_name(first: Column, last: Column, full: Column) -> Column:
    """Normalised full name, or first and last name where there is no full one."""
    return normalize_name(F.coalesce(clean_text(full), join_present(clean_text(first), clean_text(last))))


def lead_name(df_col=F.col) -> Column:
    """Name a lead is compared by: the normalised one, else first and last name."""
    parts = join_present(strip(df_col("first_name")), strip(df_col("last_name")))
    return F.coalesce(present(df_col("name_normalized")), F.lower(parts))


def display_name() -> Column:
    """Name shown in a summary."""
    return F.coalesce(present(F.col("full_name")), join_present(F.col("first_name"), F.col("last_name")))


def lead_summary(df: DataFrame) -> DataFrame:
    """The seven columns that identify a lead to a reader."""
    return df.select(
        "id", "record_id", display_name().alias("name"), "email", "phone_number", "company_name", "country"
    )


def token_string(col: Column) -> Column:
    """Sorted unique tokens joined by a space."""
    tokens = F.split(col, WHITESPACE + "+", -1)
    return present(F.array_join(F.array_sort(F.array_distinct(F.array_remove(tokens, ""))), " "))


def scoring_fields(df: DataFrame, *more: Column, words: list[Column] | None = None) -> DataFrame:
    """Narrow projection with everything the pair score looks at, once per lead.

    Missing text is empty here; only a missing country is null, since two blank
    countries agree. Columns in ``more`` are added. ``words`` are the ``token_string`` of
    the normalised name and company where these are known.
    """
    nothing = F.lit("")
    name, company = token_string(lead_name()), token_string(F.col("company_normalized"))
    if words is not None:
        # an empty one is missing; the lead may have a name elsewhere
        name, company = F.coalesce(present(words[0]), name), words[1]
    return df.select(
        "id",
        F.coalesce(name, nothing).alias("name_tokens"),
        F.coalesce(company, nothing).alias("company_tokens"),
        F.coalesce(F.col("email_normalized"), nothing).alias("email"),
        F.coalesce(F.col("phone_normalized"), nothing).alias("phone"),
        F.when(present(F.col("country")).isNotNull(), fold_case(strip(F.col("country")))).alias("country_key"),
        *more,
    )


def block_keys(df: DataFrame) -> DataFrame:
    """One row ``(id, kind, value)`` per block a lead belongs to, at most six."""
    staged = df.select(
        "id",
        present(F.col("phone_normalized")).alias("phone"),
        present(F.col("email_normalized")).alias("email"),
        present(F.col("company_normalized")).alias("company"),
        lead_name().alias("name"),
        F.when(present(F.col("country")).isNotNull(), country_key(F.col("country"))).alias("country"),
    ).withColumn("domain", email_domain(F.col("email")))

    def key(kind: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(F.lit(kind).alias("kind"), value.alias("value")))

    own_domain = F.when(~F.col("domain").isin(GENERIC_EMAIL_DOMAINS), F.col("domain"))
    keys = F.array(
        key("phone", F.col("phone")),
        key("email", F.col("email")),
        key("email_domain", own_domain),
        key("company", F.col("company")),
        key("name", F.col("name")),
        key("name_country", F.concat(F.col("name"), F.lit("|"), F.col("country"))),
    )
    return staged.select("id", F.inline(F.array_compact(keys)))


def phone_tail(phone: Column) -> Column:
    """Key that any two phones with a non-zero similarity share."""
    long = F.char_length(phone) >= PHONE_TAIL
    return F.when(long, F.right(phone, F.lit(PHONE_TAIL))).otherwise(phone)
