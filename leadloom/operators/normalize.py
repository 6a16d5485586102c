"""Raw records to normalised ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.dates import normalize_date
from leadloom.functions.identity import matching_name
from leadloom.functions.source import classify_source
from leadloom.functions.text import (
    clean_text,
    normalize_company,
    normalize_email,
    normalize_name,
    normalize_phone,
    normalize_status,
    parse_int,
    required_int,
    split_name,
)
from leadloom.schema import LEAD_COLUMNS, SEED_HEADERS, SUBMISSION_SCHEMA

_STORED_DIFFERENTLY = {
    "record_id": lambda c: required_int(c, "Record ID"),
    "email": normalize_email,
    "lead_status": normalize_status,
    "create_date": normalize_date,
    "last_modified_date": normalize_date,
    "lead_score": parse_int,
}


def normalize_seed(raw: DataFrame) -> DataFrame:
    """Seed records, as text in the lead columns, to lead rows without ``id``.

    E-mail is stored in lower case, dates as ISO text where they can be read,
    and the source is taken from the raw note. Other columns of ``raw``, such as
    an arrival order, are passed through.
    """
    raw_columns = list(SEED_HEADERS.values())
    extra = [c for c in raw.columns if c not in raw_columns and c not in LEAD_COLUMNS]
    classified = classify_source(raw, "notes")
    cleaned = [_STORED_DIFFERENTLY.get(c, clean_text)(F.col(c)).alias(c) for c in raw_columns]
    return classified.select(
        *extra,
        *cleaned,
        normalize_email(F.col("email")).alias("email_normalized"),
        normalize_phone(F.col("phone_number")).alias("phone_normalized"),
        matching_name(F.col("first_name"), F.col("last_name"), F.col("full_name")).alias("name_normalized"),
        normalize_company(F.col("company_name")).alias("company_normalized"),
        "source_channel",
        "source_detail",
    )


def normalize_submissions(raw: DataFrame) -> DataFrame:
    """Form submissions to lead-shaped rows, one per submission.

    ``raw`` has the submission columns and ``seq``, the order of arrival. The
    e-mail keeps its case and the date its form here. ``identified`` is false
    where name, e-mail, phone and company are all null or empty; blanks count. If
    ``raw`` has ``error``, the reason why an item could not be read, it is passed
    through, and such rows are not identified.
    """
    fields = {f: F.col(f) if f in raw.columns else F.lit(None).cast("string") for f in SUBMISSION_SCHEMA.names}
    identified = F.greatest(*[F.coalesce(fields[f] != "", F.lit(False)) for f in ("name", "email", "phone", "company")])
    errors = ["error"] if "error" in raw.columns else []
    if errors:
        identified = identified & F.col("error").isNull()
    staged = classify_source(raw.select("seq", *errors, *[c.alias(f) for f, c in fields.items()]), "message")
    staged = staged.withColumn("_name", split_name(F.col("name")))
    return staged.select(
        F.col("seq").cast("bigint").alias("seq"),
        identified.alias("identified"),
        F.col("_name.first").alias("first_name"),
        F.col("_name.rest").alias("last_name"),
        clean_text(F.col("name")).alias("full_name"),
        clean_text(F.col("company")).alias("company_name"),
        clean_text(F.col("email")).alias("email"),
        normalize_email(F.col("email")).alias("email_normalized"),
        clean_text(F.col("phone")).alias("phone_number"),
        normalize_phone(F.col("phone")).alias("phone_normalized"),
        clean_text(F.col("country")).alias("country"),
        clean_text(F.col("message")).alias("notes"),
        clean_text(F.col("page_url")).alias("page_url"),
        clean_text(F.col("submitted_at")).alias("submitted_at"),
        normalize_name(F.col("name")).alias("name_normalized"),
        normalize_company(F.col("company")).alias("company_normalized"),
        "source_channel",
        "source_detail",
        *errors,
    )
