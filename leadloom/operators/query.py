"""Filtered listings, lookups and exports of the lead table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.operators.numbering import STRETCH, stretch_offsets
from leadloom.schema import EXPORT_FIELDS, LEAD_COLUMNS, SEARCH_FIELDS, STATUS_NAMES

MAX_LIMIT = 200
# rows before and on a page that one task may hold in order; pages further in are found by counts
NEAR = 20_000


def _contains(col: Column, text: str) -> Column:
    # % and _ in the text act as wildcards; a backslash is a plain character
    pattern = "%" + text.strip().replace("\\", "\\\\") + "%"
    return col.ilike(pattern)


def _status_is(status: str) -> Column:
    cleaned = " ".join(status.split())
    if not cleaned:
        return F.col("lead_status").isNull()
    return F.col("lead_status") == STATUS_NAMES.get(cleaned.casefold(), cleaned)


def filter_leads(
    leads: DataFrame,
    status: str | None = None,
    owner: str | None = None,
    country: str | None = None,
    q: str | None = None,
) -> DataFrame:
    """Leads that satisfy every given condition; an empty parameter is none.

    ``status`` is normalised and then compared, so it reaches the Parquet scan
    as an equality; a blank one selects leads without status. ``owner``,
    ``country`` and ``q`` look for text in any case, as Unicode folds it.
    """
    conditions = []
    if status:
        conditions.append(_status_is(status))
    if owner:
        conditions.append(_contains(F.col("contact_owner"), owner))
    if country:
        conditions.append(_contains(F.col("country"), country))
    if q:
        conditions.append(reduce(lambda a, b: a | b, [_contains(F.col(c), q) for c in SEARCH_FIELDS]))
    return reduce(lambda df, cond: df.where(cond), conditions, leads)


def page_by_count(leads: DataFrame, limit: int, offset: int) -> DataFrame:
    """A page of the table, however far in, in order of ``id``.

    A top-k would hold every row before the page in one task. Counting the rows
    per range of ids finds the ranges that the page touches, and only those are
    sorted; each has a row of the page, so there are at most ``limit`` of them.
    """
    touched = (
        stretch_offsets(leads.select("id"), "id")
        .where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset))
        .agg(F.min("stretch").alias("first"), F.max("stretch").alias("last"), F.min("before").alias("before"))
        .first()
    )
    if touched["first"] is None:
        return leads.limit(0)
    ids = F.col("id").between(touched["first"] * STRETCH, (touched["last"] + 1) * STRETCH - 1)
    return leads.where(ids).orderBy("id").offset(offset - touched["before"]).limit(limit)


def first_rows(leads: DataFrame, limit: int, offset: int) -> DataFrame:
    """A page in order of ``id``: by a top-k of its rows and those before, or by counts where these are many."""
    if offset + limit <= NEAR:
        return leads.orderBy("id").offset(offset).limit(limit)
    return page_by_count(leads, limit, offset)


def list_leads(
    leads: DataFrame,
    status: str | None = None,
    owner: str | None = None,
    country: str | None = None,
    q: str | None = None,
    limit: int = 50,
    offset: int = 0,
) -> DataFrame:
    """One page of matching leads in order of ``id``."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    found = filter_leads(leads, status, owner, country, q).select(*LEAD_COLUMNS)
    return first_rows(found, limit, offset)


def get_leads(leads: DataFrame, ids: list[int] | DataFrame) -> DataFrame:
    """Leads with the given ids; ids that do not exist give no row.

    A list becomes a predicate on the scan, a frame with an ``id`` column a
    semi join.
    """
    if isinstance(ids, DataFrame):
        return leads.join(ids.select("id"), "id", "left_semi").select(*LEAD_COLUMNS)
    return leads.where(F.col("id").isin(list(ids))).select(*LEAD_COLUMNS)


def export_rows(
    leads: DataFrame,
    status: str | None = None,
    owner: str | None = None,
    country: str | None = None,
    q: str | None = None,
) -> DataFrame:
    """All matching leads in the 25 export columns, in order of ``id``."""
    return filter_leads(leads, status, owner, country, q).select(*EXPORT_FIELDS).orderBy("id")
