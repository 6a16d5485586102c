"""Seed upsert and field patches: a lead table in, the next one out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import normalize_status
from leadloom.operators.numbering import number_rows
from leadloom.schema import LEAD_COLUMNS


def max_value(leads: DataFrame, col: str) -> DataFrame:
    """One row with the largest value of ``col``, 0 in an empty table."""
    return leads.agg(F.coalesce(F.max(col), F.lit(0)).alias(col))


def require_unique_keys(seed: DataFrame) -> None:
    """Raise if a record id comes twice: the load would then fail as a whole."""
    twice = seed.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError("record ids given more than once: " + ", ".join(str(r["record_id"]) for r in twice))


def seed_actions(leads: DataFrame, seed: DataFrame) -> DataFrame:
    """``seed`` with ``id`` of the stored lead and ``action`` inserted or updated.

    Only the keys that the seed touches leave the lead table, so a small seed is
    matched without moving the large side.
    """
    touched = leads.select("id", "record_id").join(seed.select("record_id"), "record_id", "left_semi")
    action = F.when(F.col("id").isNull(), "inserted").otherwise("updated")
    return seed.join(touched, "record_id", "left").withColumn("action", action)


def seed_upsert(leads: DataFrame, seed: DataFrame) -> DataFrame:
    """Insert or overwrite leads by ``record_id``; the next lead table.

    ``seed`` comes from ``normalize_seed`` and has ``seq``, the order of arrival,
    by which new ids are given. Every column is overwritten, also with null.
    Loading the same seed again changes nothing.
    """
    require_unique_keys(seed)
    values = [c for c in LEAD_COLUMNS if c not in ("id", "record_id")]
    incoming = seed.select("record_id", F.struct(*values).alias("_new"))
    stored = leads.join(incoming, "record_id", "left")
    updated = stored.select(
        "id", "record_id", *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values]
    ).select(*LEAD_COLUMNS)
    new = seed_actions(leads, seed).where(F.col("action") == "inserted").drop("id", "action")
    first = max_value(leads, "id").scalar() + 1
    inserted = number_rows(new, "seq", "_n").withColumn("id", F.col("_n") + first)
    return updated.unionByName(inserted.select(*LEAD_COLUMNS))


def seed_report(leads: DataFrame, seed: DataFrame) -> DataFrame:
    """One row: how many records were inserted and how many updated."""
    actions = seed_actions(leads, seed)
    return actions.agg(
        F.count_if(F.col("action") == "inserted").alias("inserted"),
        F.count_if(F.col("action") == "updated").alias("updated"),
    )


_PATCHED = {"status": "lead_status", "owner": "contact_owner", "notes": "notes"}


def folded_patches(patches: DataFrame) -> DataFrame:
    """``(id, changes)``, once for each id: of every key the value given last.

    ``patches`` may have ``seq``, the order in which they came. Without it, an id
    that comes twice is an error, as nothing says which patch is the later one.
    Patches that change nothing, or for a null id, drop out.
    """
    if "seq" not in patches.columns:
        twice = patches.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
        if twice:
            raise ValueError("patched more than once, without seq: " + ", ".join(str(r["id"]) for r in twice))
        return patches.select("id", "changes").where("id IS NOT NULL")
    given = patches.where("id IS NOT NULL").select("id", "seq", F.explode("changes").alias("key", "value"))
    # a struct, since a null value counts too
    last = given.groupBy("id", "key").agg(F.max_by(F.struct("value"), "seq").alias("last"))
    entry = F.struct("key", F.col("last.value").alias("value"))
    return last.groupBy("id").agg(F.map_from_entries(F.collect_list(entry)).alias("changes"))


def apply_patches(leads: DataFrame, patches: DataFrame) -> DataFrame:
    """Set the given fields of leads; the next lead table.

    ``patches`` has ``id`` and ``changes``, a map with any of the keys status,
    owner and notes, and ``seq`` if a lead is patched more than once: patches then
    count in that order. An absent key leaves the field alone, a null value clears
    it. The status is normalised, owner and notes are taken as they are, and no
    other column is refreshed.
    """
    changed = leads.join(folded_patches(patches), "id", "left")

    def value(key: str, column: str):
        new = F.try_element_at("changes", F.lit(key))
        new = normalize_status(new) if key == "status" else new
        given = F.coalesce(F.map_contains_key("changes", key), F.lit(False))
        return F.when(given, new).otherwise(F.col(column)).alias(column)

    columns = {column: value(key, column) for key, column in _PATCHED.items()}
    return changed.select(*[columns.get(c, F.col(c)) for c in LEAD_COLUMNS])


def patch_actions(leads: DataFrame, patches: DataFrame) -> DataFrame:
    """``(id, action)`` per patch: updated, no_fields or not_found."""
    known = leads.select("id").join(patches.select("id").distinct(), "id", "left_semi").withColumn("_known", F.lit(True))
    keys = F.size(F.array_intersect(F.map_keys("changes"), F.array(*map(F.lit, _PATCHED))))
    action = (
        F.when(F.col("_known").isNull(), "not_found").when(F.coalesce(keys, F.lit(0)) <= 0, "no_fields").otherwise("updated")
    )
    return patches.join(known, "id", "left").select("id", action.alias("action"))
