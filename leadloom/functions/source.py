"""Marketing source of a free-text note.

The channels are tried in a fixed order and the first that fires wins. Keywords
are plain substrings, so "expo" also fires on "export".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import schema as S
from leadloom.functions.text import clean_text, fold_case

_NAME_PATTERNS = {
    "Event": S.EVENT_NAME_PATTERNS,
    "Referral": [S.REFERRAL_PATTERN],
    "Organic Search": [S.ORGANIC_PATTERN],
    "Website": [S.WEBSITE_PATTERN],
}


def _any_of(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def channel_of(folded: Column) -> Column:
    """Channel of a cleaned, case-folded text."""
    own_post = F.contains(folded, F.lit("our post")) & F.contains(folded, F.lit("comment"))
    return (
        F.when(_any_of(folded, S.EVENT_KEYWORDS), "Event")
        .when(F.contains(folded, F.lit("linkedin")) | own_post, "LinkedIn")
        .when(_any_of(folded, S.REFERRAL_KEYWORDS), "Referral")
        .when(_any_of(folded, S.ORGANIC_KEYWORDS), "Organic Search")
        .when(_any_of(folded, S.MANUAL_KEYWORDS), "Manual/Sales")
        .when(_any_of(folded, S.WEBSITE_KEYWORDS), "Website")
        .otherwise("Other")
    )


def _named(channel: Column, text: Column) -> Column:
    """Text captured by the first matching pattern of the channel, else null."""
    name = None
    for which, patterns in _NAME_PATTERNS.items():
        for pattern in patterns:
            regex = "(?iu)" + pattern
            fires = (channel == which) & text.rlike(regex)
            name = (F if name is None else name).when(fires, F.trim(F.regexp_extract(text, regex, 1)))
    return name


def detail_of(channel: Column, name: Column, folded: Column) -> Column:
    """Readable detail, given the captured name (null if there was none)."""

    def has(word: str) -> Column:
        return F.contains(folded, F.lit(word))

    plain = name.isNull() | (name == "Event")
    event = (
        F.when(has("qr") & plain, "EventBooth QR Code")
        .when(has("qr"), F.concat(name, F.lit(" — Booth QR Code")))
        .otherwise(F.coalesce(name, F.lit("Event")))
    )
    linkedin = (
        F.when(has("dm"), "LinkedIn DM")
        .when(has("comment"), "LinkedIn post/comment")
        .when(has("connect"), "LinkedIn connection")
        .otherwise("LinkedIn")
    )
    return (
        F.when(channel == "Event", event)
        .when(channel == "LinkedIn", linkedin)
        .when(name.isNotNull(), F.concat_ws(" — ", channel, name))
        .otherwise(channel)
    )


def classify_source(df: DataFrame, text_col: str = "notes") -> DataFrame:
    """Add ``source_channel`` and ``source_detail`` for the note in ``text_col``.

    Each step has its own projection: a later one mentions an earlier one many
    times, and written out in place it would be evaluated as often and make the
    generated method too long to compile. Works on streaming frames too.
    """
    text, folded, name = F.col("_text"), F.col("_folded"), F.col("_name")
    channel = F.col("source_channel")
    # an event's name loses a leading article, and is never empty after it
    article = F.when(channel == "Event", F.regexp_replace(name, "(?iu)^(our|the) +", "")).otherwise(name)
    return (
        df.withColumn("_text", F.coalesce(clean_text(F.col(text_col)), F.lit("")))
        .withColumn("_folded", fold_case(text))
        .withColumn("source_channel", channel_of(folded))
        .withColumn("_name", _named(channel, text))
        .withColumn("_name", article)
        .withColumn("source_detail", detail_of(channel, name, folded))
        .drop("_text", "_folded", "_name")
    )
