"""Fuzzy similarity of names, companies, e-mails and phones.

The text measure is the indel similarity: edits are insertions and deletions
only, so ``indel(a, b) = len(a) + len(b) - 2 * lcs(a, b)`` with the longest
common subsequence. Spark's ``levenshtein`` also counts substitutions and gives
other numbers. All arithmetic stays in Spark; the Arrow UDF returns nothing but
LCS lengths, and gets null for pairs that do not need one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom import schema as S
from leadloom.functions.identity import SCORING_FIELDS

_WORD = 64
_BATCH_CELLS = 1 << 22


def _lcs_word(short: list[str], long: list[str]) -> np.ndarray:
    """LCS lengths of pairs whose first text fits one machine word.

    Bit-parallel (Hyyro 2004) over all pairs of the batch at once: row ``i`` of
    ``match[:, j]`` has a bit for each place of ``short[i]`` equal to character
    ``j`` of ``long[i]``. The word is the narrowest that holds ``short``.
    """
    n, width_b = len(short), max(map(len, long))
    word = next(w for w in (8, 16, 32, 64) if w >= max(map(len, short)))
    kind = np.dtype(f"u{word // 8}")
    a = np.array(short, dtype=f"U{word}").view(np.uint32).reshape(n, word)
    b = np.array(long, dtype=f"U{width_b}").view(np.uint32).reshape(n, width_b)
    match = np.packbits(a[:, None, :] == b[:, :, None], axis=2, bitorder="little").view(kind)[:, :, 0]
    # padding is NUL on both sides: mask the places past the end of the first
    # text, and skip the characters past the end of the second
    lengths = np.fromiter(map(len, short), kind, n)
    inside = np.right_shift(~kind.type(0), kind.type(word) - lengths)
    ends = np.fromiter(map(len, long), np.int64, n)
    match = np.where(np.arange(width_b) < ends[:, None], match & inside[:, None], 0)
    row = np.full(n, ~kind.type(0))
    for j in range(width_b):
        hit = row & match[:, j]
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row & inside).astype(np.int32)


def lcs_length(a: str, b: str) -> int:
    """LCS length of two texts of any length, on Python's big integers."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs_lengths(left: pd.Series, right: pd.Series) -> pd.Series:
    """LCS length per pair; missing where either side is.

    Each distinct pair of texts is worked out once per batch.
    """
    known = (left.notna() & right.notna()).to_numpy()
    pairs = [
        (a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left.to_numpy()[known], right.to_numpy()[known])
    ]
    lengths = dict.fromkeys(pairs, 0)
    groups: dict[tuple[int, int], list[tuple[str, str]]] = {}
    for a, b in lengths:
        if len(a) > _WORD or len(b) > 16 * _WORD:
            lengths[a, b] = lcs_length(a, b)
        elif a:
            # like sizes together, so that padding at most doubles the work
            groups.setdefault((len(a).bit_length(), len(b).bit_length()), []).append((a, b))
    for (_, bits), rows in groups.items():
        step = max(1, _BATCH_CELLS // (_WORD << bits))
        for start in range(0, len(rows), step):
            batch = rows[start : start + step]
            lengths.update(zip(batch, _lcs_word(*map(list, zip(*batch))).tolist()))
    out = np.zeros(len(left), np.int32)
    out[known] = np.fromiter(map(lengths.__getitem__, pairs), np.int32, len(pairs))
    return pd.Series(out, dtype="Int32").where(known)


@F.pandas_udf(T.IntegerType())
def lcs_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    return lcs_lengths(left, right)


def _ratio_sql(text: str) -> str:
    """Indel similarity, 0 to 100, from two lengths and the LCS; empty texts are alike."""
    total = f"({text}_len_a + {text}_len_b)"
    return f"if({total} > 0, (1D - ({total} - 2 * {text}_lcs) / {total}) * 100D, 100D)"


def _token_set_sql(what: str) -> str:
    """Token-set similarity, 0 to 100, from the length of the common tokens, the
    lengths of the others, and their LCS."""
    common, a, b = f"{what}_common", f"{what}_len_a", f"{what}_len_b"
    apart = f"({a} + {b} - 2 * {what}_lcs)"
    return (
        f"CASE WHEN {common} = 0 THEN 100D - 100 * {apart} / ({a} + {b}) "
        f"WHEN {a} = 0 OR {b} = 0 THEN 100D ELSE greatest("
        f"100D - 100 * {apart} / (2 * {common} + 2 + {a} + {b}), "
        f"100D - 100 * (1 + {a}) / (2 * {common} + 1 + {a}), "
        f"100D - 100 * (1 + {b}) / (2 * {common} + 1 + {b})) END"
    )


def _both(col: str) -> str:
    return f"(a_{col} <> '' AND b_{col} <> '')"


def _same(col: str) -> str:
    return f"(a_{col} = b_{col} AND a_{col} <> '')"


def _phone_sql() -> str:
    """1 if equal, 0.9 if the last eight characters are, else 0."""
    n = S.PHONE_TAIL
    tails = f"least(char_length(a_phone), char_length(b_phone)) >= {n} AND right(a_phone, {n}) = right(b_phone, {n})"
    return f"CASE WHEN {_same('phone')} THEN 1D WHEN {tails} THEN {S.PHONE_TAIL_SCORE}D ELSE 0D END"


# the key is null where the country is missing, so blank ones still agree
_COUNTRY = "if(a_country_key = b_country_key, 1D, 0D)"


def _confidence_sql(score: dict[str, str], same_email: str, same_phone: str) -> str:
    """Weighted sum in a fixed order, so that doubles agree bit for bit; lifted
    where an exact identifier has support, and at most 1."""
    total = " + ".join(f"({score[k]}) * {w}D" for k, w in S.SIGNAL_WEIGHTS.items())
    support = " OR ".join(f"({score[k]}) >= {S.FLOOR_SUPPORT}D" for k in ("name", "company"))
    floor = (
        f"CASE WHEN {same_email} AND ({support}) THEN {S.SAME_EMAIL_FLOOR}D "
        f"WHEN {same_phone} AND ({support}) THEN {S.SAME_PHONE_FLOOR}D ELSE 0D END"
    )
    return f"least(greatest({total}, {floor}), 1D)"


def _bound_sql() -> str:
    """A score no pair exceeds, from what can be told without comparing texts.

    A signal counts 1 where both sides have it. The sum is taken in the same order
    as the score, and each rounding step is monotone, so the bound is never below.
    """
    most = {k: f"if({_both(c)}, 1D, 0D)" for k, c in _TEXT_COLUMNS.items()}
    most |= {"phone": _phone_sql(), "country": _COUNTRY}
    return _confidence_sql(most, _same("email"), _same("phone"))


_TEXT_COLUMNS = {"name": "name_tokens", "company": "company_tokens", "email": "email"}
# pairs of texts that the measures take the LCS of
_COMPARED = ("name", "company", "local", "domain")


def _state_sql(col: str) -> str:
    """2 if both sides are equal, 1 if they differ, 0 if one is missing."""
    return f"CASE WHEN {_same(col)} THEN 2 WHEN {_both(col)} THEN 1 ELSE 0 END"


def _split(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Tokens and parts of the texts that differ, and all that needs no text."""
    differ = {k: f"({_both(c)} AND a_{c} <> b_{c})" for k, c in _TEXT_COLUMNS.items()}
    differ["email"] = f"({differ['email']} AND contains(a_email, '@') AND contains(b_email, '@'))"
    cols = {f"{k}_state": _state_sql(c) for k, c in _TEXT_COLUMNS.items()}
    cols["compared"] = differ["email"]
    for side in "ab":
        for what in ("name", "company"):
            tokens = f"if({differ[what]}, {side}_{what}_tokens, '')"
            cols[f"{what}_{side}"] = f"split({tokens}, ' ')"
        cols[f"email_{side}"] = f"if({differ['email']}, {side}_email, '')"
        cols[f"domain_{side}"] = f"substring_index(if({differ['email']}, {side}_email, ''), '@', -1)"
    cols |= {"phone_score": _phone_sql(), "country_score": _COUNTRY}
    cols |= {"same_email": _same("email"), "same_phone": _same("phone")}
    return pairs.select(*keep, *[F.expr(v).alias(k) for k, v in cols.items()])


_PLAIN = ["name_state", "company_state", "email_state", "compared"]
_KNOWN = ["phone_score", "country_score", "same_email", "same_phone"]


def _texts(split: DataFrame, keep: list[str]) -> DataFrame:
    """The differing texts, sorted tokens joined again; empty where none differ."""
    cols = {}
    for what in ("name", "company"):
        a, b = f"{what}_a", f"{what}_b"
        cols[f"{what}_common"] = f"char_length(array_join(array_intersect({a}, {b}), ' '))"
        cols[f"{what}_text_a"] = f"array_join(array_except({a}, {b}), ' ')"
        cols[f"{what}_text_b"] = f"array_join(array_except({b}, {a}), ' ')"
    for side in "ab":
        cols[f"local_text_{side}"] = f"left(email_{side}, char_length(email_{side}) - char_length(domain_{side}) - 1)"
        cols[f"domain_text_{side}"] = f"domain_{side}"
    return split.select(*keep, *_PLAIN, *_KNOWN, *[F.expr(v).alias(k) for k, v in cols.items()])


def _scored(texts: DataFrame, keep: list[str]) -> DataFrame:
    """Signal scores and the confidence."""
    lcs = {}
    for text in _COMPARED:
        a, b = f"{text}_text_a", f"{text}_text_b"
        # equal and empty texts need no UDF
        needed = f"{a} <> {b} AND {a} <> '' AND {b} <> ''"
        found = lcs_udf(F.expr(f"if({needed}, {a}, null)"), F.expr(f"if({needed}, {b}, null)"))
        lcs[f"{text}_lcs"] = F.coalesce(found, F.expr(f"if({a} = {b}, char_length({a}), 0)"))
        lcs |= {f"{text}_len_{side}": F.expr(f"char_length({text}_text_{side})") for side in "ab"}
    work = texts.select(
        *keep, *_PLAIN, *_KNOWN, "name_common", "company_common", *[v.alias(k) for k, v in lcs.items()]
    )
    score = {
        what: f"CASE {what}_state WHEN 2 THEN 1D WHEN 1 THEN ({_token_set_sql(what)}) / 100D ELSE 0D END"
        for what in ("name", "company")
    }
    local, domain = (f"{_ratio_sql(half)} / 100D" for half in ("local", "domain"))
    blended = f"{local} * {S.EMAIL_LOCAL_WEIGHT}D + {domain} * {S.EMAIL_DOMAIN_WEIGHT}D"
    score["email"] = f"CASE WHEN email_state = 2 THEN 1D WHEN compared THEN {blended} ELSE 0D END"
    work = work.select(*keep, *_KNOWN, *[F.expr(v).alias(f"{k}_score") for k, v in score.items()])
    final = _confidence_sql({k: f"{k}_score" for k in S.SIGNAL_WEIGHTS}, "same_email", "same_phone")
    return work.withColumn("score", F.expr(final))


def score_pairs(
    pairs: DataFrame, min_confidence: float | None = None, keep: list[str] | None = None
) -> DataFrame:
    """``keep`` columns (the two ids), ``score``, the signal scores and equality flags.

    ``pairs`` has the scoring fields of both leads, prefixed ``a_`` and ``b_``.
    With ``min_confidence`` only pairs at or above it are returned; those that
    could not get there are dropped before any text is compared.
    """
    keep = keep or ["a_id", "b_id"]
    if min_confidence is not None:
        pairs = pairs.where(f"{_bound_sql()} >= {float(min_confidence)!r}D")
    scored = _scored(_texts(_split(pairs, keep), keep), keep)
    if min_confidence is None:
        return scored
    # A generator of no or one row and not a filter: a filter would be pushed below
    # the projections under it, with the whole score written out at every mention.
    cut = F.when(F.col("score") >= min_confidence, F.array(F.lit(True)))
    return scored.select("*", F.explode(cut).alias("_cut")).drop("_cut")


def rounded(score: Column) -> Column:
    """Confidence to four decimals; exact ties go up."""
    return F.floor(score * 10000 + 0.5).cast("double") / 10000.0


def signals() -> Column:
    """Reasons of a scored pair, as an array in a fixed order."""

    def graded(col: str, what: str) -> Column:
        return F.when(F.col(col) >= 0.90, F.lit(f"very similar {what}")).when(
            F.col(col) >= 0.75, F.lit(f"similar {what}")
        )

    found = F.array_compact(
        F.array(
            F.when(F.col("same_email"), F.lit("exact normalized email match")),
            F.when(F.col("same_phone"), F.lit("exact normalized phone match")),
            graded("name_score", "names"),
            graded("company_score", "company names"),
            F.when(F.col("email_score") >= 0.80, F.lit("similar email addresses")),
            F.when(F.col("phone_score") >= 0.80, F.lit("similar phone numbers")),
            F.when(F.col("country_score") == 1.0, F.lit("same country")),
        )
    )
    fallback = F.array(F.lit("multiple identity fields are similar"))
    return F.when(F.size(found) > 0, found).otherwise(fallback)


def prefixed(fields: DataFrame, prefix: str) -> DataFrame:
    """Scoring fields renamed for one side of a pair."""
    return fields.select(*[F.col(c).alias(f"{prefix}_{c}") for c in SCORING_FIELDS])
