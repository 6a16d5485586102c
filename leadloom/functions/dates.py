"""Dates in text to ISO text; what cannot be read stays as it was."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.text import clean_text, present

_MONTH = "(1[0-2]|0[1-9]|[1-9])"
_DAY = "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_YEAR = "((?!0000)[0-9]{4})"
_SLASHED = f"^{_MONTH}/{_DAY}/{_YEAR}$"
_DASHED = f"^{_YEAR}-{_MONTH}-{_DAY}$"

# the usual shape, which is ISO text already but for a Z
_PLAIN = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T(?:[01][0-9]|2[0-3])(?::[0-5][0-9]){2}(?:Z|\+(?:[01][0-9]|2[0-3]):[0-5][0-9])?$"
_WEEK = r"([0-9]{4})-?W([0-9]{2})-?([1-7])?"
_FRACTION = r"(?:[.,]([0-9]+))?"
_MIN = "([0-5][0-9])"
# groups: 1 date, 2 hour, 3/4 minute and second with colons, 5/6 without,
# 7 fraction, 8 sign, 9 offset hour, 10/11 its minute and second with colons, 12/13 without
_INSTANT = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}"
    r"|[0-9]{4}-W[0-9]{2}(?:-[1-7])?|[0-9]{4}W[0-9]{2}[1-7]?)T"
    rf"([01][0-9]|2[0-3])(?::{_MIN}(?::{_MIN})?|{_MIN}{_MIN}?)?{_FRACTION}"
    rf"(?:([+-])([01][0-9]|2[0-3])(?::{_MIN}(?::{_MIN})?|{_MIN}{_MIN}?)?)?$"
)


def _real_date(year: Column, month: Column, day: Column) -> Column:
    """ISO date text, null where the calendar has no such day."""
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(F.trim(day), 2, "0"))
    return F.when((year != "0000") & text.try_cast("date").isNotNull(), text)


def _week_date(value: Column) -> Column:
    """ISO date text of a week date such as 2026-W23-4; the day defaults to Monday."""
    year, week, day = (present(F.regexp_extract(value, _WEEK, i)) for i in (1, 2, 3))
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")
    first_monday = F.date_sub(fourth, F.weekday(fourth))
    n = week.try_cast("int")
    monday = F.date_add(first_monday, (n - 1) * 7)
    date = F.date_add(monday, F.coalesce(day.try_cast("int"), F.lit(1)) - 1)
    return F.when((n >= 1) & (F.weekofyear(monday) == n), F.date_format(date, "yyyy-MM-dd"))


def _iso_text(parts: Column) -> Column:
    """ISO text from the groups of an instant."""

    def first_of(missing: str, *groups: int) -> Column:
        return F.coalesce(*[present(F.get(parts, F.lit(i - 1))) for i in groups], F.lit(missing))

    day = first_of("", 1)
    compact = F.replace(day, F.lit("-"))
    calendar = _real_date(compact.substr(1, 4), compact.substr(5, 2), compact.substr(7, 2))
    date = F.when(F.contains(day, F.lit("W")), _week_date(day)).otherwise(calendar)
    micros = F.rpad(F.substring(first_of("", 7), 1, 6), 6, "0")
    sign = first_of("", 8)
    hours, minutes, seconds = first_of("00", 9), first_of("00", 10, 12), first_of("00", 11, 13)
    zero = (hours == "00") & (minutes == "00") & (seconds == "00")
    offset = F.when(
        sign != "",
        F.concat(
            F.when(zero, F.lit("+")).otherwise(sign),
            F.concat_ws(":", hours, minutes, F.when(seconds != "00", seconds)),
        ),
    ).otherwise(F.lit(""))
    time = F.concat_ws(":", first_of("", 2), first_of("00", 3, 5), first_of("00", 4, 6))
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
    return F.concat(date, F.lit("T"), time, fraction, offset)


def _instant(value: Column) -> Column:
    """ISO text of an instant, null if it is none.

    The groups are cut out once and bound as the element of a one-element array;
    the same columns written out at each use make generated code too large.
    """
    value = F.replace(value, F.lit("Z"), F.lit("+00:00"))
    groups = "|".join(f"${i}" for i in range(1, 14))
    parts = F.split(F.regexp_replace(value, _INSTANT, groups), r"\|", -1)
    texts = F.transform(F.array(parts), _iso_text)
    return F.when(value.rlike(_INSTANT), F.get(texts, F.lit(0)))


def normalize_date(col: Column) -> Column:
    """ISO date-time text of ``M/d/yyyy``, ``yyyy-M-d`` or an ISO instant.

    Text with a capital T is read as an instant: a calendar date (with or
    without dashes) or a week date; a time ``HH``, ``HH:mm``, ``HH:mm:ss`` (or
    without colons) with an optional fraction of any length, cut to
    microseconds; and an optional offset, which is kept; ``Z`` means ``+00:00``.
    Anything else is returned cleaned but otherwise unchanged.
    """
    text = clean_text(col)
    # either form to y-M-d, which the cast to a date reads and checks
    dashed = F.when(F.contains(text, F.lit("/")), F.regexp_replace(text, _SLASHED, "$3-$1-$2")).otherwise(text)
    day = F.replace(dashed, F.lit(" ")).try_cast("date").cast("string")
    date = F.when(dashed.rlike(_DASHED), F.concat(day, F.lit("T00:00:00")))
    plain = text.rlike(_PLAIN) & F.left(text, F.lit(10)).try_cast("date").isNotNull()
    instant = F.when(plain, F.replace(text, F.lit("Z"), F.lit("+00:00"))).otherwise(_instant(text))
    return F.coalesce(F.when(F.contains(text, F.lit("T")), instant).otherwise(date), text)


def iso_timestamp(col: Column) -> Column:
    """Timestamp of a normalised date column, null where the text is no date."""
    return col.try_cast("timestamp")
