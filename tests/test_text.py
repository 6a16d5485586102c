import random
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadloom.functions import identity, text
from leadloom.functions.dates import normalize_date
from leadloom.schema import STATUS_NAMES


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(2)
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


SPACES = [" ", "  ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", " ", "　"]


def messy(n=300):
    r = random.Random(7)
    pieces = ["a", "B", "9", "é", "ß", "ﬁ", "Ａ", "İ", "ı", "Σ", "½", "é", "​", "'", "-", "ſ", "②", "K"]
    return [None, "", " ", *("".join(r.choice(pieces + SPACES) for _ in range(r.randint(1, 9))) for _ in range(n))]


def cleaned(v):
    return re.sub(r"\s+", " ", v.strip()) or None if v is not None else None


def test_clean_text_knows_all_white_space(spark):
    values = messy()
    assert apply(spark, text.clean_text, values) == [cleaned(v) for v in values]


def test_normalize_name(spark):
    values = [*messy(), "Acme,  Jane", "José", "Müller", "Straße ﬁ Ａcme", "李小龙", "O'Neil-Smith"]

    def want(v):
        if cleaned(v) is None:
            return None
        folded = unicodedata.normalize("NFKC", cleaned(v)).casefold()
        return " ".join(re.sub(r"[^a-z0-9\s]", " ", folded).split()) or None

    got = apply(spark, text.normalize_name, values)
    assert got == [want(v) for v in values]
    assert got[-6:] == ["acme jane", "jos", "m ller", "strasse fi acme", None, "o neil smith"]


def test_fold_case(spark):
    values = ["ABC", "Straße", "ﬁN", "ſo", "ΑΣ", "ας", "ıI", "K", None]
    assert apply(spark, text.fold_case, values) == [v.casefold() if v else v for v in values]


def test_phone_email_status(spark):
    assert apply(spark, text.normalize_phone, ["+1 (555) 123-4567", " ", "n/a", "٠١", None]) == ["15551234567", None, None, "٠١", None]
    assert apply(spark, text.normalize_email, [" A@B.Com\t", "", None]) == ["a@b.com", None, None]
    values = ["  NEW ", "close  won", "CLOSED WON", "Nurture  x", " ", None, *STATUS_NAMES]
    assert apply(spark, text.normalize_status, values) == ["New", "Closed Won", "Closed Won", "Nurture x", None, None, *STATUS_NAMES.values()]


def test_email_domain(spark):
    values = ["a@b.com", "a@b@C.org", "plain", "a@", "", None]
    assert apply(spark, text.email_domain, values) == ["b.com", "c.org", None, None, None, None]


def test_split_name(spark):
    values = [" Jane  Mary Tan ", "Jane", "", None]
    got = apply(spark, text.split_name, values)
    assert [tuple(r) for r in got] == [("Jane", "Mary Tan"), ("Jane", None), (None, None), (None, None)]


def test_parse_int(spark):
    values = ["42", "12.9", "-12.9", " 7 ", "1e2", ".5", "5.", "1_000", "1__0", "1d", "12f", "nan", "inf", "0x1", "", None, "n/a", "3000000000"]
    want = [42, 12, -12, 7, 100, 0, 5, 1000, None, None, None, None, None, None, None, None, None, 3000000000]
    assert apply(spark, text.parse_int, values) == want


def test_required_int(spark):
    assert apply(spark, lambda c: text.required_int(c, "key"), [" 12 ", "+5", "1_0"]) == [12, 5, 10]
    for bad in ("12.5", "", None, "x"):
        with pytest.raises(Exception, match="key is not a whole number"):
            apply(spark, lambda c: text.required_int(c, "key"), [bad])


def test_dates(spark):
    values = """6/4/2026|06/04/2026|6/ 4/2026|6/4/26|13/1/2026|2/30/2026|2/29/2024|2026-6-4|2026-06-04|2026-02-30|0000-01-01
        2026-06-04 x|junk|2026-06-04T08:00:00Z|2026-06-04T08:00|2026-06-04T08|20260604T080910|2026-06-04T0809
        2026-06-04T08:09:10.5|2026-06-04T08:09:10,1234567+05:30|2026-06-04T08:09:10-00:00|2026-06-04T08:09:10+0530
        2026-06-04T08:09:10-05|2026-06-04T25:00|2026-02-30T08:00:00Z|2026-06-04T|2026-06-04T10.5|2026-W23-4T10:00|2026W234T10
        2026-W23T10:00|2026-W53-1T10:00|2025-W53-1T10:00|2026-W00-1T10:00|Tuesday|2026-06-04T08:3015|2026-06-04T08:30:
        2026-06-04T08:30+24:00|2026-06-04T08:30+05:30:15|0000-01-01T00:00:00|2026-06-04T08:09:10+00:00|2026-13-01T00:00:00Z""".replace("\n        ", "|").split("|")

    def want(v):
        try:
            if "T" in v:
                return datetime.fromisoformat(v.replace("Z", "+00:00")).isoformat()
            return datetime.strptime(v, "%m/%d/%Y" if "/" in v else "%Y-%m-%d").isoformat()
        except ValueError:
            return v

    assert dict(zip(values, apply(spark, normalize_date, values))) == {v: want(v) for v in values}
    assert apply(spark, normalize_date, [" ", None, "  6/4/2026 "]) == [None, None, "2026-06-04T00:00:00"]


def test_names_of_leads(spark):
    rows = [(1, "jane tan", "X", "Y", "F"), (2, None, " Jane ", "TAN ", ""), (3, "", None, " ", None), (4, None, "Jane", None, None)]
    df = spark.createDataFrame(rows, "id int, name_normalized string, first_name string, last_name string, full_name string")
    got = df.select("id", identity.lead_name().alias("n"), identity.display_name().alias("d")).orderBy("id").collect()
    assert [r["n"] for r in got] == ["jane tan", "jane tan", None, "jane"]
    assert [r["d"] for r in got] == ["F", " Jane  TAN ", " ", "Jane"]
