"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randint(0, 30)) for _ in range(n))


def near(r, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = r.choice(WORDS)
    return " ".join(words)


def texts(seed=1):
    r = random.Random(seed)
    base = [prose(r, r.choice([1, 3, 4, 5, 8, 30, 60, 120])) for _ in range(25)]
    out = list(base)
    for t in base:
        if len(t.split()) > 20:
            out += [near(r, t, k) for k in (1, 2, 3, 6)]
    out += [base[-1]] * 12 + [base[0].upper(), base[1] + "  \n", "Ünïcode ÀÉ straße 漢字 　 x", "a\x0bb\x0cc\td"]
    out += ["", None, " \n\t ", None, "", prose(r, 4000), "x" * 5000]
    return out


def documents(spark, values=None):
    """Documents with columns whose names the operators use themselves."""
    values = texts() if values is None else values
    rows = [(i, t, i % 3, "x", None, "clash", float(i)) for i, t in enumerate(values)]
    if values:
        rows += [rows[3], (None, "null id text here with some words", 0, "x", None, "clash", 0.0), (None, None, 0, "x", None, "c", 0.0)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, size int, row string, norm string, h string, `a.b` double"
    ).repartition(3)


def ids(rows):
    return sorted(rows, key=lambda v: (v is None, v))
