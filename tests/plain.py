"""Plain restatement of scoring and merging for small fixtures, one row at a time."""

from __future__ import annotations

import re


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    n = len(a) + len(b)
    return (1 - (n - 2 * lcs(a, b)) / n) * 100 if n else 100.0


def token_set(a, b):
    a, b = set(a.split()), set(b.split())
    if not a or not b:
        return 0.0
    s = " ".join(sorted(a & b))
    x, y = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if s and (not x or not y):
        return 100.0
    gap = 1 if s else 0
    whole_x, whole_y = len(s) + gap + len(x), len(s) + gap + len(y)
    out = [100 - 100 * (len(x) + len(y) - 2 * lcs(x, y)) / (whole_x + whole_y)]
    if s:
        out += [100 - 100 * (gap + len(t)) / (len(s) + w) for t, w in ((x, whole_x), (y, whole_y))]
    return max(out)


def name_of(lead):
    if lead.get("name_normalized"):
        return lead["name_normalized"]
    parts = [p.strip() for p in (lead.get("first_name"), lead.get("last_name")) if p and p.strip()]
    return " ".join(parts).lower() or None


def score(a, b):
    def text(x, y):
        return token_set(x, y) / 100 if x and y else 0.0

    name = text(name_of(a), name_of(b))
    company = text(a["company_normalized"], b["company_normalized"])
    ea, eb, pa, pb = a["email_normalized"], b["email_normalized"], a["phone_normalized"], b["phone_normalized"]
    email = 0.0
    if ea and eb:
        if ea == eb:
            email = 1.0
        elif "@" in ea and "@" in eb:
            (la, da), (lb, db) = ea.rsplit("@", 1), eb.rsplit("@", 1)
            email = ratio(la, lb) / 100 * 0.65 + ratio(da, db) / 100 * 0.35
    phone = 0.0
    if pa and pb:
        phone = 1.0 if pa == pb else 0.9 if min(len(pa), len(pb)) >= 8 and pa[-8:] == pb[-8:] else 0.0
    ca, cb = a["country"], b["country"]
    country = 1.0 if ca and cb and ca.strip().casefold() == cb.strip().casefold() else 0.0
    total = name * 0.35 + company * 0.20 + email * 0.20 + phone * 0.20 + country * 0.05
    if ea and ea == eb and (name >= 0.5 or company >= 0.5):
        total = max(total, 0.98)
    elif pa and pa == pb and (name >= 0.5 or company >= 0.5):
        total = max(total, 0.96)
    return min(total, 1.0), (name, company, email, phone, country)


def key(value):
    return re.sub("[^a-z0-9]+", " ", value.lower()).strip() or None if value else None


def merge(leads, rows):
    """Leads after the rows, and the target of each row: an id, or minus the first row."""
    leads = [dict(lead) for lead in sorted(leads, key=lambda r: r["id"])]
    before = [(lead, lead["email_normalized"], lead["phone_normalized"]) for lead in leads]
    targets = {}
    next_id = max((r["id"] for r in leads), default=0) + 1
    next_record = max((r["record_id"] for r in leads), default=0) + 1
    origin = {}
    for row in rows:
        if not row["identified"]:
            continue
        hit = next((r for r, e, _ in before if row["email_normalized"] and e == row["email_normalized"]), None)
        if hit is None:
            hit = next((r for r, _, p in before if row["phone_normalized"] and p == row["phone_normalized"]), None)
        if hit is None:
            probe = dict(row, first_name=None, last_name=None)
            best = 0
            for lead in leads:
                same = any(row[c] and row[c] == lead[c] for c in ("company_normalized", "name_normalized"))
                value = score(probe, lead)[0] if same else 0
                if value >= 0.90 and value > best:
                    best, hit = value, lead
        if hit is None:
            hit = {c: None for c in leads[0]} if leads else {}
            hit.update({c: row[c] for c in row if c not in ("seq", "identified", "page_url", "submitted_at")})
            hit.update(id=next_id, record_id=next_record, lead_status="New", original_source="Website Form")
            hit.update(original_source_drill_down_1=row["page_url"])
            hit.update(create_date=row["submitted_at"], last_modified_date=row["submitted_at"])
            next_id, next_record = next_id + 1, next_record + 1
            leads.append(hit)
            origin[hit["id"]] = -row["seq"]
        else:
            for c in (
                "first_name last_name full_name company_name email email_normalized "
                "phone_number phone_normalized country notes"
            ).split():
                hit[c] = row[c] or hit[c]
            hit.update(source_channel=row["source_channel"], source_detail=row["source_detail"])
            hit["original_source"] = "Website Form"
        targets[row["seq"]] = origin.get(hit["id"], hit["id"])
    return leads, targets
