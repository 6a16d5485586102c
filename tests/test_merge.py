import random

import pytest
from pyspark.sql import functions as F

import plain
from leadloom.operators import merge
from leadloom.operators.merge import match_exact, match_fuzzy, merge_submissions
from leadloom.operators.normalize import normalize_seed, normalize_submissions
from leadloom.schema import LEAD_COLUMNS, LEAD_SCHEMA, SEED_HEADERS, SUBMISSION_SCHEMA

FIRST = ["Jane", "Joan", "Wei", "李"]
LAST = ["Tan", "Tann", "Lim"]
COMPANY = ["Acme Pte Ltd", "Acme Pte. Ltd", "Acme", "Globex", None]
MAIL = ["jane.tan@acme.com", "jane.tann@acme.com", "JANE.TAN@acme.com", "jane.tan@mail.acme.com", "wei@globex.io", None, None]
PHONE = ["+65 9123 4567", "+1 9123 4567", "91234567", "(65) 9123-4567", "+44 9123 4567", "123", None, None]
COUNTRY = ["Singapore", "singapore ", None]


def pick(r, values):
    return r.choice(values)


def some_leads(spark, r, n):
    rows = []
    for i in range(n):
        row = dict.fromkeys(SEED_HEADERS.values())
        row.update(
            record_id=str(100 + i),
            full_name=pick(r, [f"{pick(r, FIRST)} {pick(r, LAST)}", None]),
            first_name=pick(r, FIRST),
            last_name=pick(r, [*LAST, None]),
            company_name=pick(r, COMPANY),
            email=pick(r, MAIL),
            phone_number=pick(r, PHONE),
            country=pick(r, COUNTRY),
        )
        rows.append(tuple([i + 1, *row.values()]))
    raw = spark.createDataFrame(rows, "seq bigint, " + ", ".join(f"{c} string" for c in SEED_HEADERS.values()))
    return normalize_seed(raw).withColumnRenamed("seq", "id").select(*LEAD_COLUMNS)


def some_submissions(spark, r, n):
    rows = []
    for i in range(n):
        row = dict.fromkeys(SUBMISSION_SCHEMA.names)
        row.update(
            name=pick(r, [f"{pick(r, FIRST)} {pick(r, LAST)}"] * 5 + [None, " "]),
            email=pick(r, MAIL),
            phone=pick(r, PHONE),
            company=pick(r, COMPANY),
            country=pick(r, COUNTRY),
            message=pick(r, ["Our website chat", "dm on LinkedIn", None]),
            page_url="/p",
            submitted_at=f"2026-01-{i % 28 + 1:02d}",
        )
        rows.append(tuple([i + 1, *row.values()]))
    raw = spark.createDataFrame(rows, "seq bigint, " + ", ".join(f"{c} string" for c in SUBMISSION_SCHEMA.names))
    return normalize_submissions(raw)


def check(spark, leads, rows):
    merge = merge_submissions(leads, rows)
    lead_rows = [r.asDict() for r in leads.collect()]
    submitted = [r.asDict() for r in rows.orderBy("seq").collect()]
    want, targets = plain.merge(lead_rows, submitted)
    assert {r["seq"]: r["target"] for r in merge.decisions.collect()} == targets
    got = sorted((tuple(r[c] for c in LEAD_COLUMNS) for r in merge.leads.collect()), key=lambda t: t[0])
    assert got == [tuple(r.get(c) for c in LEAD_COLUMNS) for r in want]
    report = merge.report().first()
    skipped = sum(not r["identified"] for r in submitted)
    assert (report["total_rows"], report["skipped"]) == (len(submitted), skipped)
    assert report["inserted"] == len(want) - len(lead_rows)
    assert report["updated"] == len(submitted) - skipped - report["inserted"]
    return merge


@pytest.mark.parametrize("seed", range(2))
def test_merge_equals_row_by_row_replay(spark, seed):
    r = random.Random(seed)
    leads = some_leads(spark, r, r.choice([0, 3, 12])) if seed else spark.createDataFrame([], LEAD_SCHEMA)
    leads = spark.createDataFrame(leads.collect(), LEAD_SCHEMA)
    rows = some_submissions(spark, r, 60)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    check(spark, leads, rows)


def world(r, tag):
    """Names, companies, addresses and phones that no other world has; dense, so that rows depend on each other."""
    names = [f"{a}{tag} {b}{tag}" for a in ("Jane", "Joan", "Wei") for b in ("Tan", "Tann")]
    companies = [f"Acme{tag} Pte Ltd", f"Acme{tag}", f"Globex{tag}", None]
    mails = [f"jane.tan@acme{tag}.com", f"jane.tann@acme{tag}.com", f"jane.tan@mail.acme{tag}.com", f"wei@globex{tag}.io", None]
    tail = f"{int(tag, 36) % 1000:03d}4567"
    phones = [f"+65 9{tail}", f"+1 9{tail}", f"9{tail}", f"+44 9{tail}", f"1{tail[:3]}", None]

    def one():
        row = {"name": pick(r, [*names, None]), "company": pick(r, companies), "email": pick(r, mails)}
        return {**row, "phone": pick(r, phones), "country": pick(r, COUNTRY)}

    return one


def test_merge_of_fifty_worlds(spark):
    """Fifty random tables and batches at once, each apart from the others, against the row-by-row replay."""
    stored, sent = [], []
    for seed in range(50):
        r = random.Random(1000 + seed)
        one = world(r, f"{chr(97 + seed // 26)}{chr(97 + seed % 26)}")
        kept = [one() for _ in range(r.choice([0, 2, 6]))]
        stored += kept + [dict(r.choice(kept)) for _ in range(4) if kept]
        sent += [(r.random(), one()) for _ in range(r.choice([12, 30]))]
    sent = [row for _, row in sorted(sent, key=lambda p: p[0])]
    rows = [dict.fromkeys(SEED_HEADERS.values()) for _ in stored]
    for i, (row, lead) in enumerate(zip(rows, stored)):
        row.update(record_id=str(i + 1), full_name=lead["name"], company_name=lead["company"], email=lead["email"])
        row.update(phone_number=lead["phone"], country=lead["country"])
    fields = "seq bigint, " + ", ".join(f"{c} string" for c in SEED_HEADERS.values())
    raw = spark.createDataFrame([(i + 1, *row.values()) for i, row in enumerate(rows)], fields)
    leads = normalize_seed(raw).withColumnRenamed("seq", "id").select(*LEAD_COLUMNS)
    leads = spark.createDataFrame(leads.collect(), LEAD_SCHEMA)
    merge = check(spark, leads, submissions(spark, sent))
    assert merge.decisions.where("target < 0 AND action = 'updated'").count() > 50


def test_chain_of_corrections(spark):
    """Each row brings its lead the address by which the next one is found."""
    rows = []
    for i in range(7):
        rows.append({"name": "Ana Lim", "email": f"a{i}@x.io", "company": "Globe", "phone": f"+65 9123 45{i:02d}"})
        rows.append({"name": "Ana Lim", "email": f"a{i + 1}@x.io", "company": "Globe", "phone": f"+65 9123 45{i:02d}"})
    merge = check(spark, spark.createDataFrame([], LEAD_SCHEMA), submissions(spark, rows))
    assert merge.report().first()["inserted"] == 1


def test_no_python_replay(spark):
    row = {"name": "Jane Tan", "email": "jane.tan@acme.com", "phone": "+65 9123 4567", "company": "Acme"}
    done = merge_submissions(leads_of(spark, [row]), submissions(spark, [dict(row, email=None, phone="+1 9123 4567")] * 3))
    assert "MapInPandas" not in done.decisions._jdf.queryExecution().toString()


def test_only_what_differs_is_changed(spark):
    leads = leads_of(spark, [{"name": f"P{i} Q{i}", "email": f"p{i}@q.io"} for i in range(9)])
    merge = merge_submissions(leads, submissions(spark, [{"email": "p3@q.io", "country": "SG"}, {"name": "New One"}]))
    assert sorted(r["id"] for r in merge.changed.collect()) == [4, 10]
    apart = merge_submissions(leads.where("id = 4"), submissions(spark, [{"email": "p3@q.io", "country": "SG"}, {"name": "New One"}]), (9, 9))
    assert sorted(map(tuple, apart.changed.collect())) == sorted(map(tuple, merge.changed.collect()))


def submissions(spark, rows):
    fields = ["name", "email", "phone", "company", "country"]
    raw = spark.createDataFrame(
        [(i, *[row.get(f) for f in fields]) for i, row in enumerate(rows, start=1)],
        "seq bigint, " + ", ".join(f"{f} string" for f in fields),
    )
    return normalize_submissions(raw)


def leads_of(spark, rows):
    """Leads from submissions-like rows, ids from 1."""
    merge = merge_submissions(spark.createDataFrame([], LEAD_SCHEMA), submissions(spark, rows))
    return spark.createDataFrame(merge.leads.collect(), LEAD_SCHEMA)


def test_copies_of_one_submission_make_one_lead(spark):
    one = {"name": "Jane Tan", "email": "jane@acme.com", "company": "Acme"}
    other = {"name": "Omar Ito", "email": "omar@globex.io", "company": "Globex"}
    rows = submissions(spark, [other, *[one] * 300, other])
    merge = check(spark, spark.createDataFrame([], LEAD_SCHEMA), rows)
    assert merge.leads.count() == 2
    assert merge.decisions.where("target = -2").count() == 300


def test_shared_mailbox_of_many_people(spark):
    # one address in all rows, five companies, names all different
    rows = [
        {"name": f"Person {chr(97 + i % 26)}{i}", "email": "info@mail.com", "company": f"Company {'abcde'[i % 5]}"}
        for i in range(120)
    ]
    merge = check(spark, spark.createDataFrame([], LEAD_SCHEMA), submissions(spark, rows))
    assert merge.report().first()["inserted"] == 5


def test_similar_submission_finds_lead_and_smallest_id_wins(spark):
    row = {"name": "Jane Tan", "email": "jane.tan@acme.com", "phone": "+65 9123 4567", "company": "Acme", "country": "SG"}
    stored = leads_of(spark, [row]).collect()
    copies = [dict(stored[0].asDict(), id=i, record_id=i) for i in range(1, 40)]
    leads = spark.createDataFrame([tuple(c[f] for f in LEAD_COLUMNS) for c in copies], LEAD_SCHEMA)
    near = dict(row, phone="+1 9123 4567", email="jane.tan@mail.acme.com")
    rows = submissions(spark, [near, dict(near, email="jane.tan@acme.co"), near])
    assert {(r["seq"], r["id"]) for r in match_fuzzy(rows, leads).collect()} == {(1, 1), (2, 1), (3, 1)}
    check(spark, leads, rows)


def test_email_comes_before_phone(spark):
    leads = leads_of(
        spark,
        [{"name": "A B", "phone": "1234"}, {"name": "C D", "email": "c@d.com"}, {"name": "E F", "email": "c@d.com"}],
    )
    rows = submissions(spark, [{"email": " C@D.com", "phone": "12-34"}, {"phone": "(12) 34"}, {"phone": "99"}])
    assert {tuple(r) for r in match_exact(rows, leads).collect()} == {(1, 1, 2), (2, 2, 1)}
    check(spark, leads, rows)


def test_blank_name_is_not_skipped(spark):
    rows = submissions(spark, [{"name": " "}, {"name": "", "country": "SG"}])
    merge = check(spark, spark.createDataFrame([], LEAD_SCHEMA), rows)
    assert [tuple(r) for r in merge.messages().collect()] == [(2, "Item 2: no identifying fields")]


def test_lead_changed_by_exact_match_is_no_copy_any_more(spark):
    one = {"name": "Mira Osei", "email": "mira@kente.gh", "phone": "+233 2044 5566", "company": "Kente Works"}
    stored = leads_of(spark, [one]).first().asDict()
    leads = spark.createDataFrame(
        [tuple(dict(stored, id=i, record_id=i)[f] for f in LEAD_COLUMNS) for i in (1, 2, 3)], LEAD_SCHEMA
    )
    exact = dict(one, phone="+233 5099 1122")
    alike = dict(one, email="mira@kente.com", phone="+1 2044 5566")
    merge = check(spark, leads, submissions(spark, [exact, alike, dict(alike, email="mira@kente.org")]))
    assert {r["seq"]: r["target"] for r in merge.decisions.collect()}[2] == 2


@pytest.mark.parametrize("seed", range(2))
def test_alike_leads_with_exact_and_similar_rows(spark, seed):
    r = random.Random(100 + seed)
    stored = some_leads(spark, r, 5).collect()
    copies = [dict(r.choice(stored).asDict(), id=i, record_id=i) for i in range(1, 16)]
    leads = spark.createDataFrame([tuple(c[f] for f in LEAD_COLUMNS) for c in copies], LEAD_SCHEMA)
    rows = some_submissions(spark, r, 50)
    check(spark, leads, spark.createDataFrame(rows.collect(), rows.schema))


def test_copies_near_a_stored_lead_take_no_replay(spark):
    row = {"name": "Jane Tan", "email": "jane.tan@acme.com", "phone": "+65 9123 4567", "company": "Acme", "country": "SG"}
    leads = leads_of(spark, [row])
    near = dict(row, phone="+1 9123 4567", email="jane.tan@acme.co")
    merge = check(spark, leads, submissions(spark, [near] * 60))
    assert merge.decisions.where("target = 1").count() == 60


def test_later_rounds_look_only_at_leads_that_gained_or_lost_a_row(spark, monkeypatch):
    """Worlds that are settled at once cost nothing in the rounds that one tangled world takes."""
    sent = []
    for seed in range(6):
        r = random.Random(2000 + seed)
        one = world(r, f"{chr(97 + seed)}z")
        sent += [one() for _ in range(25 if seed == 0 else 3)]
    events, active = [], []
    states, affected = merge._versions, merge._affected

    def versions(rows):
        events.append(rows.count())
        return states(rows)

    def rows_again(*args):
        found = affected(*args)
        since = {r["target"]: r["since"] for r in args[0].collect()}
        active.append((min(since.values()), {r["seq"] for r in found.collect()}))
        return found

    monkeypatch.setattr(merge, "_versions", versions)
    monkeypatch.setattr(merge, "_affected", rows_again)
    merge.merge_decisions(spark.createDataFrame([], LEAD_SCHEMA), submissions(spark, sent)).collect()
    assert len(events) > 1
    assert all(later < events[0] for later in events[1:])
    # a row meets leads as they were before the first row that moved
    assert all(seq > first for first, again in active for seq in again)


def test_rows_alike_are_looked_up_once(spark, monkeypatch):
    """Copies are one kind, and each row meets a lead in the one state that it had at its turn."""
    row = dict(name="Jane Tan", email="jane.tan@mail.acme.com", phone="+1 9123 4567", company="Acme Pte Ltd")
    sent = submissions(spark, [dict(row, country=pick) for pick in ["Chile", "Peru"] * 20])
    stored = leads_of(spark, [dict(full_name="Jane Tan", email="jane.tan@acme.com", phone_number="+65 9123 4567", company_name="Acme")])
    sizes = {}
    kept = merge.written

    def counted(df, label):
        out = kept(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(merge, "written", counted)
    check(spark, stored, sent)
    assert sizes["fields"] == [2] and sizes["named"] == [40]
    assert max(sizes["near"]) <= 40


def test_rows_come_again_only_while_a_lead_differs(spark):
    """A row that leaves a lead as it was, or in the state that it has anyway later, moves no others."""
    row = {"name": "Jane Tan", "company": "Acme", "email": "jane@acme.com"}
    phones = ["+65 9123 4567", "+65 9000 1111", "+65 9123 4567", "+65 9123 4567", "+65 9000 1111", "+65 9000 1111"]
    rows = submissions(spark, [dict(row, phone=p) for p in phones]).select("seq", *merge._STATE)
    events = merge._with_words(rows).withColumns({"target": F.lit(-1).cast("bigint"), "at": F.col("seq"), "created": F.col("seq") == 1}).drop("seq")
    named = rows.select("seq", F.lit(1).cast("bigint").alias("a_kind"))
    keys = rows.where("seq = 1").select(F.lit(1).cast("bigint").alias("a_kind"), F.explode(merge._tail_keys()).alias("key"))
    scores = spark.createDataFrame([], "a_kind bigint, id bigint, score double")
    members = spark.createDataFrame([], "first bigint, b_id bigint")

    def again(before, after):
        changed = spark.createDataFrame([(-1, 2)], "target bigint, since bigint")
        found = merge._affected(changed, merge._versions(events.where(before)), merge._versions(events.where(after)), named, keys, scores, members)
        return sorted(r["seq"] for r in found.collect())

    assert again("at IN (1, 5)", "at IN (1, 3, 5)") == []
    # the phone of row 2 holds until row 4 takes it back
    assert again("at IN (1, 4)", "at IN (1, 2, 4)")[:2] == [3, 4]


def test_replaced_rows_of_a_table(spark):
    """Small changes are kept apart, and the latest rows of a key are there, however they were put together."""
    frame = lambda rows: spark.createDataFrame(rows, "k bigint, v string")
    want = {k: {"a"} for k in range(40)}
    table = merge._Patched("k", "patched", frame([(k, "a") for k in want]))
    first = table.parts[0][1]
    r = random.Random(5)
    for step in range(6):
        some = r.sample(range(45), r.choice([1, 3, 12]))
        rows = [(k, f"{step}{i}") for k in some for i in range(k % 3)]
        table.replace(frame([(k, "") for k in some]).select("k"), frame(rows))
        want |= {k: {v for n, v in rows if n == k} for k in some}
        got = {}
        for k, v in table.rows().collect():
            got.setdefault(k, set()).add(v)
        assert got == {k: v for k, v in want.items() if v}
    assert table.parts[0][1] is first and len(table.parts) > 1


def test_rows_do_not_pass_through_the_driver(spark):
    """Joins of what grows with the batch are no broadcasts, however few bytes it takes."""
    rows = submissions(spark, [{"name": "Jane Tan", "email": f"jane{i}@acme.com", "company": "Acme"} for i in range(4)])
    leads = leads_of(spark, [{"name": "Jane Tan", "email": "jane1@acme.com"}])
    for df in (match_exact(rows, leads), merge_submissions(leads, rows).changed.select("id", "email")):
        df.collect()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # numbers of rows per stretch are few
        joins = [line for line in plan.splitlines() if "Join " in line and "stretch#" not in line and "top#" not in line and "group#" not in line]
        assert joins and all("strategy=merge" in line for line in joins), joins
    assert len(merge_submissions(leads, rows).changed.collect()) == 4
