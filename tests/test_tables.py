import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import plain
from leadloom.operators import dashboard, query, upsert
from leadloom.operators.normalize import normalize_seed, normalize_submissions
from leadloom.operators.numbering import number_rows
from leadloom.schema import EXPORT_FIELDS, LEAD_COLUMNS, LEAD_SCHEMA, SEED_HEADERS
from leadloom.sources import files, scratch
from leadloom.sources.scratch import shared_dir
from leadloom.sources.store import LeadStore
from leadloom.operators.merge import lookup_keys, merge_submissions
from leadloom.streaming.jobs import merge_into, store_counts, stream_merge
from test_dedupe import frame, lead


def ids(df):
    return [r["id"] for r in df.collect()]


def some(spark):
    return frame(
        spark,
        [
            lead(1, full_name="Jane Tan", lead_status="Closed Won", contact_owner="Dan O_Hara", country="Spain", source_channel="Event"),
            lead(2, company_name="Ünal 100%", lead_status="New", contact_owner="Dan OxHara", country="spain & co", source_channel=""),
            lead(3, email="a\\b@x.com", contact_owner="", country="Peru", lead_status=None),
            lead(4, company_normalized="jane ltd", lead_status="", contact_owner=None, country=None, source_channel="Event"),
        ],
    )


def test_filters(spark):
    df = some(spark)
    assert ids(query.list_leads(df, status=" close  WON ")) == [1]
    assert ids(query.list_leads(df, status=" ")) == [3]
    assert ids(query.list_leads(df, status="")) == [1, 2, 3, 4]
    assert ids(query.list_leads(df, owner=" o_hARA ")) == [1, 2]
    assert ids(query.list_leads(df, owner=" ")) == [1, 2, 3]
    assert ids(query.list_leads(df, country="SPAIN")) == [1, 2]
    assert ids(query.list_leads(df, q="jane")) == [1, 4]
    assert ids(query.list_leads(df, q="ünAL")) == [2]
    assert ids(query.list_leads(df, q="a\\b")) == [3]
    assert ids(query.list_leads(df, status="new", q="%")) == [2]
    assert ids(query.list_leads(df, limit=2, offset=1)) == [2, 3]
    assert ids(query.get_leads(df, [4, 9])) == [4]
    for bad in ({"limit": 0}, {"limit": 201}, {"offset": -1}):
        with pytest.raises(ValueError):
            query.list_leads(df, **bad)


def test_status_filter_reaches_the_scan(spark, tmp_path):
    some(spark).write.parquet(str(tmp_path / "t"))
    df = query.list_leads(spark.read.parquet(str(tmp_path / "t")), status="new")
    assert "EqualTo(lead_status,New)" in df._jdf.queryExecution().toString()


def test_deep_page_and_numbering(spark, monkeypatch):
    monkeypatch.setattr("leadloom.operators.numbering.STRETCH", 16)
    monkeypatch.setattr("leadloom.operators.query.STRETCH", 16)
    kept = [i for i in range(1, 400) if i % 7 and not 100 < i < 180]
    df = spark.createDataFrame([(i,) for i in kept], "id bigint").repartition(5)
    for offset in (0, 3, 77, 200, len(kept) - 2, len(kept), 9999):
        assert ids(query.page_by_count(df, 20, offset)) == kept[offset : offset + 20]
    numbered = number_rows(df, "id", "n").orderBy("id").collect()
    assert [r["n"] for r in numbered] == list(range(len(kept)))


def test_numbering_of_numbers_far_apart(spark, monkeypatch):
    monkeypatch.setattr("leadloom.operators.numbering.STRETCH", 4)
    monkeypatch.setattr("leadloom.operators.numbering._FAN", 3)
    given = sorted({-(1 << 62), -7, *range(0, 300, 7), 1 << 40, (1 << 40) + 1, (1 << 62) + 5})
    df = spark.createDataFrame([(i,) for i in given], "id bigint").repartition(4)
    numbered = number_rows(df, "id", "n").orderBy("id").collect()
    assert [(r["id"], r["n"]) for r in numbered] == [(v, i) for i, v in enumerate(given)]


def test_dashboard(spark):
    rows = {(r["dimension"], r["key"]): r["n"] for r in dashboard.dashboard(some(spark)).collect()}
    assert rows == {
        ("status", "Closed Won"): 1,
        ("status", "New"): 1,
        ("status", "Unknown"): 2,
        ("source_channel", "Event"): 2,
        ("source_channel", "Unknown"): 2,
        ("total", "leads"): 4,
    }
    row = dashboard.dashboard_json(some(spark)).first()
    assert row["total_leads"] == 4 and json.loads(row["by_status"]) == {"Closed Won": 1, "New": 1, "Unknown": 2}
    empty = dashboard.dashboard(spark.createDataFrame([], LEAD_SCHEMA)).collect()
    assert [tuple(r) for r in empty] == [("total", "leads", 0)]


def test_patches(spark):
    patches = spark.createDataFrame(
        [(1, {"status": " close won", "notes": None}), (2, {"owner": ""}), (3, {}), (4, {"status": None, "colour": "x"}), (9, {"owner": "x"}), (5, None)],
        "id bigint, changes map<string,string>",
    )
    df = frame(spark, [lead(i, lead_status="New", contact_owner="Al", notes="n", last_modified_date="d") for i in range(1, 6)])
    rows = {r["id"]: r for r in upsert.apply_patches(df, patches).collect()}
    got = {i: (r["lead_status"], r["contact_owner"], r["notes"], r["last_modified_date"]) for i, r in rows.items()}
    same = ("New", "Al", "n", "d")
    assert got == {1: ("Closed Won", "Al", None, "d"), 2: ("New", "", "n", "d"), 3: same, 4: (None, "Al", "n", "d"), 5: same}
    actions = dict(map(tuple, upsert.patch_actions(df, patches).collect()))
    assert actions == {1: "updated", 2: "updated", 3: "no_fields", 4: "updated", 9: "not_found", 5: "no_fields"}


HEADER = ",".join(SEED_HEADERS)


def seed_line(record, first, last, full, company="", email="", notes="", date=""):
    cells = dict.fromkeys(SEED_HEADERS, "")
    cells.update({"Record ID": record, "First Name": first, "Last Name": last, "Full Name": full})
    cells.update({"Company Name": company, "Email": email, "Notes": notes, "Create Date": date})
    return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in cells.values())


def test_seed_file_upsert_and_reload(spark, tmp_path):
    folder = tmp_path / "seed"
    folder.mkdir()
    lines = [
        HEADER,
        seed_line("20", "Jane", "Tan", "", 'Acme, "Inc"', " Jane@X.com ", "Met him at SaaStr Annual.\nsecond line", "6/4/2026"),
        "",
        seed_line("10", "", "", "  Omar   Ito "),
    ]
    (folder / "a.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    (folder / "b.csv").write_text(HEADER + "\n" + "5,Bob\n", encoding="utf-8")
    store = LeadStore(spark, str(tmp_path / "store"))
    seed = normalize_seed(files.read_seed_csv(spark, str(folder)))
    report = upsert.seed_report(store.read(), seed).first()
    assert (report["inserted"], report["updated"]) == (3, 0)
    store.write(upsert.seed_upsert(store.read(), seed))
    first = store.read().orderBy("id").collect()
    assert [(r["id"], r["record_id"], r["name_normalized"]) for r in first] == [(1, 20, "jane tan"), (2, 10, "omar ito"), (3, 5, "bob")]
    assert first[0]["company_name"] == 'Acme, "Inc"' and first[0]["email"] == "jane@x.com"
    assert first[0]["create_date"] == "2026-06-04T00:00:00" and first[0]["source_channel"] == "Event"
    assert upsert.seed_report(store.read(), seed).first()["updated"] == 3
    store.write(upsert.seed_upsert(store.read(), seed))
    assert store.read().orderBy("id").collect() == first
    assert len(store.snapshots()) == 2


def test_seed_with_a_key_twice_changes_nothing(spark, tmp_path):
    folder = tmp_path / "seed"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([HEADER, seed_line("1", "A", "", ""), seed_line("1", "B", "", "")]))
    seed = normalize_seed(files.read_seed_csv(spark, str(folder)))
    with pytest.raises(ValueError, match="more than once: 1"):
        upsert.seed_upsert(spark.createDataFrame([], LEAD_SCHEMA), seed)


def test_failed_write_leaves_the_snapshot(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"))
    store.write(some(spark))
    with pytest.raises(Exception):
        store.write(some(spark).withColumn("notes", F.raise_error(F.lit("boom")).cast("string")))
    assert store.snapshots() == ["v00000001"] and store.read().count() == 4
    store.write(some(spark), "x-1")
    assert store.has_tag("x-1") and not store.has_tag("x-2")


def files_of(store, table="leads"):
    """Current data files: part -> names."""
    version, out = store.version(), {}
    for part, where in getattr(version, table).items():
        name = where[0] if table == "leads" else where
        folder = Path(store.path) / name / table / f"part={part}"
        out[part] = sorted(str(p.relative_to(store.path)) for p in folder.glob("*.parquet"))
    return out


def people(spark, n):
    return frame(spark, [lead(i, full_name=f"Ada{i} Stone{i}", email_normalized=f"ada{i}@stone.org", phone_normalized=f"9{i:07d}", name_normalized=f"ada{i} stone{i}", company_normalized="stone works", lead_status="New", source_channel="Event") for i in range(1, n + 1)])


def rows_of(spark, rows):
    fields = ["name", "email", "phone", "company", "message"]
    raw = spark.createDataFrame([(i, *[r.get(f) for f in fields]) for i, r in enumerate(rows, 1)], "seq long, " + ", ".join(f"{f} string" for f in fields))
    return normalize_submissions(raw)


def test_a_small_merge_leaves_other_files_alone(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"), width=10, key_parts=32)
    store.write(people(spark, 200))
    before, keys_before = files_of(store), files_of(store, "keys")
    batch = rows_of(spark, [{"email": "ada15@stone.org", "message": "Our website chat"}, {"phone": "90000123"}, {"name": "Ada7 Stone7", "company": "Stone Works", "phone": "+1 90000007", "email": "ada7@stone.com"}, {"name": "New One", "email": "new@one.org"}])
    want = merge_submissions(store.read(), batch)
    expected = sorted(want.leads.collect(), key=lambda r: r["id"])
    done = merge_into(store, batch, "x-1")
    assert sorted(store.read().collect(), key=lambda r: r["id"]) == expected and len(expected) == 201
    assert sorted(map(tuple, done.decisions.collect())) == sorted(map(tuple, want.decisions.collect()))
    after = files_of(store)
    assert {p for p in after if after[p] != before.get(p)} == {0, 1, 12, 20}
    same = [p for p, names in files_of(store, "keys").items() if names == keys_before.get(p)]
    assert len(same) > 20
    # the key table is that of the whole table
    keys = lambda df: sorted(map(tuple, df.select("kind", "value", "id").collect()))
    assert keys(store.keys()) == keys(lookup_keys(store.read(), "id"))
    # an older version can still be read, until it is given up
    first = store.snapshots()[0]
    assert store.read(first).count() == 200
    assert store.retain(1) == [first] and store.snapshots() == [f"v{2:08d}-x-1"]
    assert sorted(store.read().collect(), key=lambda r: r["id"]) == expected
    left = {str(p.relative_to(store.path)) for p in Path(store.path).glob("v*/leads/*/*.parquet")}
    assert left == {n for names in files_of(store).values() for n in names}


def test_batches_read_only_what_they_share_keys_with(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"), width=10, key_parts=32)
    store.write(people(spark, 200))
    rows = rows_of(spark, [{"email": "ada15@stone.org"}])
    found = store.related(rows)
    assert [tuple(r) for r in found.collect()] == [(1, "ada15@stone.org", 15)]
    assert len(found.inputFiles()) == 1
    got = store.get(found.select("id"))
    assert [r["id"] for r in got.collect()] == [15] and [f for f in got.inputFiles() if "/leads/" in f and "/leads/part=1/" not in f] == []


def test_large_batches_do_not_pass_through_the_driver(spark, tmp_path, monkeypatch):
    store = LeadStore(spark, str(tmp_path / "store"), width=10, key_parts=32)
    store.write(people(spark, 200))
    rows = rows_of(spark, [{"email": f"ada{i}@stone.org"} for i in (3, 15)])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = store.related(rows)
    assert "strategy=broadcast" in plan(found) and "strategy=broadcast" in plan(store.get(found.select("id")))
    monkeypatch.setattr(scratch, "FEW", 1)
    many = store.related(rows)
    assert "strategy=merge" in plan(many) and "strategy=merge" in plan(store.get(many.select("id")))
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, found.collect()))


def test_many_updates_equal_one_table(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"), width=4, key_parts=4)
    table = spark.createDataFrame([], LEAD_SCHEMA)
    for step in range(3):
        batch = rows_of(spark, [{"name": f"Bo{(i * 7 + step) % 9} Li", "email": f"bo{(i + step) % 6}@li.org" if i % 3 else None, "company": "Li"} for i in range(8)])
        table = spark.createDataFrame(merge_submissions(table, batch).leads.collect(), LEAD_SCHEMA)
        merge_into(store, batch)
        assert sorted(map(tuple, store.read().collect()), key=repr) == sorted(map(tuple, table.collect()), key=repr)


def test_pages_and_searches_read_their_parts_only(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"), width=10)
    df = people(spark, 95).unionByName(frame(spark, [lead(200, full_name="Zoë Quillfeather", notes="x"), lead(201, full_name="ÀΣ Ünal_100%", contact_owner="Dan O_Hara", country="Peru")]))
    store.write(df)
    df = store.read()
    for offset in (0, 5, 50, 94, 96, 200):
        page = store.list_leads(limit=7, offset=offset)
        assert ids(page) == ids(query.list_leads(df, limit=7, offset=offset))
        assert len(page.inputFiles()) <= 2
    for given in ({"q": "quillf"}, {"q": "zoë q"}, {"q": "àσ"}, {"q": "ada1_"}, {"q": "stone9"}, {"q": "st%5@"}, {"q": "o_h"}, {"q": "e"}, {"owner": "hara"}, {"country": "PERU"}, {"status": "new", "q": "da33"}, {"q": "nowhere to be found"}, {"q": " ünal "}):
        assert ids(store.list_leads(**given, limit=200)) == ids(query.list_leads(df, **given, limit=200)), given
    assert len(store.list_leads(q="quillf").inputFiles()) == 1
    assert store.list_leads(q="nowhere to be found").inputFiles() == []


def test_counts_follow_what_versions_change(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "store"), width=10)

    def counted():
        shown = []
        run = store_counts(store).writeStream.outputMode("complete").foreachBatch(lambda df, i: shown.append(df.collect())).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
        run.awaitTermination()
        return sorted(map(tuple, shown[-1]))

    want = lambda: sorted(map(tuple, dashboard.dashboard(store.read()).collect()))
    store.write(people(spark, 30))
    assert counted() == want()
    merge_into(store, rows_of(spark, [{"email": f"ada{i}@stone.org", "message": "Referral from a partner."} for i in range(1, 31)] + [{"name": "New One"}]))
    assert counted() == want() and ("source_channel", "Event", 30) not in want()
    # a writer that ended between its commit and the publishing of its counts is made up for
    (Path(store.path) / "changes" / store.snapshots()[-1]).rename(Path(store.path) / store.snapshots()[-1] / "changes")
    store.publish()
    assert len(list((Path(store.path) / "changes").iterdir())) == 2


def test_missing_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Record ID,Email\n1,a\n")
    with pytest.raises(Exception, match="First Name"):
        files.read_seed_csv(spark, str(tmp_path)).collect()


def test_submission_csv(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    (good / "x.CSV").write_text("Full Name,First Name,Last Name,Email\n,Jane,Tan,a@b.c\nOmar Ito,x,y,\n,,,\n", encoding="utf-8")
    rows = files.read_submission_csv(spark, str(good)).orderBy("seq").collect()
    assert [(r["seq"], r["name"], r["email"], r["phone"], r["form_id"]) for r in rows[:2]] == [(1, "Jane Tan", "a@b.c", None, None), (2, "Omar Ito", None, None, None)]
    assert normalize_submissions(files.read_submission_csv(spark, str(good))).where("NOT identified").count() == len(rows) - 2
    for name, content in (("y.txt", b"Email\na\n"), ("z.csv", b"Email\n\xff\xfe\n")):
        bad = tmp_path / name.replace(".", "_")
        bad.mkdir()
        (bad / name).write_bytes(content)
        with pytest.raises(ValueError, match="not a CSV file in UTF-8"):
            files.read_submission_csv(spark, str(bad))


def test_submission_json(spark, tmp_path):
    (tmp_path / "b.json").write_text('[{"name": "B", "phone": 12, "extra": 1}, {"name": "C"}]')
    (tmp_path / "a.json").write_text('{"name": "A",\n "email": null}')
    rows = files.read_submission_json(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r["seq"], r["name"], r["phone"]) for r in rows] == [(1, "A", None), (2, "B", "12"), (3, "C", None)]
    (tmp_path / "c.json").write_text('[{"name": ')
    with pytest.raises(Exception):
        files.read_submission_json(spark, str(tmp_path)).collect()


def test_items_that_cannot_be_read_stay_with_their_reason(spark, tmp_path):
    items = '[{"name": "B", "phone": 6591234567, "extra": {"a": 1}}, 7, null, {"name": {"first": "x"}, "company": ["y"]}, "text", {"email": "c@d.e"}, {"country": "SG"}, [{}]]'
    (tmp_path / "a.json").write_text(items)
    (tmp_path / "b.json").write_text('  {"name": "A",\n "email": null}')
    (tmp_path / "c.json").write_text('[{"name": "cut off"}, {"name": ')
    raw = files.read_submission_json(spark, str(tmp_path), on_error="keep")
    got = [(r["seq"], r["name"], r["phone"], r["email"], r["error"]) for r in raw.orderBy("seq").collect()]
    none = (None, None, None)
    assert got == [
        (1, "B", "6591234567", None, None), (2, *none, "not an object"), (3, *none, "not an object"),
        (4, *none, "name is not a text, company is not a text"), (5, *none, "malformed JSON"), (6, None, None, "c@d.e", None),
        (7, *none, None), (8, *none, "not an object"), (9, "A", None, None, None), (10, *none, "malformed JSON"),
    ]
    done = merge_submissions(spark.createDataFrame([], LEAD_SCHEMA), normalize_submissions(raw))
    assert tuple(done.report().first()) == (10, 3, 0, 1, 6)
    messages = dict(map(tuple, done.messages().collect()))
    assert messages[2] == "Item 2: not an object" and messages[7] == "Item 7: no identifying fields" and len(messages) == 7
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"name": "A"}\nnot json\n\n{"name": ["x"]}\n{"email": "a@b.c"}\n')
    lines = files.read_submission_lines(spark, str(folder), on_error="keep").orderBy("seq").collect()
    assert [(r["seq"], r["name"], r["error"]) for r in lines] == [(1, "A", None), (2, None, "malformed JSON"), (3, None, "name is not a text"), (4, None, None)]
    with pytest.raises(ValueError, match="on_error"):
        files.read_submission_json(spark, str(tmp_path), on_error="drop")


def test_arrays_in_splits_equal_arrays_read_whole(spark, tmp_path):
    odd = ['a "quoted" } name', "back\\\\slash", '\\\\"}{', "{[", "", "é漢}", 'ends with \\\\', None]
    rows = [{"name": odd[i % len(odd)], "email": f"x{i}@y.z", "extra": [{"a": {"b": "}"}}, {}], "message": "}" * (i % 5)} for i in range(400)]
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps(rows[:57], indent=2))
    (tmp_path / "c.json").write_text(" [ ] ")
    want = files.read_submission_json(spark, str(tmp_path)).orderBy("seq").collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("900b", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert files.read_submission_arrays(spark, str(tmp_path)).orderBy("seq").collect() == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.json").write_text('[{"name": "A"}, 7, {"name": "B"}, {"name": ["x"]}, {"email": "c@d.e"}, {"name": ')
    with pytest.raises(Exception):
        files.read_submission_arrays(spark, str(bad)).collect()
    kept = files.read_submission_arrays(spark, str(bad), on_error="keep").orderBy("seq").collect()
    assert [(r["name"], r["email"], r["error"] is not None) for r in kept] == [("A", None, False), (None, None, True), (None, None, True), (None, "c@d.e", False), (None, None, True)]


@pytest.mark.parametrize("lines", [False, True])
def test_a_stream_goes_on_past_bad_items(spark, tmp_path, lines):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    good = ['{"name": "Ada Stone", "email": "ada@stone.org"}', '{"name": [1]}', '{"country": "x"}', '{"name": "Bo Li"}']
    (inbox / "a.json").write_text("\n".join(good) if lines else "[" + ", ".join(good) + "]")
    run = stream_merge(spark, str(inbox), str(tmp_path / "store"), str(tmp_path / "progress"), lines=lines, on_error="keep", messages=str(tmp_path / "told"))
    run.awaitTermination()
    assert LeadStore(spark, str(tmp_path / "store")).read().count() == 2
    told = spark.read.parquet(str(tmp_path / "told" / "messages"))
    assert {r["message"] for r in told.collect()} == {"Item 2: name is not a text", "Item 3: no identifying fields"}
    report = spark.read.parquet(str(tmp_path / "told" / "reports")).first()
    assert (report["total_rows"], report["inserted"], report["skipped"], report["errors"]) == (4, 2, 1, 1)


def test_export_file(spark, tmp_path):
    rows = [lead(2, full_name=' a "q", b', notes="x\ny"), lead(1, email="", lead_score=3)]
    files.export_leads(frame(spark, rows), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    head = ",".join(EXPORT_FIELDS)
    body = text.replace(head + "\n", "")
    assert text.startswith(head) and body.startswith("1,1,,,,,,,") and ",3,,\n" in body
    assert '" a ""q"", b"' in body and '"x\ny"' in body


def test_stream_of_files_equals_batches_in_order(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    person = {"name": "Same Person", "email": "same@example.com", "company": "Example Co", "country": "Singapore"}
    batches = [
        [dict(person, message="Referral from a partner."), {"name": "API Test Person", "email": "api-test@example.com", "message": "Found us through organic google search."}],
        [dict(person, message="Manual - added after inbound phone call."), {"country": "x"}, {"name": "same person", "company": "Example Co"}],
    ]
    want = []
    for i, batch in enumerate(batches):
        (inbox / f"{i}.json").write_text(json.dumps(batch, indent=1))
        raw = spark.createDataFrame([(n, r.get("name"), r.get("email"), r.get("company"), r.get("country"), r.get("message")) for n, r in enumerate(batch, 1)], "seq bigint, name string, email string, company string, country string, message string")
        rows = [r.asDict() for r in normalize_submissions(raw).orderBy("seq").collect()]
        want, _ = plain.merge(want, rows)
    store = LeadStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        run = stream_merge(spark, str(inbox), store.path, str(tmp_path / "progress"), max_files=1)
        run.awaitTermination()
    got = [r.asDict() for r in store.read().orderBy("id").collect()]
    assert got == [{c: r.get(c) for c in LEAD_COLUMNS} for r in want]
    assert [n.partition("-")[2] for n in store.snapshots()] == ["submissions-0", "submissions-1"]
    found = query.list_leads(store.read(), q="api-test@example.com").collect()
    assert len(found) == 1 and found[0]["source_channel"] == "Organic Search"


def test_patches_fold_in_order(spark):
    schema = "id long, seq long, changes map<string, string>"
    patches = spark.createDataFrame(
        [(1, 2, {"owner": "b", "notes": None}), (1, 1, {"owner": "a", "status": "new"}), (2, 1, {}), (None, 1, {"owner": "c"})], schema
    )
    got = {r["id"]: r["changes"] for r in upsert.folded_patches(patches).collect()}
    assert got == {1: {"owner": "b", "notes": None, "status": "new"}}
    with pytest.raises(ValueError, match="more than once"):
        upsert.folded_patches(patches.where("id = 1").drop("seq"))


def test_case_folding_of_every_character(spark):
    from leadloom.functions.text import fold_case

    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c)]
    rows = spark.createDataFrame([(c, chr(c)) for c in codes], "code int, text string")
    got = {r["code"]: r["folded"] for r in rows.select("code", fold_case(F.col("text")).alias("folded")).collect()}
    # single characters that Spark's own case tables leave alone are no reason to give up the built-in functions
    wrong = [c for c in codes if got[c] != chr(c).casefold()]
    assert 0x1E9E not in wrong and 0xDF not in wrong and not [c for c in wrong if c < 0x250]


@pytest.mark.parametrize("read", [files.read_seed_csv, files.read_submission_csv])
def test_bad_bytes_are_refused(spark, tmp_path, read):
    header = ",".join(SEED_HEADERS)
    (tmp_path / "good.csv").write_bytes(f"{header}\n1{',' * (len(SEED_HEADERS) - 1)}\n".encode())
    assert read(spark, str(tmp_path)).count() == 1
    (tmp_path / "odd.csv").write_bytes(f"{header}\n2,An".encode() + b"\xe9" + b"," * (len(SEED_HEADERS) - 2) + b"\n")
    with pytest.raises(ValueError, match="odd.csv"):
        read(spark, str(tmp_path))


def test_columns_go_by_the_header_of_each_file(spark, tmp_path):
    names = list(SEED_HEADERS)
    for file, order in (("a.csv", names), ("b.csv", names[::-1])):
        (tmp_path / file).write_text(",".join(order) + "\n" + ",".join(f"{file[0]} {h}" for h in order) + "\n")
    got = files.read_seed_csv(spark, str(tmp_path)).orderBy("seq").collect()
    assert [{c: r[c] for c in SEED_HEADERS.values()} for r in got] == [
        {c: f"{f} {h}" for h, c in SEED_HEADERS.items()} for f in "ab"
    ]
    (tmp_path / "c.csv").write_text(",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match="missing"):
        files.read_seed_csv(spark, str(tmp_path))


def test_stream_of_lines_leaves_no_scratch(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = [json.dumps({"name": f"Ada Stone{i}", "email": f"ada{i}@stone.org", "company": "Stone"}) for i in range(4)]
    (inbox / "a.jsonl").write_text("\n".join(lines[:3]) + "\n\n")
    (inbox / "b.jsonl").write_text(lines[3])
    scratch = Path(shared_dir(spark)) / "leadloom"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    run = stream_merge(spark, str(inbox), str(tmp_path / "store"), str(tmp_path / "progress"), lines=True)
    run.awaitTermination()
    got = LeadStore(spark, str(tmp_path / "store")).read().orderBy("id").collect()
    assert [r["email"] for r in got] == [f"ada{i}@stone.org" for i in range(4)]
    assert not set(scratch.iterdir()) - before


def test_json_files_are_parsed_once(spark, tmp_path):
    """Counting the items of each file and numbering them read what was parsed, not the files again."""
    (tmp_path / "a.json").write_text('[{"name": "Jane Tan"}, {"name": "Wei Lim"}]')
    reads = [files.read_submission_arrays, files.read_submission_json]
    for read in reads + [lambda *args, r=r: r(*args, on_error="keep") for r in reads]:
        rows = read(spark, str(tmp_path))
        assert [r["name"] for r in rows.orderBy("seq").collect()] == ["Jane Tan", "Wei Lim"]
        assert str(tmp_path) not in " ".join(rows.inputFiles())
