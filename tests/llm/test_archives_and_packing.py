import base64
import hashlib
from collections import defaultdict

import numpy as np
import pytest

import small
from leadloom.llm import packing, warc
from leadloom.sources.scratch import new_folder

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "u\r\nX: y", ""), (4, "u", None),
    (5, "u", "é漢" * 9000), (6, "u", "é漢" * 9000), (7, "u", "WARC/1.1\r\n\r\n0\r\n\r\n"), (None, "u", "<p>one</p>"), (8, "u", "x" * 16000),
    (5, "u", "é漢" * 9000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    path = new_folder(spark, "warc")
    warc.write_archives(pages, path, min_revisit_bytes=least)
    got = warc.read_pages(spark, path).collect()
    best = defaultdict(lambda: -1)
    for i, _, text in PAGES:
        best[digest(text)] = max(best[digest(text)], i or -1)
    want = []
    for i, _, text in PAGES:
        d = digest(text)
        again = len((text or "").encode()) >= least and i != best[d]
        want.append((i, len((text or "").encode()), d, "revisit" if again else "response", best[d] if again else None))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(want, key=repr)


def test_broken_segments_have_no_payload(spark):
    parts = [bytes(p) for p in warc.records_of(1, "u", b"y" * 50_000, None, 4096)]
    assert len(parts) > 10
    whole, short = parts, parts[:3] + parts[4:]
    rows = [(n, f) for f, group in (("a", whole), ("b", short)) for n in group]
    table = []
    for data, origin in rows:
        (fields, block), = warc._parsed(data)
        table.append((origin, None, int(fields["warc-segment-number"]), int(fields.get("warc-segment-total-length") or 0) or None, block))
    table.append(table[1])  # a segment that is there twice
    records = spark.createDataFrame(table, "record_id string, origin string, number int, total long, block binary")
    got = {r["record_id"]: r for r in warc.reassemble(records).collect()}
    assert got["a"]["payload"] == b"y" * 50_000 and got["a"]["payload_bytes"] == 50_000
    assert got["b"]["payload"] is None and got["b"]["payload_digest"] is None


def test_chunked_framing():
    assert warc.unchunked(b"3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n") == b"abcde"
    assert warc.unchunked(b"0\r\n\r\n") == b"" and warc.unchunked(b"0\r\nTrailer: x\r\n\r\n") == b""
    for broken in (b"", b"3\r\nab\r\n0\r\n\r\n", b"z\r\nabc\r\n", b"3\r\nabc\r\n", b"-3\r\nabc\r\n0\r\n\r\n"):
        assert warc.unchunked(broken) is None


def test_no_pages(spark):
    path = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_pages(spark, path).count() == 0


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_PIECES", 25)
    docs = small.documents(spark)
    lengths = (16, 64, 256)
    got = packing.pack(docs, lengths).collect()
    tokens = sorted(len(small.SPACED.findall(r["text"] or "")) + 1 for r in docs.collect())
    by = defaultdict(list)
    for r in got:
        by[r["sequence"]].append(r)
    assert sorted(r["n_pieces"] for r in got if r["piece"] == 0) == sorted(-(-t // 256) for t in tokens)
    assert sum(r["size"] for r in got) == sum(tokens)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["size"]
        assert at == rows[0]["filled"] and rows[0]["capacity"] == min(c for c in lengths if c >= at)
    assert packing.pack(small.documents(spark, []), lengths).count() == 0
    whole = packing.sequences(packing.pack(docs, lengths))
    assert whole.agg({"filled": "sum"}).first()[0] == sum(tokens)


def test_cheapest_plan_is_taken():
    costs = packing.costs_of((8, 16, 32))
    sizes = np.array(sorted([8, 8, 5, 3, 3, 2, 30, 16, 9, 7], reverse=True))
    cost, bins, starts, contents, final = packing.pack_part(sizes, (8, 16, 32), costs)
    assert cost == min(packing._plan(sizes, (8, 16, 32), costs, p)[0] for p in (0, 8, 16, 32))
    assert contents.sum() == sizes.sum() and (final >= contents).all()
