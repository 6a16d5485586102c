import hashlib
import re
import signal
from collections import Counter, defaultdict

import pytest

import small
from leadloom.llm import exact_dedup, sharding


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


@pytest.mark.parametrize("hot", [3, 4096])
def test_exact_groups(spark, monkeypatch, hot):
    # with 4096 every content that repeats is cut into pieces, with 3 none
    monkeypatch.setattr(exact_dedup, "HOT_PARTS", hot)
    docs = small.documents(spark)
    rows = docs.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r["text"])].append(r)
    want = {k: min(v, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))["doc_id"] for k, v in groups.items()}
    got = exact_dedup.exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["text_sha256"], r["group_size"], r["keep_id"]) for r in got) == Counter(
        (r["doc_id"], hashlib.sha256(norm(r["text"]).encode()).hexdigest(), len(groups[norm(r["text"])]), want[norm(r["text"])])
        for r in rows
    )
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    whole = exact_dedup.exact_survivors(docs)
    assert whole.columns == docs.columns
    assert small.ids(r["doc_id"] for r in whole.collect()) == small.ids(r["doc_id"] for r in kept)


def test_nothing_to_do(spark):
    empty = small.documents(spark, [])
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.exact_survivors(empty).count() == 0
    assert sharding.shard_documents(empty).count() == 0


@pytest.mark.parametrize("shards", [3])
def test_shards(spark, shards):
    docs = small.documents(spark)
    got = sharding.shard_documents(docs, shards).collect()
    assert sorted(map(repr, (r["row"] for r in got))) == sorted(map(repr, docs.collect()))
    by = defaultdict(list)
    for r in got:
        assert r["size"] == len((r["row"]["text"] or "").encode()) + 1
        by[r["shard"]].append(r)
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    largest = max(r["size"] for r in got)
    sizes = [sum(r["size"] for r in by[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 2 * largest + 0.1 * sum(sizes) / shards


def test_rows_that_are_all_alike_are_split(spark):
    docs = spark.createDataFrame([(7, "same text")] * 400, "doc_id long, text string").repartition(5)
    got = sharding.shard_documents(docs, 4).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [100, 100, 100, 100]


@pytest.mark.parametrize("null_id", [False, True])
def test_few_equal_rows_in_more_ranges_than_rows(spark, null_id):
    # one row in the first partition and two in the second: a place has a bin of its own, the others share one
    def late(signum, frame):
        raise TimeoutError("no splitters")

    one = (None if null_id else 7, "same text")
    docs = spark.createDataFrame(spark.sparkContext.parallelize([one] * 3, 2), "doc_id long, text string")
    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(60)
    try:
        got = sharding.shard_documents(docs, 8).collect()
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)
    assert [tuple(r["row"]) for r in got] == [one] * 3
    assert len({(r["shard"], r["slot"]) for r in got}) == 3
