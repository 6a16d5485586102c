import random
import re

import numpy as np
import pytest

import small
from leadloom.llm import decontamination, jaccard_join


def sets_of(text, k):
    words = small.SPACED.findall(small.lowered(text))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def components(rows, k, percent):
    label = list(range(len(rows)))
    found = [sets_of(t, k) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = found[i], found[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    out = []
    for i, (id, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((id, len(found[i]), min(members, default=None) if found[i] else id))
    return sorted(out, key=repr)


# a region of 60 elements is already large for a task, so that the rounds over slices run
@pytest.mark.parametrize("region, how", [(60, (4, 85)), (jaccard_join.REGION_ELEMENTS, (5, 80))])
def test_components_equal_all_pairs(spark, monkeypatch, region, how):
    monkeypatch.setattr(jaccard_join, "REGION_ELEMENTS", region)
    monkeypatch.setattr(jaccard_join, "ROUND_PIVOTS", 3)
    docs = small.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = jaccard_join.near_duplicates(docs, jaccard_join.Similarity(*how)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components(rows, *how)


def test_region_is_joined_like_all_pairs():
    # the work inside a task, over many random groups and looser similarities
    r = random.Random(3)
    for percent in (50, 70, 85):
        for _ in range(60):
            base = [np.array(r.sample(range(400), r.randint(3, 60)), np.uint64) for _ in range(4)]
            sets = []
            for b in base:
                for _ in range(r.randint(1, 8)):
                    own = set(b.tolist()) ^ set(r.sample(range(400), r.randint(0, 8)))
                    sets.append(np.array(sorted(own | {1}), np.uint64))
            want = list(range(len(sets)))
            for i in range(len(sets)):
                for j in range(i):
                    a, b = set(sets[i].tolist()), set(sets[j].tolist())
                    if 100 * len(a & b) >= percent * len(a | b):
                        want = [want[j] if x == want[i] else x for x in want]
            got = list(range(len(sets)))
            for x, y in jaccard_join._join_region(sets, jaccard_join.Similarity(4, percent)):
                got = [got[x] if v == got[y] else v for v in got]
            same = lambda label: [[a == b for a in label] for b in label]
            assert same(got) == same(want)


def test_no_documents(spark):
    assert jaccard_join.near_duplicates(small.documents(spark, [])).count() == 0


ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return ALNUM.findall(small.lowered(text).encode())


def brute(rows, items, length=10):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(length, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(name)
    out = []
    for id, text in rows:
        w, hits, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                names = windows.get(tuple(w[k : k + size]))
                if names:
                    hits.update(range(k, k + size))
                    found |= names
        out.append((id, len(w), sorted(hits), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group, block", [(20, 600), (decontamination.GROUP_WORDS, decontamination.BLOCK_BYTES)])
def test_hits_equal_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(decontamination, "GROUP_WORDS", group)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    r = random.Random(5)
    docs = small.documents(spark)
    rows = [(d["doc_id"], d["text"]) for d in docs.collect()]
    long = [t for _, t in rows if t and len(t.split()) > 30]
    cut = [t.split() for t in r.sample(long, 6)]
    given = [" ".join(w[5:18]).upper().replace(" ", "--") for w in cut] + ["alpha", "", None, "beta3 gamma", "no such words in any text at all so none is hit", "straße 漢字"]
    given += [given[0]]
    items = [(i, t) for i, t in enumerate(given)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, tokens string")
    got = decontamination.decontaminate(docs, frame)
    assert sorted(((g["doc_id"], g["n_words"], g["hits"], sorted(g["items"])) for g in got.collect()), key=repr) == brute(
        rows, [(str(i), t) for i, t in items]
    )
    flat = decontamination.report(got)
    assert flat.where("contaminated <> (n_hit > 0)").isEmpty()


def test_nearby_words_match_within_reach(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one two three four"), (3, "one four two three")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "one two three four")], "item_id string, text string")
    found = lambda slop: {r["doc_id"]: r["hits"] for r in decontamination.decontaminate(docs, items, slop=slop).collect()}
    assert found(0) == {1: [], 2: [0, 1, 2, 3], 3: []}
    assert found(1)[1] == [0, 1, 3, 4]


def test_no_items_and_no_documents(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.decontaminate(small.documents(spark), items).collect()
    assert len(got) == small.documents(spark).count() and not any(r["hits"] for r in got)
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert decontamination.decontaminate(small.documents(spark, []), some).count() == 0
