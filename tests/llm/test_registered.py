import os

import pytest

import compare
from leadloom.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(registry.oracles()))
def test_query_equals_its_sql(spark, name):
    assert compare.differences(registry.queries()[name](spark, SF), compare.connect(SF), registry.oracles()[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    """Planted cases: copies, near copies, benchmark passages and toxic texts go, all else stays."""
    import random

    import corpus_pipeline
    import small

    r = random.Random(8)
    clean = {i: small.prose(r, r.randint(30, 60)) for i in range(1, 301)}
    bad = ["scumbag", "dimwit", "numbskull"]
    toxic = {}
    for i in range(301, 421):
        words = small.prose(r, 30).split()
        for _ in range(3):
            words.insert(r.randrange(len(words)), r.choice(bad))
        toxic[i] = " ".join(words)
    passage = small.prose(r, 14)
    planted = {500: clean[1].replace(" ", "  "), 501: small.near(r, clean[2], 1), 502: clean[3] + " " + passage + " " + clean[4]}
    rows = {**clean, **toxic, **planted, 503: "", 504: None}
    folder = str(tmp_path)
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in [*clean, *toxic]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = {x["doc_id"] for x in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect()}
    # the copy of 1 has more code points, so it is the one that stays
    assert got == (set(clean) - {1}) | {500, 503}
