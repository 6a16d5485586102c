import random

import numpy as np
import pytest

import small
from leadloom.llm import stages, toxicity

FIELDS = "doc_id long, text string, row_key string, `a.b` double, _key string, evidence string"


def table(spark, folder, rows, name):
    spark.createDataFrame(*rows).write.parquet(f"{folder}/{name}.parquet")


def folder_of(spark, tmp_path, texts, labels=(), items=()):
    folder = str(tmp_path)
    docs = [(i, t, f"r{n}", 0.5, f"k{n}", "clash") for n, (i, t) in enumerate(texts)]
    table(spark, folder, (docs, FIELDS), "documents")
    table(spark, folder, (list(labels), "doc_id long, quality int, toxic int"), "labels")
    table(spark, folder, (list(items), "item_id long, text string"), "benchmark")
    return folder, spark.read.parquet(f"{folder}/documents.parquet")


def labelled(texts, toxic):
    return [(i, 1, int(i in toxic)) for i, _ in texts]


def trial(spark, tmp_path, make, n=1600):
    """Train on texts of ``make(r, toxic)``; share right on held-out ones, and the machine."""
    r = random.Random(4)
    toxic = set(range(1, n, 2))
    texts = [(i, make(r, i in toxic)) for i in range(n)]
    folder, docs = folder_of(spark, tmp_path, texts, labelled(texts, toxic))
    machine = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))
    from zlib import crc32

    got = {x["doc_id"]: x["score"] for x in toxicity.score(docs, machine).collect()}
    held = [i for i in got if crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(got[i] >= 0.5) == (i in toxic) for i in held])
    return right, machine, stages.without_toxic(spark, docs, folder)


def test_nothing_is_deleted_where_nothing_tells_texts_apart(spark, tmp_path):
    right, machine, kept = trial(spark, tmp_path, lambda r, toxic: small.prose(r, 25), 200)
    assert machine.landmarks == [] and kept.count() == 200


def test_phrases_whose_words_tell_nothing(spark, tmp_path):
    def make(r, toxic):
        words = small.prose(r, 25).split()
        bad, good = "you are worthless", r.choice(["worthless coupon", "you are welcome", "are you there"])
        words.insert(r.randrange(len(words)), bad if toxic else good)
        return " ".join(words)

    right, machine, kept = trial(spark, tmp_path, make)
    assert right > 0.9 and machine.phrases


def test_many_rare_insults(spark, tmp_path):
    letters = random.Random(9)
    insults = ["".join(letters.choice("bcdfgklmprstz") + letters.choice("aeiou") for _ in range(4)) for _ in range(300)]

    def make(r, toxic):
        words = small.prose(r, 25).split()
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(insults))
        return " ".join(words)

    right, machine, kept = trial(spark, tmp_path, make)
    assert len(machine.landmarks) > 100 and right > 0.8
    assert kept.where("doc_id % 2 = 0").count() > 0.95 * 800


def check_columns(got, docs):
    assert got.columns == docs.columns
    known = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in known for r in got.collect())


STAGES = [stages.without_toxic, stages.without_copies, stages.without_near_copies, stages.without_benchmark]


@pytest.mark.parametrize("stage", STAGES)
def test_stages_pass_odd_rows_and_columns(spark, tmp_path, stage):
    r = random.Random(2)
    long = small.prose(r, 6000)
    texts = [(1, "one two three four five six"), (1, "one two three four five six"), (None, "a text without an id here"), (3, None), (4, ""), (5, long), (6, " \n")]
    folder, docs = folder_of(spark, tmp_path, texts, items=[(0, "nothing of this stands in any of the texts at all")])
    got = stage(spark, docs, folder)
    check_columns(got, docs)
    kept = [x["doc_id"] for x in got.collect()]
    # copies only go where copies go
    once = stage in (stages.without_copies, stages.without_near_copies)
    empty = 1 if stage is stages.without_copies else 3
    assert kept.count(1) == (1 if once else 2) and None in kept and 5 in kept
    assert sum(i in (3, 4, 6) for i in kept) == empty
    none = spark.createDataFrame([], docs.schema)
    assert stage(spark, none, folder).count() == 0
    assert stages.packed(spark, none, folder).count() == 0


@pytest.mark.parametrize("stage", [stages.without_near_copies, stages.without_benchmark])
def test_rows_that_are_alike_in_id_and_text_keep_their_columns(spark, tmp_path, stage):
    passage = small.prose(random.Random(1), 12)
    texts = [(7, passage), (7, small.prose(random.Random(2), 30)), (None, small.prose(random.Random(3), 30)), (8, small.prose(random.Random(4), 30))]
    folder, docs = folder_of(spark, tmp_path, texts, items=[(0, passage)])
    got = stage(spark, docs, folder).collect()
    assert sorted(x["row_key"] for x in got) == (["r0", "r1", "r2", "r3"] if stage is stages.without_near_copies else ["r1", "r2", "r3"])
    # what is not read from files is numbered all the same
    apart = stage(spark, docs.repartition(2).withColumn("row_key_", docs["row_key"]), folder)
    assert sorted(x["row_key"] for x in apart.collect()) == sorted(x["row_key"] for x in got)
