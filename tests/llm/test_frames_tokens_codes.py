import hashlib
import os
import random
import re

import numpy as np
import pytest

import compare
import small
from leadloom.llm import bpe_tree, fill_middle, vector_codes

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


# ---- fill in middle


def middle_of(id, text):
    """The rule, unit by unit: (n, form, prefix, middle, suffix, output)."""
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), sha(f"1:{'' if id is None else id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MARKED = ["a <P> b", "<S>", "x<M>", "<P", "a<", "<<S", "é<P>", "P> <S <M", "\u0000\u0001 a", "z" * 90, "é" * 70, "a漢b" * 40, "\U0001f600x" * 30]


@pytest.mark.parametrize("size", [3, 16, 1 << 15])
def test_cuts_outputs_and_texts(spark, size):
    docs = small.documents(spark, small.texts() + MARKED * 4)
    stored = fill_middle.store(docs, frame_bytes=size)
    got = fill_middle.texts(fill_middle.transform(stored, frame_bytes=size)).collect()
    want = []
    for r in docs.collect():
        n, form, prefix, middle, output = middle_of(r["doc_id"], r["text"])
        want.append((r["doc_id"], n, form, prefix, middle, sha(output), sha(r["text"] or ""), output))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_frames_are_independent_and_bounded(spark):
    import zstandard

    text = "word é漢 " * 500 + "x" * 1000
    rows = [("a1", text, 1), (None, None, 2), ("a1", "", 3)]
    stored = fill_middle.store(spark.createDataFrame(rows, "doc_id string, text string, frames int"), frame_bytes=64).collect()
    assert sorted(len(r["frames"]) for r in stored)[:2] == [0, 0] and {r["id"] for r in stored} == {"a1", None}
    frames = max((r["frames"] for r in stored), key=len)
    parts = [zstandard.ZstdDecompressor().decompress(bytes(f["data"])) for f in reversed(frames)][::-1]
    assert all(len(p) <= 64 and p.decode() for p in parts) and b"".join(parts).decode() == text
    for f, before in zip(frames, np.cumsum([0, *map(len, parts)])):
        assert f["at"] == before and f["points"] == len(text.encode()[:before].decode())
    # units before a frame: those that begin before it
    starts = np.cumsum([0, *(len(u.encode()) for u in UNIT.findall(text))])[:-1]
    assert [f["units"] for f in frames] == [int((starts < f["at"]).sum()) for f in frames]
    own = fill_middle.Frames([{**f.asDict(), "data": bytes(f["data"])} for f in frames], len(starts), len(text), len(text.encode()))
    for k in range(0, len(starts) + 2, 7):
        head = "".join(UNIT.findall(text)[:k])
        assert own.cut(k) == (len(head.encode()), len(head))


def test_only_frames_with_cuts_are_opened_for_selection(monkeypatch):
    text = ("some words " * 4000).encode()
    batch = fill_middle.pa.RecordBatch.from_arrays([fill_middle.pa.array([text.decode()])], ["text"])
    units, points, size, frames = (c[0].as_py() for c in fill_middle._compressed(batch, 1024))
    own, opened = fill_middle.Frames(frames, units, points, size), []
    inner = own._frame
    monkeypatch.setattr(own, "_frame", lambda i: opened.append(i) or inner(i))
    own.cut(5000), own.cut(units), own.cut(0)
    assert len(opened) == 2


def test_middles_of_no_rows(spark):
    stored = fill_middle.store(spark.createDataFrame([], "doc_id long, text string"))
    assert fill_middle.texts(fill_middle.transform(stored)).collect() == []


# ---- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_tree.default_path())


ALPHABETS = ["ab", "a", "thein", "éàß", "!?-", "aA1 ", "漢字", "the <|endoftext|>", "é ", "İi̇J̌", "Σσς ", "\x1c\x85\xa0 a", "lo", "0a", "'s re", "\x7f\x01aB!", "<|end of text|> X", "'S 'tT've9!", "ÀéßÿÞx'É9!", "×÷ªµé", "e\u0301Éa"]


@pytest.mark.parametrize("seed", range(4))
def test_trees_equal_the_library(library, seed):
    r = random.Random(seed)
    for alphabet in ALPHABETS * 3:
        own = bpe_tree.encoder(bpe_tree.default_path(), r.choice([3, 16, 64]), r.choice([1, 2, 4]))
        text = "".join(r.choice(alphabet) for _ in range(r.choice([1, 40, 300, 1500])))
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe_tree._flat([w[0] for w in own.encode([text.encode()])[0]]) == want
        parts = [(k, bpe_tree._encoded_part(k, d, own)) for k, d in bpe_tree.parts_of(text.encode(), own, r.choice([10, 50, 700]))]
        assert bpe_tree.joined_parts(parts, own) == want
        assert bpe_tree.decoder(bpe_tree.default_path()).text(want) == library.decode(want, skip_special_tokens=False)


def test_memory_is_bounded_and_keeps_what_is_used():
    memory = bpe_tree.Memory(3)
    for i in range(50):
        for key in memory.missing(["often", f"w{i}"]):
            memory.new[key] = key
        assert "often" in memory.new and len(memory.new) + len(memory.old) <= 10


def test_windows_grow_until_both_sides_agree(library):
    """Joins of all splits of one unsplit text, with a window of one token."""
    own = bpe_tree.encoder(bpe_tree.default_path(), 4096, 1).join
    for text in ("internationalization" * 3, "a" * 61, "aab" * 20, "thethethe" * 5):
        want = library.encode(text, add_special_tokens=False).ids
        for at in range(len(text)):
            assert own.joined(own._plain(text[:at], False), own._plain(text[at:], True), True) == want


@pytest.mark.parametrize("part, leaf", [(bpe_tree.PART_BYTES, bpe_tree.LEAF), (60, 16)])
def test_encoded_and_decoded_rows(spark, library, part, leaf):
    r = random.Random(3)
    docs = small.documents(spark, small.texts() + ["".join(r.choice(a) for _ in range(400)) for a in ALPHABETS] + [" " * 500])
    got = bpe_tree.decode(bpe_tree.encode(docs, bpe_tree.default_path(), part_bytes=part, leaf=leaf), bpe_tree.default_path()).collect()
    digests = bpe_tree.encode(docs, bpe_tree.default_path(), digests=True, part_bytes=part, leaf=leaf).collect()
    want, want_digests = [], []
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((row["doc_id"], len(ids), ids, text))
        want_digests.append((row["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(text)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, digests), key=repr) == sorted(want_digests, key=repr)


def test_tokens_of_odd_tables(spark):
    path = bpe_tree.default_path()
    assert bpe_tree.encode(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
    named = spark.createDataFrame([("a1", "Hello", 7, "k"), (None, None, 7, "k")], "doc_id string, text string, ids int, key string")
    got = {x["id"]: x["n_tokens"] for x in bpe_tree.encode(named, path).collect()}
    assert got == {"a1": 1, None: 0}
    with pytest.raises(ValueError):
        bpe_tree.Encoder(path.replace("word_bpe_49k", "byte_bpe_50k"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_tokens_equal_the_library(spark, library):
    from leadloom.llm import registry

    got = {r["doc_id"]: tuple(r)[1:] for r in registry.queries()["op12_bpe_tree"](spark, SF).collect()}
    rows = compare.connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(got) == len(rows)
    for id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[id] == (len(ids), sha(" ".join(map(str, ids))), sha(text))


# ---- vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """All distances, in whole numbers: {row place: (code, error)}, and the digest of the codebooks."""
    kept = [i for i, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    x = [[int(np.floor(4096 * float(np.float32(c)))) for c in rows[i][1]] for i in kept]
    width = len(x[0]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    x = [cut(v) for v in x]
    books = [[v[p] for v in x[:entries]] for p in range(parts)]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b))
    nearest = lambda p, v: min(range(len(books[p])), key=lambda j: (far(v, books[p][j]), j))
    for _ in range(rounds):
        own = [[nearest(p, v[p]) for p in range(parts)] for v in x]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [v[p] for v, o in zip(x, own) if o[p] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = {}
    for i, v in zip(kept, x):
        own = [nearest(p, v[p]) for p in range(parts)]
        out[i] = ("".join(f"{o:02x}" for o in own), sum(far(v[p], books[p][o]) for p, o in enumerate(own)))
    flat = [c for p in books for e in p for c in e]
    return out, sha(",".join(map(str, flat)))


def check_codes(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, label int, x string, bounds int").repartition(3)
    got = vector_codes.compress(table).collect()
    codes, digest = plain_codes(rows)
    by_label = {}
    for i, (_, error) in codes.items():
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + error
    want = [(rows[i][0], code, error, by_label[rows[i][2]], digest) for i, (code, error) in codes.items()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_codes_equal_plain_distances(spark):
    r = random.Random(5)
    centres = [[r.gauss(0, 0.3) for _ in range(16)] for _ in range(20)]
    rows = [(i, [c + r.gauss(0, 0.08) for c in r.choice(centres)], r.choice([0, 0, 0, 1, 2, None])) for i in range(20, 420)]
    rows = [(i, [float(np.float32(c)) for c in v], k) for i, v, k in rows]
    rows += [rows[5], (3, None, 1), (4, [0.5] * 15 + [None], 1), (5, [float("nan")] + [0.0] * 15, 0), (6, [float("inf")] + [0.0] * 15, 9)]
    rows += [(None, [0.25] * 16, None), (7, [0.0] * 16, 11), (8, [0.0] * 16, 12)]
    check_codes(spark, rows)


def test_codes_with_ties_and_few_rows(spark):
    r = random.Random(6)
    check_codes(spark, [(i, [float(r.choice([-1, 0, 1])) for _ in range(8)], i % 2) for i in range(60)])
    check_codes(spark, [(i, [float(i)] * 8, None) for i in range(3)])


def test_codes_of_no_rows_and_other_ids(spark):
    fields = "vec_id string, embedding array<double>, label string"
    assert vector_codes.compress(spark.createDataFrame([], fields)).collect() == []
    odd = [("a", [1.0] * 9, "x"), ("b", [2.0] * 9, None), ("c", [2.0] * 8, None), ("d", [], "y"), ("e", [1e300] * 9, "z")]
    got = {r["vec_id"]: r["code"] for r in vector_codes.compress(spark.createDataFrame(odd, fields)).collect()}
    assert set(got) == {"a", "b", "e"} and len(set(got.values())) == 3


def test_bounds_spare_distances_and_change_nothing():
    r = np.random.default_rng(2)
    centres = r.normal(0, 2000, (16, 4, 3))
    x = np.floor(centres[r.integers(0, 16, 3000)] + r.normal(0, 150, (3000, 4, 3))).astype(np.int64)
    history = [x[:16].swapaxes(0, 1).copy()]
    bounds, scanned = None, []
    for t in range(7):
        bounds, done = vector_codes.assigned(x, bounds, history)
        fresh, _ = vector_codes.assigned(x, None, history)
        assert (bounds["entry"] == fresh["entry"]).all()
        scanned.append(done["scanned"])
        now = history[-1].copy()
        for p in range(4):
            for j in range(16):
                mine = x[bounds["entry"][:, p] == j, p]
                if len(mine):
                    now[p, j] = mine.sum(0) // len(mine)
        history.append(now)
    assert scanned[0] == 12_000 and scanned[-1] < 3_000


def test_true_displacement_is_never_more_than_drifts():
    r = np.random.default_rng(3)
    history = [r.integers(-50, 50, (2, 5, 3))]
    for _ in range(5):
        history.append(history[-1] + r.integers(-9, 10, (2, 5, 3)))
    net, _ = vector_codes.displacements(history)
    moves = [np.sqrt(((b - a).astype(float) ** 2).sum(-1)) for a, b in zip(history, history[1:])]
    for s in range(6):
        assert (net[s] <= sum(moves[s:], np.zeros((2, 5))) + 1e-6).all()


def test_large_components_stay_exact():
    x = np.array([[1 << 24, -(1 << 24)] * 64, [(1 << 24) - 1, 1 - (1 << 24)] * 64])
    entries = np.array([[-(1 << 24), 1 << 24] * 64, [0] * 128])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)) for e in entries] for v in x]
    assert vector_codes._squares(x, entries).tolist() == want
