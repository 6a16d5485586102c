import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import small
from leadloom.llm import html_extraction as html
from leadloom.llm import language_model, license_scan, toxicity, words


def test_words_are_the_same_as_plain_ones():
    values = small.texts() + ["a" * (1 << 20) + " b"]
    hashes, at = words.words(pa.array(values))
    for i, text in enumerate(values):
        want = [words.word_hash(w) for w in small.SPACED.findall(small.lowered(text))]
        assert hashes[at[i] : at[i + 1]].view(np.int64).tolist() == want


def test_kernel_equals_plain_sum_over_subsequences():
    def weights(s, k):
        out, decay = Counter(), toxicity.DECAY
        def walk(start, first, chosen):
            if len(chosen) == k:
                out[chosen] += decay ** (start - first)
                return
            for i in range(start, len(s)):
                walk(i + 1, i if first < 0 else first, chosen + s[i])
        walk(0, -1, "")
        return out

    for a, b in [("idiot", "idxiot"), ("moron", "morron"), ("abcab", "bacba"), ("trash", "crash")]:
        left, right = weights(a, toxicity.ORDER), weights(b, toxicity.ORDER)
        want = sum(v * right[u] for u, v in left.items())
        got = toxicity.kernel(toxicity.codes([a]), toxicity.codes([b]))[0]
        assert math.isclose(got, want, rel_tol=1e-4, abs_tol=1e-6)


def test_shared_lengths():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    strings = ["^^idiot$$", "^^theidiots$$", "abc", "^^", "漢字idio", "^^tiodi$$"]
    mark = "^^idiot$$"
    assert toxicity.shared_lengths(toxicity.codes(strings), toxicity.codes([mark])[0]).tolist() == [lcs(s, mark) for s in strings]


def toxic_corpus(spark):
    import random

    r = random.Random(2)
    rows = []
    for i in range(600):
        toxic = i % 4 == 0
        text = small.prose(r, r.randint(5, 40)).split()
        if toxic:
            for _ in range(2):
                text.insert(r.randrange(len(text)), r.choice(["scumbag", "dimwit", "numbskull"]))
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, evidence string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(9999, 1, None), (3, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity(spark):
    docs, labels, truth = toxic_corpus(spark)
    machine = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, y in truth.items())
    odd = ["a dim-wit and a d i m w i t", "you dimmwit you dimxwit dimwitt", "", None, "  ", "alpha3 beta4", "x" * 100_000]
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in toxicity.score(frame, machine).collect()}
    assert found[0] >= 0.5 and found[1] >= 0.5
    assert found[2] == found[3] == found[4] < 0.5 and found[5] < 0.5 and found[6] < 0.5
    kept = toxicity.keep_clean(docs, machine)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, y in truth.items() if not y}


def test_many_rare_insults(spark):
    import random

    r = random.Random(11)
    # each in fewer than 2 % of the toxic texts, some alike at their ends, some in other scripts
    letters = "bcdfghjklmnpqrstvwxz"
    insults = ["".join(r.choice(letters) + r.choice("aeiou") for _ in range(2)) + "head" for _ in range(50)]
    insults += ["".join(chr(0x430 + r.randrange(32)) for _ in range(7)) for _ in range(10)]
    rows = []
    for i in range(1500):
        text = small.prose(r, r.randint(10, 30)).split()
        if i % 2:
            text.insert(r.randrange(len(text)), insults[i // 2 % 60])
        rows.append((i, " ".join(text), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(docs, machine).collect()}
    assert sum(got[i] for i, _, y in rows if y) >= 0.95 * 750
    assert sum(got[i] for i, _, y in rows if not y) <= 0.02 * 750
    other = [(i, f"alpha1 {w} beta2") for i, w in enumerate(insults)]
    found = toxicity.score(spark.createDataFrame(other, "doc_id long, text string"), machine).where("score >= 0.5")
    assert found.count() >= 55


def test_toxicity_without_labels(spark):
    docs = small.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = {r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_language_model(spark):
    import random

    r = random.Random(4)
    # each word calls for the next, so that history helps
    values = [" ".join(small.WORDS[(s + k) % 18] for k in range(r.randint(3, 30))) for s in range(150)]
    values += ["", None, "Alpha BETA", "never seen words"]
    rows = [(i, t, i % 5 == 1, "x") for i, t in enumerate(values)] + [(None, "alpha", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_by boolean, words string").repartition(2)
    got = {r["doc_id"]: r for r in language_model.score(docs, "held_by").collect()}
    tokens = {i: small.SPACED.findall(small.lowered(t)) + [0] for i, t, _, _ in rows}
    counts = Counter(w for i, _, h, _ in rows if not h for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    gain = 0.0
    for i, _, held, _ in rows:
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i])
        assert math.isclose(got[i]["base_score"], want, rel_tol=1e-9)
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]))
        assert got[i]["held_out"] == bool(held) and got[i]["train_tokens"] == n
        gain += got[i]["score"] - got[i]["base_score"] if held else 0
    assert gain > 0


def test_language_model_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, held boolean")
    assert language_model.score(empty, "held").count() == 0
    only = spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held boolean")
    row = language_model.score(only, "held").first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)


@pytest.fixture(scope="module")
def field():
    return html.train()


def decoded(field, page):
    import re

    token, attribute = html._token_pattern(), html._attribute_pattern()
    blocks = html.blocks_of(page, token, attribute)
    labels = field.decode(html._features(blocks, re.compile(r"[^a-z]+")))
    return [b[0] for b, keep in zip(blocks, labels) if keep]


def test_field_on_pages_it_has_not_seen(field):
    good = pages = 0
    for page, labels in html.labelled_pages(150, seed=1234):
        blocks = html.blocks_of(page, html._token_pattern(), html._attribute_pattern())
        good += decoded(field, page) == [b[0] for b, keep in zip(blocks, labels) if keep]
        pages += 1
    assert good >= 0.9 * pages


def test_viterbi_equals_all_labellings(field):
    from itertools import product

    for page, _ in html.labelled_pages(40, seed=5):
        import re

        blocks = html.blocks_of(page, html._token_pattern(), html._attribute_pattern())[:9]
        features = html._features(blocks, re.compile(r"[^a-z]+"))
        scores = field.scores(features)
        if not blocks:
            continue
        worth = lambda y: sum(scores[i, k] for i, k in enumerate(y)) + sum(field.chain[a, b] for a, b in zip(y, y[1:]))
        assert math.isclose(worth(field.decode(features)), max(map(worth, product((0, 1), repeat=len(blocks)))), rel_tol=1e-9)


def test_blocks_of_odd_pages():
    read = lambda page: [b[0] for b in html.blocks_of(page, html._token_pattern(), html._attribute_pattern())]
    assert read("") == [] and read("plain &amp;  text\n x") == ["plain & text x"]
    assert read("<p>a<p>b</div>c<script>no()</script><!-- no --><style>p{}</style>") == ["a", "bc"]
    assert read("<p>a <b>bo</b>ld &#233;<br>x<p>y") == ["a bold é x", "y"]
    assert read("<div>open <ul><li>1<li>2</ul> tail") == ["open", "1", "2", "tail"]


def test_silent_elements_without_end_tags():
    read = lambda page: [b[0] for b in html.blocks_of(page, html._token_pattern(), html._attribute_pattern())]
    article = "<article><p>The text.</p></article>"
    for start in ("<body>", ""):
        assert read(f"<html><head><title>t <b> u</title><meta charset=x><script>a<b</script>{start}{article}") == ["The text."]
    assert read(f"<head><noscript><img src=x><iframe></iframe></noscript><title>t<body>{article}") == ["The text."]
    for name in ("select", "textarea", "button", "iframe", "object", "canvas", "noscript", "svg", "video", "template"):
        arounds = ["<div>{}</div>{}", "<body>{}{}", "<body>{}{}<{n}>c</{n}>", "<div>{}</div>{}<div><{n}>c</{n}></div>"]
        # in a textarea and an iframe an ancestor's end tag is text, if their own one comes
        for around in arounds + ["<div><p>{}</div>{}</{n}>"] * (name not in ("textarea", "iframe")):
            page = around.format(f"<{name}><option>a<option>b", article, n=name)
            assert read(page) == ["The text."], page
    # with their end tags all they hold is silent, nested ones too, and the block goes on
    assert read("<p>a <button><div>x</div></button>b <svg><g><svg><text>x</svg><title>y</title></g></svg>c</p>") == ["a b c"]
    assert read("<div>a<textarea></div><p>x</textarea>b</div>") == ["a b"]
    assert len(read("<div><button>x" * 20_000)) == 0


def test_extraction_keeps_columns(spark, field):
    page = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title here</h1><p>A long text of the article, with words.</p></article><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages, field)
    assert got.columns == [*pages.columns, "main_text"]
    assert {r["page_id"]: r["main_text"] for r in got.collect()} == {
        1: "Title here\n\nA long text of the article, with words.", 2: "", None: ""
    }


def test_alignment():
    a, b = "x the cat sat on the mat y".split(), "the cat sat on a mat".split()
    assert license_scan.align(a, b) == [(1, 0), (2, 1), (3, 2), (4, 3), (6, 5)]
    assert license_scan.align([], b) == [] and license_scan.align(["q"], b) == []
    # words that repeat are no anchors, but the gaps between anchors are aligned again
    assert len(license_scan.align("a a b c a".split(), "a a b c a".split())) == 5


def test_licenses(spark):
    mit = license_scan.TEMPLATES["MIT"]
    changed = mit.replace("Software", "Program", 1).replace("\n", " ")
    rows = [
        (1, "Some words.\n" + mit + "\nmore words"),
        (2, changed),
        (3, "foo bar\nReleased under the MIT License.\n" * 3),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "no license at all, and permission for nothing"),
        (6, None),
        (7, ""),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    found = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs).collect()}
    assert found[1][0]["license"] == "MIT" and found[1][0]["coverage"] == 1.0
    assert found[2][0]["license"] == "MIT" and 0.98 < found[2][0]["coverage"] < 1.0
    assert [f["license"] for f in found[3]] == ["MIT notice"] and (found[3][0]["first_word"], found[3][0]["last_word"]) == (2, 7)
    assert found[4][0]["license"] == "CC-BY-NC-4.0 notice"
    assert found[5] == found[6] == found[7] == []


def test_a_longer_license_is_not_its_beginning(spark):
    two, three = license_scan.TEMPLATES["BSD-2-Clause"], license_scan.TEMPLATES["BSD-3-Clause"]
    disclaimer = "\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS"
    rows = [(1, three + disclaimer), (2, two + disclaimer), (3, two + "\nOther words here\nand here\nand there\nat last\n" + three)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [f["license"] for f in r["licenses"]] for r in license_scan.scan(docs).collect()}
    assert found[1] == ["BSD-3-Clause"] and found[2] == ["BSD-2-Clause"] and set(found[3]) == {"BSD-2-Clause", "BSD-3-Clause"}
    assert license_scan.scan(spark.createDataFrame([], docs.schema)).count() == 0


def test_licenses_that_stand_twice_in_a_stretch(spark):
    mit, line = license_scan.TEMPLATES["MIT"], "Released under the MIT License."
    changed = mit.replace("Software", "Program", 1).replace("persons", "the persons")
    length = lambda text: len(text.replace("-", " ").replace("/", " ").split())
    other = "\nSee the source files for other conditions"
    rows = [
        (1, f"Copyright 2020 One\n{mit}\nCopyright 2021 Two\n{mit}{other}"),
        (2, f"some words {line} more words of a list {line} and the end"),
        (3, f"Copyright 2020 One\n{changed}\nCopyright 2021 Two\n{changed}\nCopyright Three\n{mit}{other}"),
        (4, f"Copyright 2020 One\n{mit}{other}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs).collect()}
    n = length(mit)
    assert {i: [(f["license"], len(f["places"])) for f in found] for i, found in got.items()} == {
        1: [("MIT", 2)], 2: [("MIT notice", 2)], 3: [("MIT", 3)], 4: [("MIT", 1)]
    }
    assert [tuple(p) for p in got[1][0]["places"]] == [(1.0, 3, 3 + n), (1.0, 6 + n, 6 + 2 * n)]
    assert [tuple(p) for p in got[2][0]["places"]] == [(1.0, 2, 7), (1.0, 12, 17)]
    assert (got[1][0]["first_word"], got[2][0]["last_word"]) == (3, 7)
    assert all(0.97 < p["coverage"] < 1.0 for p in got[3][0]["places"][:2])


def test_log_chances_are_those_of_a_softmax():
    r = np.random.default_rng(1)
    weights, rows, classes = r.normal(size=(50, 7)).astype(np.float32), r.integers(0, 50, (90, 4)), r.integers(0, 7, 90)
    z = weights[rows].sum(axis=1).astype(np.float64)
    want = np.log(np.exp(z) / np.exp(z).sum(axis=1, keepdims=True))[np.arange(90), classes]
    assert np.allclose(language_model._log_chances(weights, rows, classes), want, atol=1e-5)


def test_gradient_steps_are_those_of_the_softmax():
    r = np.random.default_rng(2)
    rows, classes = r.integers(0, 30, (200, 4)).astype(np.int32), r.integers(0, 5, 200).astype(np.uint8)
    weights, seen, squares = np.zeros((30, 5), np.float32), np.zeros(30), np.zeros(30, np.float32)
    language_model._trained(weights, seen, squares, rows, classes)
    error = np.full((200, 5), 0.2)
    error[np.arange(200), classes] -= 1
    slope = np.zeros((30, 5))
    for row, e in zip(rows, error):
        for f in row:
            slope[f] += e
    step = language_model._STEP / np.sqrt((slope * slope).mean(axis=1) + 1.0)
    assert np.allclose(weights, -step[:, None] * slope, atol=1e-4)
    assert (seen == np.bincount(rows.ravel(), minlength=30)).all()


def test_sums_of_runs():
    r = np.random.default_rng(1)
    values = r.integers(-9, 9, (300, 4)).astype(np.float32)
    for counts in ([1] * 300, [300], [9, 1, 8, 20, 2, 260], [3, 290, 7], [10] * 30, [2, 298]):
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        assert (language_model._run_sums(values, first, np.array(counts)) == np.add.reduceat(values, first, axis=0)).all()


def test_sums_of_runs_in_an_order():
    r = np.random.default_rng(3)
    values, order = r.integers(-9, 9, (120, 4)).astype(np.float32), r.integers(0, 120, 300)
    for counts in ([1] * 300, [300], [9, 1, 8, 20, 2, 260], [2, 1, 297]):
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        want = np.add.reduceat(values[order], first, axis=0)
        assert (language_model._run_sums(values, first, np.array(counts), order) == want).all()


def test_chances_take_the_room_of_a_batch():
    import tracemalloc

    r = np.random.default_rng(5)
    n, classes = 1 << 16, language_model.CLASSES
    weights, rows, aim = r.normal(size=(500, classes)).astype(np.float32), r.integers(0, 500, (n, 4)).astype(np.int32), r.integers(0, classes, n)
    tracemalloc.start()
    try:
        got = language_model._log_chances(weights, rows, aim)
        # the scores of all tokens at once have twice this
        assert tracemalloc.get_traced_memory()[1] < n * classes * 2
    finally:
        tracemalloc.stop()
    z = weights[rows[-99:]].sum(axis=1).astype(np.float64)
    assert np.allclose(got[-99:], z[np.arange(99), aim[-99:]] - np.log(np.exp(z).sum(axis=1)), atol=1e-4)


def test_chances_beyond_the_range_of_powers():
    r = np.random.default_rng(6)
    weights, rows, aim = (r.normal(size=(50, 7)) * 200).astype(np.float32), r.integers(0, 50, (90, 4)), r.integers(0, 7, 90)
    z = weights[rows].sum(axis=1).astype(np.float64)
    z -= z.max(axis=1, keepdims=True)
    want = z[np.arange(90), aim] - np.log(np.exp(z).sum(axis=1))
    assert np.allclose(language_model._log_chances(weights, rows, aim), want, rtol=1e-5, atol=1e-3)
    seen, squares = np.zeros(50), np.zeros(50, np.float32)
    language_model._trained(weights, seen, squares, rows, aim)
    assert np.isfinite(weights).all()


def test_history_chooses_among_words_of_one_class():
    """Words with the same first letters are told apart by the word before, and a history's chances add up to one."""
    words = np.array([4, 8, 12, 37, 70], np.int64) << 50
    classes = np.array([25, 25, 25, 25, 25], np.uint8)
    cells = language_model._cells(words, classes)
    assert len(set(cells)) == 5
    tokens = np.array([0, 3, 1, 4] * 400, np.int32)
    histories = language_model._histories(words, tokens, np.array([0, len(tokens)]))
    weights = np.zeros((language_model.LEVELS << language_model.FEATURE_BITS, language_model.CLASSES), np.float32)
    seen, squares = np.zeros(len(weights)), np.zeros(len(weights), np.float32)
    for _ in range(20):
        for _, rows, chosen in language_model._choices(histories, cells[tokens]):
            language_model._trained(weights, seen, squares, rows, chosen)

    def chances(after, cell):
        found = np.zeros(1)
        for some, rows, chosen in language_model._choices(histories[after : after + 1], np.array([cell])):
            found[some] += language_model._log_chances(weights, rows, chosen)
        return np.exp(found[0])

    # after word 3 comes word 1, never word 4
    assert chances(402, cells[1]) > 20 * chances(402, cells[4])
    every = sum(chances(402, cell) for cell in [25 * 1024 + k for k in range(1024)] + [c * 1024 for c in range(language_model.FREQUENT)])
    others = sum(chances(402, c * 1024 + k) for c in range(language_model.FREQUENT, language_model.CLASSES) if c != 25 for k in range(1024))
    assert abs(every + others - 1) < 1e-3
