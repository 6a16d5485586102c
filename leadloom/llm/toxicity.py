"""Toxicity of texts by a subsequence string-kernel support vector machine.

The kernel of two strings counts the character subsequences of length ``ORDER``
that they share, each weighted by ``DECAY`` to the length of what it spans, so
gaps and inserted characters weaken a match without losing it. Nyström landmarks
map strings to vectors in which the kernel is a dot product; a linear support
vector machine on these vectors is the kernel machine. It is fitted on the labelled
texts: a text's margin is that of its strongest string, which a toxic text should
have beyond the margin and a clean one not.

Strings are the words of a text without punctuation, and runs of single
characters, in which spaced-out words are whole again. A text is judged by
its two worst strings and by how many of its strings are suspicious. The
landmarks of the toxic side are words, parts of words and phrases that more toxic
texts hold than chance allows, and hardly any clean ones (counted by distinct neighbours, so that copies of
a text count once). Where these leave more than a quarter of the toxic texts
unexplained, phrases of two or three words are tested too, and are strings of a text
then; and rare strings, of which chance makes some in any sample, count where far
fewer as frequent ones stand in clean texts only. The landmarks of the clean side are
the strings of clean texts next to each of these. Their number follows the sample. Evidence becomes a
probability by a logistic fit on the same texts. Where nothing tells toxic texts
from clean ones, all get the toxic share of the labels, and no stage rejects any.

Learned from: at most ``SAMPLE`` labelled texts of each class, in the order of a
hash of their ids. Everything is scored, whole.

A kernel value counts as 0, in training as well as in scoring, where string and
landmark share no subsequence of ``REACH`` of the landmark. That is found for all
strings at once, by bit-parallel longest common subsequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, lgamma, log
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import fold_of
from leadloom.sources.scratch import written

ORDER, DECAY, REACH = 4, 0.6, 0.8
SAMPLE = 1500
# clean strings nearest to each mark, and clean strings the machine is fitted on
CONTRAST, CLEAN = 2, 30000
# share of a mark's texts that must be toxic, and of the marks that chance may have made
_PURITY, _FALSE = 0.9, 0.05
# phrases and rare strings are looked for where a larger share of the toxic texts holds no mark; texts that hold a phrase
_UNEXPLAINED, _SUPPORT = 0.25, 10
# lengths of beginnings of words that may be marks by themselves, with the two signs for the start
_PART = (6, 11)
# characters of a string; longer words are cut into overlapping strings
_LONGEST = 24
# strings of a sampled text that the fit knows, and how often a text's strongest string is chosen anew
NEAREST, WITNESSES = 16, 3
# strings remembered by a task
_REMEMBERED = 400_000


def phrases_of(strings: list[str]) -> list[str]:
    """Two and three neighbouring strings as one, as far as they are no longer than a string may be."""
    bare = [w[2:-2] if w.startswith("^^") and w.endswith("$$") else "" for w in strings]
    out = []
    for size in (2, 3):
        for i in range(len(bare) - size + 1):
            if all(bare[i : i + size]):
                phrase = f"^^{' '.join(bare[i : i + size])}$$"
                if len(phrase) <= _LONGEST:
                    out.append(phrase)
    return out


def strings_of(text: str) -> list[str]:
    """Strings of a text in order, repeated ones too; ``^^`` and ``$$`` stand for a word's ends."""
    dropped = {c: None for c in range(0x21, 0x7F) if not chr(c).isalnum()}
    words = text.lower().translate(dropped).split()
    runs = "".join(w if len(w) == 1 else " " for w in words).split()
    out = [f"^^{w}$$" for w in words if len(w) > 2] + [f"^^{w}$$" for w in runs if len(w) > 2]
    if any(len(w) > _LONGEST for w in out):
        half = _LONGEST // 2
        out = [w[i : i + _LONGEST] for w in out for i in range(0, max(1, len(w) - half), half)]
    return out


def codes(strings: list[str]) -> np.ndarray:
    """Code points, one row for each string, 0 after its end."""
    width = max(map(len, strings), default=1) or 1
    return np.array(strings, dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Unnormalised kernel of every row of ``left`` with its row of ``right`` (or the only one).

    ``before`` holds what the common subsequences found so far weigh when they are
    stretched to each pair of ends.
    """
    n, width = left.shape
    m = right.shape[1]
    same = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] > 0)
    before = np.ones((n, width, m), np.float32)
    for level in range(ORDER):
        matched = np.where(same, before, 0) * np.float32(DECAY * DECAY)
        if level == ORDER - 1:
            break
        ends = np.zeros((n, width + 1, m + 1), np.float32)
        for j in range(m):
            ends[:, 1:, j + 1] = matched[:, :, j] + np.float32(DECAY) * ends[:, 1:, j]
        for i in range(width):
            ends[:, i + 1] += np.float32(DECAY) * ends[:, i]
        before = ends[:, :-1, :-1]
    return matched.sum(axis=(1, 2), dtype=np.float32)


def shared_lengths(strings: np.ndarray, landmark: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each string with a landmark of at most 24."""
    # one more than the landmark's largest code point, for all that are larger
    masks = np.zeros(int(landmark.max()) + 2, np.uint32)
    for bit, code in enumerate(landmark):
        masks[code] |= np.uint32(1 << bit)
    state = np.full(len(strings), 0xFFFFFFFF, np.uint32)
    for i in range(strings.shape[1]):
        column = masks[np.minimum(strings[:, i], len(masks) - 1)]
        hit = state & column
        state = (state + hit) | (state - hit)
    lost = ~state & np.uint32((1 << len(landmark)) - 1)
    return np.bitwise_count(lost).astype(np.int64)


@dataclass
class Machine:
    """A fitted kernel machine, small enough to be sent with every task."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    fit: tuple = (1.0, 0.0, 0.0, 0.0, 0.0, 0.0)

    @property
    def phrases(self) -> bool:
        """Whether neighbouring words are strings too."""
        return any(" " in name for name in self.landmarks)

    def strings(self, text: str) -> list[str]:
        found = strings_of(text)
        return found + phrases_of(found) if self.phrases else found

    def features(self, strings: list[str]) -> np.ndarray:
        """Normalised kernel values with all landmarks."""
        out = np.zeros((len(strings), len(self.landmarks)), np.float32)
        if not strings or not self.landmarks:
            return out
        rows = codes(strings)
        hits = []
        for k, name in enumerate(self.landmarks):
            mark = codes([name])[0]
            near = np.flatnonzero(shared_lengths(rows, mark) >= -(-int(REACH * 100) * len(mark) // 100))
            if len(near):
                hits.append((k, mark, near))
        if not hits:
            return out
        some = np.unique(np.concatenate([h[2] for h in hits]))
        norm = np.zeros(len(strings), np.float32)
        norm[some] = np.sqrt(np.concatenate([kernel(rows[p], rows[p]) for p in _parts(some)]))
        for k, mark, near in hits:
            value = np.concatenate([kernel(rows[p], mark[None, :]) for p in _parts(near)])
            own = float(np.sqrt(kernel(mark[None, :], mark[None, :])[0]))
            # a landmark that is a whole word is compared with whole words, a part of one with parts
            whole = self.landmarks[k].endswith("$")
            out[near, k] = value / (own * norm[near]) if whole else value / (own * own)
        return out

    def margins(self, strings: list[str]) -> np.ndarray:
        return self.features(strings) @ self.weights + self.bias

    def evidence(self, found: list[float], strings: int) -> list[float]:
        """What a text is judged by: its two largest margins, how many of its strings are suspicious, as a share
        and in all, and the share of those that come near."""
        top = sorted(found, reverse=True)[:2] + [self.bias] * 2
        sure, close = sum(v > 0 for v in found), sum(v > self.bias / 2 for v in found)
        share = [float(np.log1p(100.0 * n / (strings + 10))) for n in (sure, close)]
        return [top[0], top[1], share[0], float(np.log1p(sure)), share[1]]

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        z = np.asarray(evidence) @ np.array(self.fit[:-1]) + self.fit[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _parts(places: np.ndarray) -> list[np.ndarray]:
    return [places[i : i + 2000] for i in range(0, len(places), 2000)]


def _varied(word: str) -> list[str]:
    """A string with a character inserted or doubled."""
    out = [word]
    for i in range(3, len(word) - 2 * (word[-1] == "$")):
        out += [word[:i] + c + word[i:] for c in ("x", word[i])]
    return out


def _chance(bad: int, good: int, share: float) -> float:
    """How likely at least so many of a string's texts are toxic, if each is with the probability ``share`` (binomial)."""
    n = bad + good
    return sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * log(1 - share) + (n - j) * log(share)) for j in range(good + 1))


def _significant(found: list[tuple[str, float, float]], tested: int) -> list[tuple[str, float]]:
    """Strings with their likelihood ratios, of those with their chances, as far as few are false (Benjamini-Hochberg)."""
    found = sorted(found, key=lambda f: (f[2], f[0]))
    kept = 0
    for rank, (_, _, chance) in enumerate(found, 1):
        if chance <= _FALSE * rank / max(tested, 1):
            kept = rank
    return [(word, ratio) for word, ratio, _ in found[:kept]]


def _distinct_marks(found: list[tuple[str, float]]) -> list[str]:
    """Marks from strong to weak, without those that a stronger (or longer, as strong) one begins with or covers.

    A part of a word covers what begins with it, a whole word only its own beginnings.
    """
    marks: list[str] = []
    beginnings: set[str] = set()
    parts: set[str] = set()
    for word, _ in sorted(found, key=lambda f: (-round(3 * np.log(f[1]) / np.log(1.5)), -len(f[0]), f[0])):
        own = {word[:i] for i in range(1, len(word) + 1)}
        if word in beginnings or own & parts:
            continue
        marks.append(word)
        beginnings |= own
        if not word.endswith("$"):
            parts.add(word)
    return marks


def _rare(seen: list[tuple[str, int, int]], known: list[str]) -> list[tuple[str, float]]:
    """Strings that stand in few texts, all toxic, where chance makes few such strings.

    ``seen`` are strings with the number of toxic and of clean texts. Without any
    relation as many strings would stand in just so many clean texts and no toxic
    one; where these are at most the share ``_FALSE`` of those in toxic texts only,
    the latter are taken. Strings that hold a known mark are covered by it.
    """
    toxic: dict[int, list[str]] = {}
    clean: dict[int, int] = {}
    for word, bad, good in seen:
        if good == 0 and bad > 1:
            toxic.setdefault(bad, []).append(word)
        elif bad == 0 and good > 1:
            clean[good] = clean.get(good, 0) + 1
    found = []
    for n, words in sorted(toxic.items()):
        if clean.get(n, 0) <= _FALSE * len(words) and len(words) * _FALSE >= 1:
            found += [(w, float(n)) for w in words if not any(k.rstrip("$") in w for k in known)]
    return found


def _seen_batch(toxic: int, places: dict[str, str]) -> pa.RecordBatch:
    """Strings of one text with a number for the neighbours of each."""
    return pa.RecordBatch.from_arrays(
        [pa.array([toxic] * len(places), pa.int32()), pa.array(list(places), pa.string()),
         pa.array([crc32(p.encode()) for p in places.values()], pa.int64())],
        ["toxic", "word", "around"],
    )


def _phrases_in(common: set[str]):
    """Phrases of texts whose words are all ``common``, as ``_seen_batch`` gives strings."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = strings_of(text)
                around = ["", *found, ""]
                places: dict[str, str] = {}
                for i in range(len(found) - 1):
                    for size in (2, 3):
                        some = found[i : i + size]
                        if len(some) == size and common.issuperset(some):
                            # the longest phrase of so many words; too long ones are none
                            for phrase in [p for p in phrases_of(some) if p.count(" ") == size - 1]:
                                places.setdefault(phrase, f"{around[i]} {around[i + size + 1]}")
                if places:
                    yield _seen_batch(toxic, places)

    return spread


def _without(texts: DataFrame, marks: list[str]) -> int:
    """How many of the toxic ``texts`` hold none of the marks."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [strings_of(t) for t in batch.column(1).to_pylist()]
            none = sum(not any(w.startswith(tuple(marks)) for w in words) for words in lists)
            yield pa.RecordBatch.from_arrays([pa.array([none], pa.int64())], ["n"])

    return texts.where("toxic = 1").mapInArrow(look, "n long").agg(F.sum("n")).first()[0] or 0


def _landmarked(marks: list[str], clean: list[str]) -> tuple[Machine, np.ndarray]:
    """A machine whose landmarks are the marks and the clean strings next to each, and the kernel's root among them."""
    if not marks:
        return Machine([], np.zeros(0, np.float32), -1.0), np.zeros((0, 0))
    close = Machine(marks, np.zeros(len(marks), np.float32), 0.0).features(clean)
    near = np.argsort(-close, axis=0, kind="stable")[:CONTRAST]
    nearest = sorted({clean[i] for k in range(len(marks)) for i in near[:, k] if close[i, k] > 0})
    machine = Machine(marks + nearest, np.zeros(len(marks) + len(nearest), np.float32), -1.0)
    gram = machine.features(machine.landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return machine, vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T


def _hinge_fit(x: np.ndarray, y: np.ndarray, share: np.ndarray, rounds: int = 3000) -> tuple[np.ndarray, float]:
    """Linear support vector machine by subgradient steps, averaged over the later half."""
    w, b, mean_w, mean_b = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    penalty = 1e-3
    for t in range(1, rounds + 1):
        miss = share * y * (y * (x @ w + b) < 1)
        step = 1 / (penalty * (t + 1000))
        w = w + step * (miss @ x - penalty * w)
        b = b + step * miss.sum()
        if t > rounds // 2:
            mean_w, mean_b = mean_w + w / (rounds - rounds // 2), mean_b + b / (rounds - rounds // 2)
    return mean_w, mean_b


def _fit_machine(machine: Machine, root: np.ndarray, marks: list[str], bags: list[tuple[int, list[str]]], clean: list[str]) -> None:
    """Fits the machine on labelled texts, each given by its label and its strings near landmarks.

    A text's margin is that of its strongest string, as in multiple-instance
    learning: a toxic text asks for one string beyond the margin, a clean one for
    none. Which string that is follows from the last fit, ``WITNESSES`` times over;
    at first it is the one nearest to a mark. A clean text without any near string
    is a zero vector; a toxic one without says nothing. Virtual examples, the marks
    as they are and with a character inserted, and the clean strings nearest to marks
    keep the boundary between what is tolerated and what is another word.
    """
    if not machine.landmarks:
        return
    names = sorted({w for _, words in bags for w in words})
    at = {w: i for i, w in enumerate(names)}
    raw = machine.features(names).astype(np.float64)
    varied = [v for w in marks for v in _varied(w)[1:]]
    own = machine.features(marks).astype(np.float64)
    virtual = machine.features(varied).astype(np.float64)
    others = machine.features(clean).astype(np.float64)
    close = others[:, : len(marks)].max(axis=1, initial=0.0)
    hard = np.flatnonzero(close > 0)
    heat = np.maximum(close[hard], 1e-3) ** 2
    x = np.concatenate([raw, own, virtual, others[hard], np.zeros((1, raw.shape[1]))]) @ root
    margin = raw[:, : len(marks)].max(axis=1, initial=0.0)
    for _ in range(WITNESSES):
        toxic, good = np.zeros(len(names)), np.zeros(len(names))
        rest = 0
        for label, words in bags:
            if words:
                places = [at[w] for w in words]
                (toxic if label else good)[max(places, key=lambda i: (margin[i], -i))] += 1
            elif not label:
                rest += 1
        texts = max(good.sum() + rest, 1)
        # one line for each string as a toxic witness and one as a clean one
        lines = np.concatenate([np.arange(len(names)), np.arange(len(x))])
        y = np.concatenate([np.ones(len(names)), -np.ones(len(x))])
        y[2 * len(names) : 2 * len(names) + len(marks) + len(varied)] = 1
        share = np.concatenate([
            0.2 * toxic / max(toxic.sum(), 1), 0.2 * good / texts,
            np.full(len(marks), 0.15 / len(marks)), np.full(len(varied), 0.15 / len(varied)),
            0.25 * heat / max(heat.sum(), 1e-9), [0.05 + 0.2 * rest / texts],
        ])
        used = share > 0
        w, b = _hinge_fit(x[lines[used]], y[used], share[used])
        margin = x[: len(names)] @ w + b
    machine.weights = (root @ w).astype(np.float32)
    machine.bias = float(b)


def _bags(texts: DataFrame, machine: Machine, marks: int) -> list[tuple[int, list[str]]]:
    """``(toxic, strings near landmarks)`` of the sample's texts: of each the ``NEAREST`` closest to any mark."""
    shared = texts.sparkSession.sparkContext.broadcast(vars(machine))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine(**shared.value)
        for batch in batches:
            lists = [sorted(set(model.strings(t))) for t in batch.column(1).to_pylist()]
            names = sorted(set().union(*lists), key=lambda w: (len(w), w))
            close: dict[str, float] = {}
            for low in range(0, len(names), 20000):
                part = names[low : low + 20000]
                best = model.features(part)[:, :marks].max(axis=1, initial=0.0)
                close.update((w, v) for w, v in zip(part, best.tolist()) if v > 0)
            found = [sorted((w for w in words if w in close), key=lambda w: (-close[w], w))[:NEAREST] for words in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], ["toxic", "near"])

    # one row for each text of the sample
    return [(r["toxic"], r["near"]) for r in texts.select("toxic", "text").mapInArrow(look, "toxic int, near array<string>").collect()]


def _logistic(evidence: np.ndarray, toxic: np.ndarray) -> tuple:
    """Weights of the evidence and offset, by Newton's method; smoothed, none negative but the offset."""
    ones, zeros = int((toxic == 1).sum()), int((toxic == 0).sum())
    if not ones or not zeros:
        rate = (ones + 1) / (ones + zeros + 2)
        return (*[0.0] * evidence.shape[1], float(np.log(rate / (1 - rate))))
    aim = np.where(toxic == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.concatenate([evidence, np.ones((len(evidence), 1))], axis=1)
    beta, used = np.zeros(x.shape[1]), np.ones(x.shape[1], bool)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (aim - p) - 1e-2 * beta
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        step = np.zeros(len(beta))
        step[used] = np.linalg.solve(curve[np.ix_(used, used)], slope[used])
        beta = beta + np.clip(step, -2, 2)
        used[:-1] &= beta[:-1] >= 0
        beta[:-1] = np.maximum(beta[:-1], 0)
    return tuple(beta.tolist())


def _evidence(spark, machine: Machine):
    """Column function: what speaks for the toxicity of a text."""
    # plain values: what is broadcast is pickled by reference, and workers need no copy of this package
    shared = spark.sparkContext.broadcast(vars(machine))

    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, clean, marked = Machine(**shared.value), set(), {}
        for texts in columns:
            out = []
            low = 0
            while low < len(texts):
                # as many texts at a time as have some million characters
                size, high = 0, low
                while high < len(texts) and (high == low or size < 2_000_000):
                    size += len(texts.iat[high])
                    high += 1
                lists = [model.strings(t) for t in texts.iloc[low:high]]
                new = set().union(*lists) - clean - marked.keys()
                ordered = sorted(new, key=len)
                for i in range(0, len(ordered), 20000):
                    part = ordered[i : i + 20000]
                    for word, value in zip(part, model.margins(part).tolist()):
                        if value > model.bias:
                            marked[word] = value
                clean |= new - marked.keys()
                for words in lists:
                    seen = marked.keys() & set(words)
                    found = [marked[w] for w in words if w in seen] if seen else []
                    out.append(model.evidence(found, len(words)))
                if len(clean) > _REMEMBERED:
                    clean = set()
                if len(marked) > _REMEMBERED:
                    marked = {}
                low = high
            yield pd.Series(out)

    return F.pandas_udf(score, "array<double>")


def _scored(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("evidence", _evidence(docs.sparkSession, machine)(text))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine for ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    Uses the rows whose crc32 of the id is not divisible by 5. Ids with labels of
    both kinds and null labels are left out. Without toxic texts, without clean ones
    or where nothing tells them apart, every text gets the toxic share of the labels
    (about 0 without any), and the machine has no landmarks.
    """
    given = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")
    )
    given = given.where("toxic = _most AND toxic IN (0, 1)").where(fold_of("doc_id") != 0).select("doc_id", "toxic")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # the documented bound of what the machine learns from
    sample = given.where("toxic = 1").orderBy(*order).limit(SAMPLE).unionByName(
        given.where("toxic = 0").orderBy(*order).limit(SAMPLE)
    )
    # at most 2 * SAMPLE rows
    texts = docs.join(F.broadcast(sample), "doc_id").select(
        "toxic", F.coalesce("text", F.lit("")).alias("text")
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = strings_of(text)
                around = ["", *found, ""]
                first = {}
                for i, w in enumerate(found):
                    if w not in first:
                        first[w] = f"{around[i]} {around[i + 2]}"
                parts = {}
                for w, place in first.items():
                    for size in range(_PART[0], min(_PART[1], len(w) - 3) + 1):
                        parts.setdefault(w[:size], f"{w} {place}")
                yield _seen_batch(toxic, parts | first)

    counts = texts.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    share = given.agg(F.avg(F.col("toxic").cast("double"))).first()[0]

    def counted(found: DataFrame) -> DataFrame:
        # by distinct neighbours; held: toxic texts, whatever stands around
        return found.groupBy("toxic", "word", "around").agg(F.count("*").alias("n")).groupBy("word").agg(
            F.count_if(F.col("toxic") == 1).alias("bad"),
            F.count_if(F.col("toxic") == 0).alias("good"),
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("held"),
        )

    kind = "toxic int, word string, around long"
    bad, good = max(counts[0], 1), max(counts[1], 1)
    rate_bad, rate_good = F.col("bad") / bad, F.col("good") / good
    # a string is a mark if chance would make few like it among all strings (likelihood ratio)
    seen = written(counted(texts.mapInArrow(spread, kind)), "strings")
    both = (F.col("bad") + F.col("good")) / (bad + good)
    ratio = 2 * (
        F.col("bad") * F.log(rate_bad / both)
        + F.when(F.col("good") > 0, F.col("good") * F.log(rate_good / both)).otherwise(0.0)
    )
    marked = (F.col("bad") > 2) & (rate_bad / (rate_bad + rate_good) >= _PURITY) & (ratio > 0)

    def significant(some: DataFrame, tested: int) -> list[tuple[str, float]]:
        best = some.where(marked).select("word", "bad", "good", ratio.alias("ratio")).collect()
        found = [(r["word"], r["ratio"], _chance(r["bad"], r["good"], bad / (bad + good))) for r in best]
        return _significant(found, tested)

    marks = _distinct_marks(significant(seen, seen.where("bad > 2").count()))
    if _without(texts, marks) > _UNEXPLAINED * counts[0]:
        # every word of a phrase stands in as many texts as the phrase, so of rare words none is looked for
        common = {r["word"] for r in seen.where(F.col("word").endswith("$") & (F.col("held") >= _SUPPORT)).select("word").collect()}
        phrases = written(counted(texts.mapInArrow(_phrases_in(common), kind)), "phrases")
        covered = lambda phrase: any(f"^^{w}$$".startswith(m) for w in phrase[2:-2].split(" ") for m in marks)
        strong = significant(phrases.where(F.col("bad") >= _SUPPORT), phrases.count())
        marks += [p for p, _ in sorted(strong, key=lambda f: (-f[1], f[0])) if not covered(p)]
        # at most as many as the sample has strings; whole words only, since parts repeat what they begin
        few = seen.where("endswith(word, '$') AND (bad = 0 OR good = 0) AND bad + good > 1 AND bad + good < 12")
        marks += [w for w, _ in _rare([tuple(r) for r in few.select("word", "bad", "good").collect()], marks)]
    whole = F.col("word").endswith("$")
    clean = seen.where(whole & ~marked & F.expr("bad <= good")).orderBy(F.xxhash64("word"), "word").limit(CLEAN)
    clean = [r["word"] for r in clean.select("word").collect()]
    machine, root = _landmarked(marks, sorted(clean))
    if not machine.landmarks:
        # nothing tells toxic texts apart: all get the share that the labels have
        machine.fit = (*[0.0] * 5, _logit(share))
        return machine
    _fit_machine(machine, root, marks, _bags(texts, machine, len(marks)), sorted(clean))
    known = _scored(texts, machine).select("toxic", "evidence").collect()
    evidence = np.array([r["evidence"] for r in known]).reshape(-1, 5)
    machine.fit = _logistic(evidence, np.array([r["toxic"] for r in known], int))
    return machine


def _logit(share: float | None) -> float:
    share = min(max(share if share is not None else 0.0, 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)``: probability that a text is toxic; one row for each row of ``docs``.

    Null counts as empty, and empty texts get the score of a text without any
    suspicious string. Texts of any length are read whole, some million characters
    at a time. Other columns play no part; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _scored(rows, machine).select("doc_id", probability(machine).alias("score"))


def probability(machine: Machine):
    """The column form of ``Machine.probability`` for a column ``evidence``."""
    z = F.lit(float(machine.fit[-1]))
    for i, weight in enumerate(machine.fit[:-1]):
        z = z + F.col("evidence")[i] * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def keep_clean(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score below 0.5, with all their columns.

    All rows stay if the machine has found nothing that tells toxic texts apart.
    Null and empty texts stay; repeated rows are judged each; no rows give no rows.
    """
    if not machine.landmarks:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return _scored(rows, machine).where(probability(machine) < 0.5).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    machine = train(docs.select("doc_id", "text"), labels)
    found = score(docs, machine)
    return found.select(
        "doc_id",
        (fold_of("doc_id") == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
