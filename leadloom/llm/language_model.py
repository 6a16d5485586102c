"""Scores of texts by a hashed maximum-entropy model with a class-factored softmax.

    p(word | history) = p(class | history) * p(part | history, class)
                        * p(cell | history, class, part) * p(word | cell)

The first three factors are softmaxes over ``CLASSES`` outcomes each, whose weights
are hashed features of the history: the word before, the two words before, and
skips to the second and third word before. Inside a class they are the first two of
these, each together with the class and part chosen so far. So the history chooses among 12 * 32 * 32 cells and the frequent
words. The last factor is the maximum-likelihood estimate of a softmax without
history, smoothed relative counts. Frequent words have a class of their own, which
takes no further choice; others go by their first letters, and inside a class by
bits of their hash.

Training: every task takes stochastic gradient steps over its training texts,
and the tasks' weights are averaged feature by feature, by how often each task
saw the feature; ``ROUNDS`` such rounds start from the last average.

Counts cover all training texts. They meet the texts by way of segments: a
segment is a bounded number of texts with the list of its distinct words. The
lists, not the texts, are joined with the counts of all words, and a segment gets
back the counts of its own words. So no task holds the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import fold_of, shuffle_partitions
from leadloom.llm.words import _span_hashes, _tables, mixed, text_buffers, word_spans
from leadloom.sources.scratch import new_folder, remove, written

CLASSES, FREQUENT = 32, 20
# choices one after the other: class, part of the class, cell of the part
LEVELS = 3
# LEVELS << FEATURE_BITS is at most 65536, so that a feature fits two bytes
FEATURE_BITS = 14
# kinds of history, of all four, that choose inside a class
_INSIDE = 2
# bits of a word's hash that name its part and its cell
_PART_BITS, _LOW_BIT = 5, 50
ROUNDS = 1
# text bytes of a segment (a longer text is one by itself)
SEGMENT_BYTES = 16 << 20
_STEP, _BATCH = 0.2, 4096
# the hash that stands for the end of a text, and for what is before its start
_END, _START = np.uint64(0x5EED0FE2D), np.uint64(0x57A27)

_SEGMENT = (
    "segment long, doc_ids array<long>, held array<boolean>, firsts array<int>, tokens binary, "
    "words array<long>, letters array<int>, counts array<int>"
)
_SEGMENT_TYPES = pa.schema(
    [("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
     ("firsts", pa.list_(pa.int32())), ("tokens", pa.binary()), ("words", pa.list_(pa.int64())),
     ("letters", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
)


def _segment(ids: list, held: np.ndarray, column: pa.Array, number: int) -> dict:
    """Texts as places in the sorted list of their distinct words; each text ends with the end token."""
    data, bounds = text_buffers(column)
    starts, ends = word_spans(data, bounds)
    lower = _tables("spaced")[0]
    at = np.searchsorted(starts, bounds)
    docs = len(at) - 1
    firsts = at + np.arange(docs + 1)
    # one end after each text
    full = np.insert(_span_hashes(data, starts, ends, lower), at[1:], _END).view(np.int64)
    words, first, places = np.unique(full, return_index=True, return_inverse=True)
    del full
    ended = words == _END.astype(np.int64)
    spot = np.where(ended, 0, first - (np.searchsorted(firsts, first, "right") - 1))
    letters = np.zeros(len(words), np.int32)
    if len(starts):
        begin, size = starts[spot], (ends - starts)[spot]
        second = np.where(size > 1, lower[data[np.minimum(begin + 1, len(data) - 1)]], 0)
        letters = np.where(ended, 0, lower[data[begin]] * np.uint64(257) + second).astype(np.int32)
    del data, starts, ends
    # frequent words get small numbers, which take little room
    order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    places = rank[places]
    train = np.repeat(~held, np.diff(firsts))
    return {
        "segment": number,
        "doc_ids": ids,
        "held": held.tolist(),
        "firsts": firsts.astype(np.int32),
        "tokens": _packed(places),
        "words": words[order],
        "letters": letters[order],
        "counts": np.bincount(places[train], minlength=len(words)).astype(np.int32),
    }


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte plane by byte plane, compressed."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int32)


def _segments(docs: DataFrame, path: str) -> DataFrame:
    """``docs (doc_id, held, text)`` in segments, written to ``path``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            low = 0
            while low < batch.num_rows:
                high = max(int(np.searchsorted(bounds, bounds[low] + SEGMENT_BYTES, "right")) - 1, low + 1)
                part = batch.slice(low, high - low)
                held = np.array(part.column(1).to_pylist(), bool)
                row = _segment(part.column(0).to_pylist(), held, part.column(2), number)
                yield pa.RecordBatch.from_pylist([row], schema=_SEGMENT_TYPES)
                number, low = number + 1, high
                del part, row
                # a worker is used again by other stages and should not hold what it no longer needs
                pa.default_memory_pool().release_unused()

    docs.mapInArrow(cut, _SEGMENT).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _unpacked(row: dict) -> dict:
    """A segment's columns as arrays."""
    out = {k: row[k].values.to_numpy(zero_copy_only=False) for k in ("firsts", "words") if k in row}
    out["held"] = np.array(row["held"].as_py(), bool)
    out["tokens"] = _numbers(row["tokens"].as_py())
    out["cells"] = _cells(out["words"], row["classes"].values.to_numpy(zero_copy_only=False))
    return out


def _cells(words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Cells of words: class, part and cell in one number; the parts and cells of frequent words are not chosen."""
    bits = (LEVELS - 1) * _PART_BITS
    return (classes.astype(np.int64) << bits) + ((words.view(np.uint64) >> np.uint64(_LOW_BIT)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _choices(histories: np.ndarray, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level the tokens that have a choice there, their rows of the weight table and what was chosen."""
    for level in range(LEVELS):
        chosen = cells >> ((LEVELS - 1 - level) * _PART_BITS)
        before = chosen >> _PART_BITS
        some = np.flatnonzero(before >> ((level - 1) * _PART_BITS) >= FREQUENT) if level else np.arange(len(cells))
        keys = histories[some, :_INSIDE] if level else histories
        if level:
            keys = mixed(keys ^ mixed((before[some] + (level << 32)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None])
        rows = (keys >> np.uint64(64 - FEATURE_BITS)).astype(np.int32) + np.int32(level << FEATURE_BITS)
        yield some, rows, (chosen[some] & (CLASSES - 1)).astype(np.uint8)


def _histories(words: np.ndarray, tokens: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Hashes of what is before every token: one for each kind of history."""
    n = len(tokens)
    hashes = words.view(np.uint64)[tokens]
    before = np.arange(n) - np.repeat(firsts[:-1], np.diff(firsts))
    ago = []
    for k in (1, 2, 3):
        shifted = np.concatenate([np.full(min(k, n), _START), hashes[:-k] if n > k else hashes[:0]])
        ago.append(np.where(before >= k, shifted, _START))
    kinds = (ago[0], mixed(ago[0] * np.uint64(3) + ago[1]), ago[1], ago[2])
    return np.stack([mixed(h + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & 0xFFFFFFFFFFFFFFFF)) for i, h in enumerate(kinds)], axis=1)


def _stretches(s: dict) -> Iterator[tuple[int, int, np.ndarray]]:
    """Histories of a segment's tokens, some at a time; they reach three tokens back."""
    firsts = s["firsts"].astype(np.int64)
    for low in range(0, len(s["tokens"]), 1 << 16):
        begin, high = max(low - 3, 0), min(low + (1 << 16), len(s["tokens"]))
        some = firsts[np.searchsorted(firsts, begin, "right") : np.searchsorted(firsts, high)]
        # a text that began earlier has its whole history inside the stretch, or more than three tokens of it
        cut = np.concatenate([[begin], some, [high]]) - begin
        yield low, high, _histories(s["words"], s["tokens"][begin:high], cut)[low - begin :]


def _scores_of(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the features' weights, one line for each class, less the largest of a token."""
    z = np.take(weights, rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        z += np.take(weights, rows[:, k], axis=0)
    # by class, what follows runs over long contiguous lines; a power of two apart they would crowd each other out of the cache
    lines = np.empty((z.shape[1], len(z) + 16), z.dtype)[:, : len(z)]
    np.copyto(lines, z.T)
    lines -= lines.max(axis=0)
    return lines


def _log_chances(weights: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each token's class."""
    out = np.empty(len(rows), weights.dtype)
    # a batch at a time, so that it stays in a core's cache
    for low in range(0, len(rows), _BATCH):
        z = _scores_of(weights, rows[low : low + _BATCH])
        own = z[classes[low : low + _BATCH], np.arange(z.shape[1])]
        np.exp(z, out=z)
        out[low : low + _BATCH] = own - np.log(z.sum(axis=0))
    return out


def _put(table: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """``table[places] = rows``, each row as one block of bytes."""
    block = np.dtype((np.void, table.shape[1] * table.itemsize))
    np.put(table.view(block), places, rows.view(block))


def _run_sums(values: np.ndarray, first: np.ndarray, count: np.ndarray, order: np.ndarray | None = None, short: int = 8) -> np.ndarray:
    """Sums of runs of rows of ``values``, taken in ``order`` (as they are, if none is given); the runs follow one another.

    Short runs are summed place by place for all at once, each long one as a product with ones.
    """
    if order is None:
        order = np.arange(len(values))
    out = np.take(values, order[first], axis=0)
    some = np.flatnonzero((count > 1) & (count <= short))
    if len(some):
        # longest first: the runs that have a k-th row are the first ones
        size = (-count[some]).astype(np.int16)
        by = np.argsort(size, kind="stable")
        some, size = some[by], size[by]
        start = first[some]
        sums = np.take(out, some, axis=0)
        for k in range(1, short):
            n = int(np.searchsorted(size, -k))
            sums[:n] += np.take(values, order[start[:n] + k], axis=0)
        _put(out, some, sums)
    long = np.flatnonzero(count > short)
    if len(long):
        rows = np.take(values, order[np.repeat(count > short, count)], axis=0)
        ones = np.ones(count.max(), values.dtype)
        ends = np.cumsum(count[long])
        for i, n, end in zip(long.tolist(), count[long].tolist(), ends.tolist()):
            out[i] = ones[:n] @ rows[end - n : end]
    return out


def _trained(weights: np.ndarray, seen: np.ndarray, squares: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> None:
    """Gradient steps over the tokens in batches, with a step per feature that falls with what it has got."""
    kinds, outcomes = rows.shape[1], weights.shape[1]
    for low in range(0, len(rows), _BATCH):
        part, aim = rows[low : low + _BATCH], classes[low : low + _BATCH]
        error = _scores_of(weights, part)
        np.exp(error, out=error)
        error /= error.sum(axis=0)
        error = np.ascontiguousarray(error.T)
        error.ravel()[np.arange(len(aim)) * outcomes + aim] -= 1
        places = part.ravel()
        # numbers of 16 bits are sorted in one pass over each byte
        order = np.argsort(places.astype(np.uint16), kind="stable")
        sorted_ = places[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        touched = sorted_[first].astype(np.intp)
        count = np.diff(np.append(first, len(sorted_)))
        slope = _run_sums(error, first, count, order // kinds)
        seen[touched] += count
        squares[touched] += (slope * slope).sum(axis=1) / outcomes
        slope *= (_STEP / np.sqrt(squares[touched] + 1.0))[:, None]
        _put(weights, touched, np.subtract(np.take(weights, touched, axis=0), slope, out=slope))


def _round(segments: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Weights after one pass over the training texts of all segments, averaged over tasks."""
    spark = segments.sparkSession
    shared = spark.sparkContext.broadcast(weights)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        own = shared.value.copy()
        seen, squares = np.zeros(len(own)), np.zeros(len(own), np.float32)
        for batch in batches:
            for i in range(batch.num_rows):
                s = _unpacked({n: batch.column(n)[i] for n in batch.schema.names})
                train = np.repeat(~s["held"], np.diff(s["firsts"]))
                for low, high, histories in _stretches(s):
                    used = train[low:high]
                    for _, rows, chosen in _choices(histories[used], s["cells"][s["tokens"][low:high]][used]):
                        _trained(own, seen, squares, rows, chosen)
        touched = np.flatnonzero(seen)
        # half precision on the way to the average: the tasks' tables are most of what training writes
        for some in np.array_split(touched, max(1, len(touched) // 2000)):
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(seen[some], pa.float64()),
                     pa.array([w.tobytes() for w in own[some].astype(np.float16)], pa.binary())],
                    ["row", "seen", "weights"],
                )

    def average(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, list] = {}
        for frame in frames:
            for row, seen, vector in zip(frame["row"], frame["seen"], frame["weights"]):
                vector = np.frombuffer(vector, np.float16).astype(np.float64) * seen
                if row in sums:
                    sums[row][0] += seen
                    sums[row][1] += vector
                else:
                    sums[row] = [seen, vector]
        out = [(row, seen, (total / seen).astype(np.float16).tobytes()) for row, (seen, total) in sums.items()]
        yield pd.DataFrame(out, columns=["row", "seen", "weights"])

    kind = "row int, seen double, weights binary"
    # tasks of neighbouring partitions are put together first, so that no task adds up what all have learned
    parts = segments.select("firsts", "words", "held", "tokens", "classes").mapInArrow(learn, kind)
    salted = parts.repartition(shuffle_partitions(spark), "row", F.pmod(F.spark_partition_id(), F.lit(8)))
    merged = salted.mapInPandas(average, kind).repartition("row").mapInPandas(average, kind)
    new = weights.copy()
    # the table has a fixed size, so this many rows at most
    for r in merged.collect():
        new[r["row"]] = np.frombuffer(r["weights"], np.float16)
    return new


class Model:
    """Weights, sizes of cells and totals; the counts of words stay in a table."""

    def __init__(self, weights: np.ndarray, cell_tokens: np.ndarray, cell_words: np.ndarray) -> None:
        self.weights, self.cell_tokens, self.cell_words = weights, cell_tokens, cell_words

    @property
    def tokens(self) -> int:
        return int(self.cell_tokens.sum())

    @property
    def words(self) -> int:
        return int(self.cell_words.sum())


def _score_rows(model: Model, row: dict, counts: np.ndarray) -> pd.DataFrame:
    """Scores of the texts of a segment; ``counts``: training count of each of its words."""
    s = _unpacked(row)
    firsts = s["firsts"].astype(np.int64)
    tokens, cells = s["tokens"], s["cells"]
    base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
    inside = np.log10((counts + 0.5) / (model.cell_tokens[cells] + 0.5 * (model.cell_words[cells] + 1)))
    chosen = np.zeros(len(tokens))
    for low, high, histories in _stretches(s):
        for some, rows, what in _choices(histories, cells[tokens[low:high]]):
            chosen[low + some] += _log_chances(model.weights, rows, what) / np.log(10)
    total = lambda values: np.add.reduceat(np.append(values, 0.0), firsts[:-1]) if len(firsts) > 1 else np.zeros(0)
    return pd.DataFrame(
        {
            "doc_id": pd.array(row["doc_ids"].as_py(), dtype="Int64"),
            "held_out": s["held"],
            "n_tokens": np.diff(firsts),
            "n_known": total((counts > 0)[tokens].astype(np.float64)).astype(np.int64),
            "base_score": total(base[tokens]),
            "score": total(chosen + inside[tokens]),
        }
    )


def score(docs: DataFrame, held: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``.

    ``held`` names a boolean column; texts where it is true are not learned from
    (null counts as false). Tokens are the words of the whole text, A-Z as a-z,
    and one end, so null and empty texts have one token. Scores are log10
    probabilities of the whole text, ``base_score`` by smoothed word counts alone.
    Repeated rows are learned and scored each. With nothing to learn from, every
    word is unknown and all outcomes of a choice are equally likely.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(held), F.lit(False)).alias("held"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    path = new_folder(docs.sparkSession, "segments")
    segments = _segments(rows, path)
    lists = segments.select("segment", F.posexplode(F.arrays_zip("words", "letters", "counts")).alias("place", "w"))
    lists = lists.select(
        "segment", "place", F.col("w.words").alias("word"), F.col("w.letters").alias("letters"), F.col("w.counts").alias("n")
    )
    counts = lists.groupBy("word").agg(F.sum("n").alias("c"), F.min("letters").alias("letters"))
    counts = written(counts, "counts")
    frequent = [r["word"] for r in counts.where("c > 0").orderBy(F.desc("c"), "word").limit(FREQUENT).collect()]
    own = F.array_position(F.array(*[F.lit(w) for w in frequent]) if frequent else F.array().cast("array<long>"), F.col("word"))
    by_letters = F.lit(FREQUENT) + F.pmod(F.xxhash64("letters"), F.lit(CLASSES - FREQUENT))
    classed = counts.select("word", "c", F.when(own > 0, own - 1).otherwise(by_letters).cast("int").alias("class"))
    # as many cells as there can be, whatever the size of the table
    bits = (LEVELS - 1) * _PART_BITS
    low = F.shiftrightunsigned("word", _LOW_BIT).bitwiseAND((1 << bits) - 1)
    cell = F.col("class").cast("long") * (1 << bits) + low
    sizes = classed.groupBy(cell.alias("cell")).agg(F.sum("c").alias("t"), F.count_if(F.col("c") > 0).alias("v")).collect()
    cell_tokens, cell_words = np.zeros(CLASSES << bits), np.zeros(CLASSES << bits)
    for r in sizes:
        cell_tokens[r["cell"]], cell_words[r["cell"]] = r["t"], r["v"]

    # what a segment gets back: class and count of its words, in their order
    back = lists.select("segment", "place", "word").join(classed, "word").select("segment", "place", "c", "class")
    back = back.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("place", "c", "class"))).alias("list"))
    known = segments.select("segment", "doc_ids", "held", "firsts", "tokens", "words").join(back, "segment")
    known = known.select(
        "doc_ids", "held", "firsts", "tokens", "words",
        F.transform("list", lambda x: x["c"]).alias("known"),
        F.transform("list", lambda x: x["class"].cast("tinyint")).alias("classes"),
    )
    known = written(known, "known")
    # from here on only the segments with their counts are read
    remove(docs.sparkSession, path)

    start = np.zeros((LEVELS << FEATURE_BITS, CLASSES), np.float32)
    for _ in range(rounds):
        start = _round(known, start)
    shared = docs.sparkSession.sparkContext.broadcast((start, cell_tokens, cell_words))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                counted = row["known"].values.to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_pandas(_score_rows(model, row, counted), preserve_index=False)

    out = known.mapInArrow(look, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(int(cell_tokens.sum())).cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs.withColumn("_held", fold_of("doc_id") == 1), "_held").select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
