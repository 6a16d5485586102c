"""Product codes of vectors: a small codebook for each part, refined in rounds with distance bounds.

Vectors become integers and are cut into equal parts; every part position has a
codebook of its own. A round assigns each part to its nearest entry and moves the
entries to the means of what they got.

Most assignments do not change from round to round, and bounds tell which cannot.
With each part go an upper bound of the distance to its entry and a lower bound of
the distance to any other, and the round in which each was measured. The codebooks
of all rounds are retained, so a bound of round s is brought to round t by the true
displacement of an entry between the two (the norm of the sum of its moves), which
is never more than its moves' norms added up. Where the bounds still cross, the
upper one is measured again, and only then all entries are.

A round is one pass that writes vectors with their bounds, and one that adds up
entries; only sums of fixed size (entries times components) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import read
from leadloom.sources.scratch import new_folder, remove, written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
# scaled components are held to this, so that sums of squares fit 64 bits
LIMIT = 1 << 24
# a label with a larger share of the rows than one in so many gets its sum by broadcast
HOT_PARTS = 4096

# the entry of a part, both bounds, and the rounds in which these were measured
BOUNDS = np.dtype([("entry", "u1"), ("upper_round", "u1"), ("lower_round", "u1"), ("upper", "<f4"), ("lower", "<f4")])


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of ``(n, w)`` to ``(k, w)`` integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        # every number here is an integer below 2**53
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def _own_squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of ``(n, w)`` to one entry each."""
    return ((x - entries) ** 2).sum(1)


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + 1e-7)).astype(np.float32), np.float32(np.inf))


def _below(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - 1e-7)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def displacements(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How far each entry lies from where it was in each round, and the most among the others of its part.

    Arrays ``(rounds, parts, entries)``; both are rounded up a little.
    """
    now = history[-1].astype(np.float64)
    own = np.stack([np.sqrt(((now - then) ** 2).sum(-1)) for then in history]) * (1 + 1e-9) + 1e-9
    count = own.shape[-1]
    others = np.zeros_like(own)
    for j in range(count):
        others[..., j] = np.delete(own, j, axis=-1).max(-1, initial=0.0)
    return own, others


def assigned(x: np.ndarray, bounds: np.ndarray | None, history: list[np.ndarray]) -> tuple[np.ndarray, dict[str, int]]:
    """Bounds of ``(n, parts, w)`` integers for the last codebooks of ``history``, and how much was measured.

    ``bounds`` are those of an earlier round, or None for the first one. Of
    entries at the same distance the one with the lower index is taken.
    """
    now, t = history[-1], len(history) - 1
    n, parts = x.shape[:2]
    own, others = displacements(history)
    out = np.zeros((n, parts), BOUNDS) if bounds is None else bounds.copy()
    done = {"kept": 0, "tightened": 0, "scanned": 0}
    for p in range(parts):
        part = out[:, p]
        if bounds is None:
            open_ = np.arange(n)
        else:
            entry = part["entry"]
            upper = part["upper"].astype(np.float64) + own[part["upper_round"], p, entry]
            lower = part["lower"].astype(np.float64) - others[part["lower_round"], p, entry]
            # strictly apart, so no tie is decided by a bound
            crossed = np.flatnonzero(upper >= lower * (1 - 1e-9) - 1e-9)
            done["kept"] += n - len(crossed)
            exact = np.sqrt(_own_squares(x[crossed, p], now[p][entry[crossed]]).astype(np.float64))
            part["upper"][crossed] = _above(exact)
            part["upper_round"][crossed] = t
            still = exact >= lower[crossed] * (1 - 1e-9) - 1e-9
            open_ = crossed[still]
            done["tightened"] += len(crossed) - len(open_)
        if not len(open_):
            continue
        done["scanned"] += len(open_)
        squares = _squares(x[open_, p], now[p])
        best = squares.argmin(1)
        rows = np.arange(len(open_))
        nearest = np.sqrt(squares[rows, best].astype(np.float64))
        rest = squares.astype(np.float64)
        rest[rows, best] = np.inf
        part["entry"][open_] = best
        part["upper"][open_] = _above(nearest)
        part["lower"][open_] = _below(np.sqrt(rest.min(1)))
        part["upper_round"][open_] = part["lower_round"][open_] = t
    return out, done


def _cube(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """A column of arrays as ``(n, parts, width)`` integers; missing components at the end are 0."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((n, parts * width), np.int64)
    if n and len(flat):
        out[:, : len(flat) // n] = flat.reshape(n, -1)
    return out.reshape(n, parts, width)


def _bounds(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), BOUNDS).reshape(-1, parts)


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, x)`` of rows whose vector has no null and no component that is not finite, scaled."""
    raw = F.col(f"`{vector_col}`")
    finite = F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))

    def scaled(v):
        return F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int")

    return vectors.where(raw.isNotNull() & finite).select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.transform(raw, scaled).alias("x")
    )


class Codebooks:
    """Codebooks of all rounds, and the rows assigned to the last ones."""

    def __init__(self, history: list[np.ndarray], rows: DataFrame | None, measured: list[dict[str, int]]):
        self.history, self.rows, self.measured = history, rows, measured

    @property
    def sha256(self) -> str:
        flat = self.history[-1].reshape(-1).tolist() if self.history else []
        return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def _assign_pass(rows: DataFrame, history: list[np.ndarray], first: bool) -> DataFrame:
    parts, _, width = history[0].shape
    schema = T.StructType([*rows.schema.fields[:3], *T._parse_datatype_string("bounds binary, kept int, tightened int, scanned int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            before = None if first else _bounds(batch.column(3), parts)
            after, done = assigned(_cube(batch.column(2), parts, width), before, history)
            # how much was measured stands in the batch's first row
            counts = [pa.array([done[k], *[0] * (n - 1)], pa.int32()) for k in ("kept", "tightened", "scanned")]
            made = pa.array([row.tobytes() for row in after], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], made, *counts], schema.names)

    return rows.mapInArrow(run, schema)


def _sums(rows: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and counts of all entries, added up in tasks first."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, entry = _cube(batch.column(0), parts, width), _bounds(batch.column(1), parts)["entry"]
            for p in range(parts):
                order = np.argsort(entry[:, p], kind="stable")
                found, at = np.unique(entry[order, p], return_index=True)
                sums[p, found, :width] += np.add.reduceat(x[order, p], at, axis=0)
                sums[p, found, width] += np.diff([*at, len(order)])
        place = np.flatnonzero(sums.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums.reshape(-1)[place])], ["place", "value"])

    added = rows.select("x", "bounds").mapInArrow(run, "place long, value long").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(parts * entries * (width + 1), np.int64)
    # one number for each component of each entry, whatever the number of rows
    for place, value in added.collect():
        out[place] = value
    out = out.reshape(parts, entries, width + 1)
    return out[..., :width], out[..., width]


def train(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks after ``rounds`` rounds, and ``(vec_id, label, x, bounds)`` for them, in the shared folder.

    Rows whose vector is null or has null or non-finite components are left out.
    The vectors with the smallest ids (null ids last, then by their components)
    are the first entries; of fewer rows than entries each is one. Where the
    vector with the smallest id has another length than a row, that row is left
    out too; a length that is no multiple of ``parts`` is filled with zeros at the
    end. Scaled components beyond plus or minus ``LIMIT`` count as that. No rows
    give no codebooks.
    """
    rows = _kept(vectors, id_col, vector_col, label_col)
    first = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "x").limit(1).collect()
    if not first:
        return Codebooks([], None, [])
    size = len(first[0]["x"])
    width = -(-size // parts)
    rows = rows.where(F.size("x") == size)
    found = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "x").limit(entries).collect()
    start = np.zeros((len(found), parts * width), np.int64)
    start[:, :size] = [r["x"] for r in found]
    history = [start.reshape(len(found), parts, width).swapaxes(0, 1)]
    spark, before, measured = vectors.sparkSession, None, []
    for t in range(rounds + 1):
        path = new_folder(spark, "codes")
        _assign_pass(rows, history, t == 0).write.parquet(path)
        rows = spark.read.parquet(path)
        measured.append({k: v or 0 for k, v in rows.agg(*[F.sum(k).alias(k) for k in ("kept", "tightened", "scanned")]).first().asDict().items()})
        rows = rows.select("vec_id", "label", "x", "bounds")
        if before is not None:
            remove(spark, before)
        before = path
        if t < rounds:
            sums, counts = _sums(rows, history[0].shape)
            moved = sums // np.maximum(counts, 1)[..., None]
            history.append(np.where(counts[..., None] > 0, moved, history[-1]))
    return Codebooks(history, rows, measured)


def encode(books: Codebooks) -> DataFrame:
    """``(vec_id, label, code, error)``: two hex digits for each part, and the squared distances added up."""
    last = books.history[-1]
    parts, _, width = last.shape
    schema = T.StructType([*books.rows.schema.fields[:2], *T._parse_datatype_string("code string, error long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, entry = _cube(batch.column(2), parts, width), _bounds(batch.column(3), parts)["entry"]
            error = sum(_own_squares(x[:, p], last[p][entry[:, p]]) for p in range(parts))
            codes = [bytes(row).hex() for row in entry]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(codes), pa.array(error)], schema.names)

    return books.rows.mapInArrow(run, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error of all rows with the same label; nulls together.

    Labels that more than one row in ``HOT_PARTS`` has, fewer than that by
    definition, are joined by broadcast; the others by a shuffle in which no key
    is large.
    """
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    total = sums.agg(F.sum("n")).first()[0] or 0
    sums = sums.withColumn("hot", F.col("n") * HOT_PARTS > total).drop("n")
    hot = F.broadcast(sums.where("hot").drop("hot").withColumnRenamed("label", "of"))
    rare = sums.where("NOT hot").drop("hot").withColumnRenamed("label", "of")
    near = coded.join(hot, F.col("label").eqNullSafe(F.col("of")), "inner").drop("of")
    far = coded.join(hot.select("of"), F.col("label").eqNullSafe(F.col("of")), "left_anti")
    return near.unionByName(far.join(rare, F.col("label").eqNullSafe(F.col("of")), "inner").drop("of"))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, one row for each row with a whole, finite vector.

    Ids and labels are kept as they are, null or repeated; other columns play no
    part. See ``train`` for rows that are left out. No rows give no rows.
    """
    books = train(vectors, id_col, vector_col, label_col)
    if books.rows is None:
        id_type = vectors.schema[id_col].dataType.simpleString()
        empty = f"vec_id {id_type}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    coded = with_label_errors(written(encode(books), "codes"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))
