"""Fill-in-middle rows from texts that are stored as independent compressed frames.

A text is cut into units: runs of ASCII letters, and every other code point for
itself. ``store`` keeps it as zstandard frames of ``FRAME_BYTES`` bytes at most
that can be decompressed one by one, each with the number of units, code points
and bytes before it. ``transform`` draws two cuts from a hash of the id, looks
them up in the cumulative unit counts, and decompresses only the frames that the
cuts fall into; the output is streamed frame by frame into its digest and into
frames of its own, from which the text is put together again. Memory holds one
decompressed frame of a text and its compressed ones, however long it is.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>``
suffix ``<P>`` prefix ``<M>`` middle, ``plain`` the text as it is. Texts that hold
a mark of their own stay plain, so an output can always be taken apart.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import read
from leadloom.llm.words import text_buffers
from leadloom.sources.scratch import written

FRAME_BYTES = 32 << 10
# shares, in percent, of texts that stay plain, and of spm among the others
PLAIN, SPM = 10, 20
MARKS = ("<P>", "<S>", "<M>")

_FRAME = pa.struct(
    [("units", pa.int64()), ("points", pa.int64()), ("at", pa.int64()), ("joined", pa.bool_()), ("data", pa.binary())]
)
_STORED = "n_units long, n_points long, n_bytes long, frames array<struct<units long, points long, at long, joined boolean, data binary>>"


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data | 0x20) - np.uint8(97)) < 26


def _points(data: np.ndarray) -> np.ndarray:
    """Where a code point begins in UTF-8."""
    return (data & 0xC0) != 0x80


def unit_starts(data: np.ndarray, bounds: np.ndarray, joined: bool = False) -> np.ndarray:
    """Where a unit begins; ``joined`` says that a letter stands before the first byte."""
    letter = _letters(data)
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = letter[first]
    if joined and len(data):
        begins[0] = False
    return begins | (_points(data) & ~letter)


def _frame_starts(data: np.ndarray, begin: int, end: int, size: int) -> list[int]:
    """First bytes of the frames of one text, always at a code point."""
    starts = []
    while begin < end:
        starts.append(begin)
        to = begin + size
        while to < end and data[to] & 0xC0 == 0x80:
            to -= 1
        begin = to if to > begin else begin + size
    return starts


def _compressed(batch: pa.RecordBatch, size: int) -> list[pa.Array]:
    """Counts and frames of the texts in the last column."""
    packer = zstandard.ZstdCompressor(level=3)
    data, bounds = text_buffers(batch.column(batch.num_columns - 1))
    starts, points, letters = unit_starts(data, bounds), _points(data), _letters(data)
    units_of, points_of, frames_of = [], [], []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        units = chars = 0
        frames = []
        cuts = _frame_starts(data, begin, end, size)
        for at, to in zip(cuts, [*cuts[1:], end]):
            joined = at > begin and bool(letters[at - 1])
            packed = packer.compress(data[at:to].tobytes())
            frames.append({"units": units, "points": chars, "at": at - begin, "joined": joined, "data": packed})
            units += int(np.count_nonzero(starts[at:to]))
            chars += int(np.count_nonzero(points[at:to]))
        units_of.append(units)
        points_of.append(chars)
        frames_of.append(frames)
    counts = [pa.array(units_of, pa.int64()), pa.array(points_of, pa.int64()), pa.array(np.diff(bounds), pa.int64())]
    return [*counts, pa.array(frames_of, pa.list_(_FRAME))]


def _extended(df: DataFrame, added: str | T.StructType, keep: int, make: Callable) -> DataFrame:
    """The first ``keep`` columns of ``df`` and those that ``make`` gives for a batch."""
    more = T._parse_datatype_string(added) if isinstance(added, str) else added
    schema = T.StructType([*df.schema.fields[:keep], *more.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *make(batch)], schema.names)

    return df.mapInArrow(run, schema)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``(id, marked, n_units, n_points, n_bytes, frames)``, one row for each row of ``docs``.

    Frames are in order; each has the units, code points and bytes before it, and
    says whether it goes on with a run of letters. ``marked`` says that the text
    holds one of the marks. Null and empty texts have no frames. Ids are kept as
    they are, of any type, null or repeated; other columns of ``docs`` play no
    part. No rows give no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    marked = text.contains(MARKS[0]) | text.contains(MARKS[1]) | text.contains(MARKS[2])
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), marked.alias("marked"), text.alias("text"))
    return _extended(rows, _STORED, 2, lambda batch: _compressed(batch, frame_bytes))


class Frames:
    """One text as frames: random access to its units, and its bytes in order."""

    def __init__(self, frames: list[dict], n_units: int, n_points: int, n_bytes: int):
        self.frames, self.n_units, self.n_points, self.n_bytes = frames, n_units, n_points, n_bytes
        self._units = [f["units"] for f in frames]
        self._at = [f["at"] for f in frames]
        self._reader = zstandard.ZstdDecompressor()
        self._last, self._open = -1, b""

    def _frame(self, i: int) -> bytes:
        if i != self._last:
            self._last, self._open = i, self._reader.decompress(self.frames[i]["data"])
        return self._open

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units; decompresses at most one frame."""
        if units >= self.n_units:
            return self.n_bytes, self.n_points
        i = bisect_right(self._units, units) - 1
        frame = self.frames[i]
        data = np.frombuffer(self._frame(i), np.uint8)
        starts = unit_starts(data, np.array([0, len(data)]), frame["joined"])
        inside = int(np.flatnonzero(starts)[units - frame["units"]])
        return frame["at"] + inside, frame["points"] + int(np.count_nonzero(_points(data[:inside])))

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        """The bytes from ``begin`` to ``end``, a frame at a time."""
        i = max(bisect_right(self._at, begin) - 1, 0)
        while begin < end:
            data, at = self._frame(i), self._at[i]
            yield data[begin - at : end - at]
            begin = at + len(data)
            i += 1

    def find(self, mark: bytes, begin: int) -> int:
        """First place of ``mark`` at or after ``begin``; it may lie across frames."""
        tail, place = b"", begin
        for part in self.read(begin, self.n_bytes):
            found = (tail + part).find(mark)
            if found >= 0:
                return place - len(tail) + found
            place += len(part)
            tail = (tail + part)[1 - len(mark) :]
        raise ValueError(f"no {mark!r} in the output")


class _Sink:
    """Takes bytes in order; keeps their digest and frames of ``size`` bytes."""

    def __init__(self, size: int):
        self.size, self.digest, self.frames, self.total = size, hashlib.sha256(), [], 0
        self._packer, self._rest = zstandard.ZstdCompressor(level=1), b""

    def add(self, part: bytes) -> None:
        self.digest.update(part)
        self._rest += part
        while len(self._rest) >= self.size:
            self._flush(self.size)

    def _flush(self, size: int) -> None:
        part, self._rest = self._rest[:size], self._rest[size:]
        self.frames.append({"units": 0, "at": self.total, "data": self._packer.compress(part)})
        self.total += len(part)

    def close(self) -> Frames:
        if self._rest:
            self._flush(self.size)
        return Frames(self.frames, 0, 0, self.total)


def arranged(text: Frames, form: str, first: int, second: int, size: int = FRAME_BYTES) -> tuple[Frames, str]:
    """The output of a text cut at two bytes, as frames, and its digest."""
    sink = _Sink(size)
    prefix, middle, suffix = (0, first), (first, second), (second, text.n_bytes)
    order = {
        "plain": [(b"", (0, text.n_bytes))],
        "psm": [(b"<P>", prefix), (b"<S>", suffix), (b"<M>", middle)],
        "spm": [(b"<S>", suffix), (b"<P>", prefix), (b"<M>", middle)],
    }[form]
    for mark, span in order:
        sink.add(mark)
        for part in text.read(*span):
            sink.add(part)
    return sink.close(), sink.digest.hexdigest()


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The text that an output was made from, by its form alone."""
    if form == "plain":
        yield from output.read(0, output.n_bytes)
        return
    second = output.find(b"<S>" if form == "psm" else b"<P>", 3)
    third = output.find(b"<M>", second + 3)
    one, two, middle = (3, second), (second + 3, third), (third + 3, output.n_bytes)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    for span in (prefix, middle, suffix):
        yield from output.read(*span)


def _drawn(id: Column, seed: int) -> list[Column]:
    """Four numbers from the hash of seed and id; a null id counts as the empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def plan(stored: DataFrame, seed: int = 1, plain: int = PLAIN, spm: int = SPM) -> DataFrame:
    """``stored`` with ``form``, ``first`` and ``second``: the units before the middle and before the suffix."""
    h = _drawn(F.col("id"), seed)
    a, b = (F.pmod(x, F.col("n_units") + 1) for x in h[:2])
    whole = (F.col("n_units") == 0) | F.col("marked") | (h[2] % 100 >= 100 - plain)
    form = F.when(whole, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    return stored.withColumns({"form": form, "first": F.least(a, b), "second": F.greatest(a, b)})


_DIGESTS = "prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def transform(
    stored: DataFrame, seed: int = 1, plain: int = PLAIN, spm: int = SPM, keep_output: bool = True, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """``(id, n_units, form, prefix_chars, middle_chars, output_sha256, restored_sha256, output)`` for rows of ``store``.

    ``output`` holds the output's frames, in order; each is a zstandard frame.
    ``keep_output`` leaves it out. ``restored_sha256`` is the digest of the text
    that was put together again from output and form. Plain rows have no prefix
    and middle. A null id draws as the empty text; rows that repeat an id draw
    alike. No rows give no rows.
    """
    rows = plan(stored, seed, plain, spm).select("id", "n_units", "form", "first", "second", "n_points", "n_bytes", "frames")
    kind = _DIGESTS + (", output array<binary>" if keep_output else "")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        columns = [batch.column(i).to_pylist() for i in range(1, 7)]
        for i, (units, form, first, second, points, size) in enumerate(zip(*columns)):
            text = Frames(batch.column(7)[i].as_py(), units, points, size)
            begin, middle = (text.cut(first), text.cut(second)) if form != "plain" else ((0, None), (0, None))
            made, digest = arranged(text, form, begin[0], middle[0], frame_bytes)
            again = hashlib.sha256()
            for part in restored(made, form):
                again.update(part)
            inner = None if form == "plain" else middle[1] - begin[1]
            row = [begin[1], inner, digest, again.hexdigest()]
            out.append([*row, [f["data"] for f in made.frames]] if keep_output else row)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.binary())]
        return [pa.array(column, k) for column, k in zip(zip(*out), kinds)]

    return _extended(rows, kind, 3, make)


def texts(frames: DataFrame, col: str = "output") -> DataFrame:
    """``frames`` with the frames in ``col`` (arrays of binary) replaced by the text that they hold."""
    names = [c for c in frames.columns if c != col]
    rows = frames.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{col}`"))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        reader = zstandard.ZstdDecompressor()
        parts = batch.column(batch.num_columns - 1).to_pylist()
        return [pa.array([None if p is None else b"".join(map(reader.decompress, p)).decode() for p in parts], pa.string())]

    return _extended(rows, T.StructType([T.StructField(col, T.StringType())]), len(names), make)


def query(spark, sf_dir: str) -> DataFrame:
    stored = written(store(read(spark, sf_dir, "documents")), "frames")
    return transform(stored, keep_output=False).select(
        F.col("id").alias("doc_id"), F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || doc_id::VARCHAR) AS h FROM d),
h AS (SELECT doc_id, t, units, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM u),
f AS (SELECT doc_id, t, units, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
  array_to_string(units[b + 1:n], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
