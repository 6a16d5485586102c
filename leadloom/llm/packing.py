"""Best-fit packing of documents into sequences of several permitted lengths.

Texts are cut into pieces of at most the longest permitted length, and pieces
are packed best-fit decreasing: a piece goes where it leaves the least room, and
where it fits nowhere a new sequence is opened. Which length to open is settled
jointly: the tasks try every plan (each permitted length as the preferred one,
and the cheapest per expected token), shrink every sequence to the smallest
length that holds its contents, and keep the plan of least cost.

Pieces are dealt to tasks by a hash of their place, in a number of parts that
follows from their count, so a task packs a bounded number of them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.sources.scratch import written

LENGTHS = (512, 1024, 2048, 4096, 8192)
# pieces that one task packs
PART_PIECES = 50_000
# what a sequence costs besides its tokens, and the length at which attention costs as much as the rest
_OVERHEAD, _QUADRATIC = 16, 65536


def costs_of(lengths: tuple[int, ...]) -> dict[int, float]:
    """Default cost of a sequence by its length: tokens, a fixed part, and a quadratic part."""
    return {c: c + _OVERHEAD + c * c / _QUADRATIC for c in lengths}


def n_words(text: Column) -> Column:
    """Words (runs of anything but white space) and one end-of-text token."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")), " ")
    return F.when(F.array_contains(words, ""), F.size(words) - 1).otherwise(F.size(words)).cast("long") + 1


def _opened(size: int, supply: int, lengths: tuple[int, ...], costs: dict[int, float], plan: int) -> int:
    """The length to open for a piece, with ``supply`` tokens still to come."""
    fitting = [c for c in lengths if c >= size]
    if plan:
        return max(plan, fitting[0])
    return min(fitting, key=lambda c: (costs[c] / min(c, size + supply), c))


def _plan(sizes: np.ndarray, lengths: tuple[int, ...], costs: dict[int, float], plan: int):
    """Best-fit decreasing: sequence and start of each piece (in descending order), contents of each."""
    bins, starts = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (free, sequence), ascending
    supply = int(sizes.sum())
    for i, size in enumerate(sizes.tolist()):
        supply -= size
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, k = room.pop(at)
        else:
            free, k = _opened(size, supply, lengths, costs, plan), len(used)
            used.append(0)
        bins[i], starts[i] = k, used[k]
        used[k] += size
        if free > size:
            insort(room, (free - size, k))
    contents = np.array(used, np.int64)
    final = np.array(lengths)[np.searchsorted(lengths, contents)]
    return sum(costs[c] for c in final.tolist()), bins, starts, contents, final


def pack_part(sizes: np.ndarray, lengths: tuple[int, ...], costs: dict[int, float]):
    """The cheapest of the plans for pieces in descending order."""
    plans = (0, *lengths)
    return min((_plan(sizes, lengths, costs, p) for p in plans), key=lambda found: found[0])


def pieces_of(docs: DataFrame, length: Column, longest: int) -> DataFrame:
    """``docs`` once for every piece: ``piece``, ``n_pieces``, ``first`` and ``size`` in tokens."""
    n_pieces = F.ceil(F.col("length") / longest).cast("int")
    rows = docs.withColumn("length", length).withColumn("n_pieces", F.greatest(n_pieces, F.lit(1)))
    rows = rows.withColumn("piece", F.explode(F.expr("sequence(0, n_pieces - 1)")))
    first = F.col("piece").cast("long") * longest
    size = F.least(F.lit(longest).cast("long"), F.col("length") - first)
    return rows.withColumns({"first": first, "size": size})


def pack(
    docs: DataFrame,
    lengths: tuple[int, ...] = LENGTHS,
    costs: dict[int, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, n_pieces, first, size, sequence, capacity, start, filled)``.

    One row for each piece of each row of ``docs``: tokens ``first`` to ``first +
    size`` of the text lie at ``start`` of the sequence, which has ``capacity``
    tokens (one of ``lengths``), ``filled`` of them used. Tokens are words and one
    end of text, so null and empty texts are one piece of one token. Nothing is
    dropped or padded inside. Repeated rows and null ids are packed like any other
    row; equal sizes keep no particular order.
    """
    lengths = tuple(sorted(lengths))
    costs = costs or costs_of(lengths)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), n_words(F.col(text_col)).alias("length"))
    cut = pieces_of(rows, F.col("length"), lengths[-1]).withColumn("spot", F.monotonically_increasing_id())
    cut = written(cut.select("doc_id", "piece", "n_pieces", "first", "size", "spot"), "pieces")
    parts = max(1, -(-cut.count() // PART_PIECES))

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def packed() -> pd.DataFrame:
            frame = pd.concat(held)
            _, bins, starts, contents, final = pack_part(frame["size"].to_numpy(), lengths, costs)
            return pd.DataFrame(
                {
                    **{c: frame[c].to_numpy() for c in ("piece", "n_pieces", "first", "size")},
                    "doc_id": frame["doc_id"].astype("Int64").to_numpy(),
                    "sequence": int(frame["part"].iat[0]) * (1 << 32) + bins,
                    "capacity": final[bins],
                    "start": starts,
                    "filled": contents[bins],
                }
            )

        for frame in frames:
            frame = frame.astype({"doc_id": "Int64"})
            for part in frame["part"].unique():
                own = frame[frame["part"] == part]
                if held and held[0]["part"].iat[0] != part:
                    yield packed()
                    held.clear()
                held.append(own)
        if held:
            yield packed()

    dealt = cut.withColumn("part", F.pmod(F.xxhash64("spot"), F.lit(parts)).cast("long"))
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", F.desc("size"), "spot")
    kept = "doc_id long, piece int, n_pieces int, first long, size long"
    return ordered.mapInPandas(put, f"{kept}, sequence long, capacity long, start long, filled long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row for each sequence: its capacity, what is used, and its pieces in order."""
    piece = F.struct("start", "doc_id", "piece", "first", "size")
    return packed.groupBy("sequence").agg(
        F.first("capacity").alias("capacity"),
        F.first("filled").alias("filled"),
        F.array_sort(F.collect_list(piece)).alias("pieces"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
