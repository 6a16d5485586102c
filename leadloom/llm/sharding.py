"""Shards of near equal bytes by histogram sort.

Rows are ordered by a hash of their content, then id, then place in the table.
Splitters of that order are searched without moving a row: every round counts
the exact bytes between equally spaced probes inside the intervals that still
hold a splitter, and narrows these, until each splitter has the wanted bytes
below it within a tolerance. Then the rows are exchanged once.

The driver sees counts per probe only: at most ``2**_TOP`` in the first round,
``_PROBES`` for each open splitter afterwards.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.common import shuffle_partitions
from leadloom.sources.scratch import written

# the first round's probes: the highest bits of a 62-bit content hash
_BITS, _TOP = 62, 14
_PROBES = 1024
# bytes a splitter may be off, as a share of a range (of which a shard has several)
TOLERANCE = 0.02
_KEY = ["key_h", "key_id", "key_row"]
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns, with the sort key and the size; written, so that the row's place is fixed."""
    text = F.col(text_col)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - _BITS).alias("key_h"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("key_id"),
        F.monotonically_increasing_id().alias("key_row"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
    )
    return written(rows.withColumn("key_top", F.shiftright("key_h", _BITS - _TOP).cast("int")), "keyed")


class _Open:
    """An interval that holds a splitter: fixed leading keys, and a range (both ends included) of the next one."""

    def __init__(self, target: float, fixed: tuple, low: int, high: int, below: int) -> None:
        self.target, self.fixed, self.low, self.high, self.below = target, fixed, low, high, below

    def narrowed(self, target: float, counts: list[tuple[int, int, int]], slack: float):
        """The splitter, if one of the probes will do, else a smaller interval.

        ``counts``: (first value, last value, bytes) of the non-empty bins, in order.
        """
        below = self.below
        for first, last, size in counts:
            if below + size >= target:
                break
            below += size
        after = min(last + 1, _HIGHEST)
        ways = [(abs(below - target), (*self.fixed, first)), (abs(below + size - target), (*self.fixed, after))]
        off, best = min(ways)
        # one value of the last key cannot be cut: the nearer edge is the best there is
        if off <= slack or (first == last and len(self.fixed) == len(_KEY) - 1):
            return best, None
        if first == last:  # one value holds more than the slack: go on with the next key
            return None, _Open(target, (*self.fixed, first), _LOWEST, _HIGHEST, below)
        return None, _Open(target, self.fixed, first, last, below)


def _bins(spark, slim: DataFrame, cells: list[_Open]) -> dict[int, list[tuple[int, int, int]]]:
    """Exact bytes between the probes of every open interval; all have as many fixed keys."""
    depth = len(cells[0].fixed)
    column = _KEY[depth]
    numbered = [(i, *c.fixed, c.low, c.high) for i, c in enumerate(cells)]
    fixed = ", ".join(f"f{k} long" for k in range(depth))
    table = spark.createDataFrame(numbered, f"cell int, {fixed + ', ' if fixed else ''}low long, high long")
    # as many rows as open splitters, which the number of ranges bounds
    if depth == 0:
        table = table.withColumn("f", F.shiftright("low", _BITS - _TOP).cast("int"))
        rows = slim.join(F.broadcast(table), F.col("key_top") == F.col("f"))
    else:
        rows = slim.join(F.broadcast(table), [F.col(_KEY[k]) == F.col(f"f{k}") for k in range(depth)])
    rows = rows.where(F.col(column).between(F.col("low"), F.col("high"))).drop("low", "high")
    reach = rows.groupBy("cell").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    rows = rows.join(F.broadcast(reach), "cell")
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    step = F.greatest(F.ceil((whole("high") - whole("low") + 1) / _PROBES), F.lit(1).cast("decimal(20,0)"))
    bin = F.floor((whole(column) - whole("low")) / step).cast("long")
    found = (
        rows.groupBy("cell", bin.alias("bin"))
        .agg(F.min(column).alias("first"), F.max(column).alias("last"), F.sum("size").alias("size"))
        .collect()
    )
    out = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["cell"], r["bin"])):
        out[r["cell"]].append((r["first"], r["last"], r["size"]))
    return out


def find_splitters(slim: DataFrame, ranges: int, tolerance: float = TOLERANCE) -> list[tuple]:
    """``ranges - 1`` keys, some perhaps equal, with near equal bytes between them.

    A key may leave out trailing columns; a row is above it if its own columns,
    as many, are not less.
    """
    spark = slim.sparkSession
    top = slim.groupBy("key_top").agg(
        F.min("key_h").alias("first"), F.max("key_h").alias("last"), F.sum("size").alias("size")
    )
    top = sorted((r["first"], r["last"], r["size"]) for r in top.collect())
    total = sum(size for _, _, size in top)
    if not total:
        return []
    slack = tolerance * total / ranges
    found: dict[int, tuple] = {}
    cells: dict[int, _Open] = {}
    everything = _Open(0, (), 0, (1 << _BITS) - 1, 0)
    for i in range(1, ranges):
        done, cell = everything.narrowed(total * i / ranges, top, slack)
        (found if done else cells)[i] = done or cell
    while cells:
        for depth in range(len(_KEY)):
            now = [(i, c) for i, c in cells.items() if len(c.fixed) == depth]
            if not now:
                continue
            counts = _bins(spark, slim, [c for _, c in now])
            for at, (i, cell) in enumerate(now):
                done, smaller = cell.narrowed(cell.target, counts[at], slack)
                if done:
                    found[i] = done
                    del cells[i]
                else:
                    cells[i] = smaller
    return [found[i] for i in sorted(found)]


def _with_range(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """``rows`` with the number of splitters at or below their key."""
    spark = rows.sparkSession
    full = sorted(tuple(s) + (_LOWEST,) * (len(_KEY) - len(s)) for s in splitters)
    tops = [min(s[0] >> (_BITS - _TOP), (1 << _TOP) - 1) for s in full]
    cuts = defaultdict(list)
    for s, t in zip(full, tops):
        cuts[t].append(s)
    # one row for each of the 2**_TOP values, whatever the table's size
    table = [(t, bisect_right(tops, t - 1), cuts.get(t, [])) for t in range(1 << _TOP)]
    kind = f"key_top int, base int, cuts array<struct<{', '.join(f'{k}: long' for k in _KEY)}>>"
    table = spark.createDataFrame(table, kind.replace(": ", ":"))
    passed = F.size(F.filter("cuts", lambda c: c <= F.struct(*_KEY)))
    return rows.join(F.broadcast(table), "key_top").withColumn("range", F.col("base") + passed).drop("base", "cuts")


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """``(row, size, shard, slot)``: every row of ``docs`` as a struct, in one of ``shards`` shards.

    ``size`` is the UTF-8 bytes of the text plus one; a null text has none. Shards
    have near equal bytes. ``slot`` counts the rows of a shard from 0 in the order
    of content hash, id and place. Equal texts are neighbours, so they share a
    shard unless a splitter falls among them. Null ids come first. Repeated rows
    are rows of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    per_shard = max(1, -(-shuffle_partitions(spark) // shards))
    ranges = shards * per_shard
    slim = keyed.select("key_top", *_KEY, "size")
    splitters = find_splitters(slim, ranges, tolerance)
    counts = {r["range"]: r["n"] for r in _with_range(slim, splitters).groupBy("range").agg(F.count("*").alias("n")).collect()}
    before, table = 0, []
    for k in range(ranges):
        before = 0 if k % per_shard == 0 else before
        table.append((k, k // per_shard, before))
        before += counts.get(k, 0)
    table = spark.createDataFrame(table, "range int, shard int, before long")
    placed = _with_range(keyed, splitters).repartitionByRange(ranges, "range")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*_KEY)) - 1
    # one row for each range
    placed = placed.withColumn("place", place).join(F.broadcast(table), "range")
    return placed.select("row", "size", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
