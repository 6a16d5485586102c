"""Exact Jaccard join of word-shingle sets in metric space.

The Jaccard distance is a metric, and links are pairs within a radius ``r``. The
join divides the space by pivots, sends to the region of a pivot every document
that can have a link there, and joins the regions on their own.

First level. Unrelated documents are all at distance 1 from each other and from
any document chosen as a pivot, so windows around document pivots alone would
hold the whole table. The first pivots are therefore sets of one shingle, in a
global order from rare to frequent: ``x`` is replicated to its first
``|x| - ceil(t|x|) + 1`` of them, the window in which two linked sets are bound
to meet. Where the sizes there leave a gap that no link can cross, the documents
fall apart. The smallest document of each part becomes the pivot of a region, and
regions with the same pivot are one. So a link lies in a region as a whole.

Regions. Pivot after pivot, the distances to all members are worked out; members
within ``r`` are linked to the pivot. A pair needs no further look if both are
linked already (in)directly, or if their distances to some pivot differ by more
than ``r`` (triangle inequality). Close groups are done after a few pivots
instead of all pairs.

Large regions. What does not fit in a task is joined in two rounds over salted
slices: first all members with a few pivots; then, in blocks, only members
outside the largest linked group with the members that their windows reach.

Sets hold 64-bit hashes of shingles; a set is known by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leadloom.llm.words import mixed, shingle_sets
from leadloom.operators.components import components
from leadloom.sources.scratch import written

# frequencies are counted in so many cells, whatever the table's size; they only order the pivots
_CELL_BITS = 22
_PARTS = 256
# elements of the sets of a region that one task takes; larger regions are cut
REGION_ELEMENTS = 4 << 20
# pivots of the first round over a large region
ROUND_PIVOTS = 16
# texts hashed together
_BYTES = 4 << 20


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; linked if ``100 * shared >= percent * all``."""

    words: int = 5
    percent: int = 80

    def window(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100


def _set_hash(found: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set, in two signed halves."""
    a = mixed(found * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = mixed(found ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) + np.uint64(len(found))
    return tuple(mixed(np.array([a, b], np.uint64)).view(np.int64).tolist())


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes (or one row)."""
    sizes = np.zeros(batch.num_rows + 1, np.int64)
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    np.cumsum(lengths.to_numpy(zero_copy_only=False), out=sizes[1:])
    low = 0
    while low < batch.num_rows:
        high = max(int(np.searchsorted(sizes, sizes[low] + _BYTES, "right")) - 1, low + 1)
        yield batch.slice(low, high - low)
        low = high


def _profiles(docs: DataFrame, how: Similarity) -> DataFrame:
    """One row for each document, and rows with the frequencies seen by each task."""
    schema = "doc_id long, n long, a long, b long, part int, cells binary"
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()),
         ("cells", pa.binary())]
    )

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _CELL_BITS, np.uint32)
        for whole in batches:
            for batch in _slices(whole, 1):
                sets = shingle_sets(batch.column(1), how.words)
                n = [len(s) for s in sets]
                hashes = [_set_hash(s) for s in sets]
                if sum(n):
                    cell = np.concatenate(sets) >> np.uint64(64 - _CELL_BITS)
                    counts += np.bincount(cell.astype(np.int64), minlength=len(counts)).astype(np.uint32)
                empty = pa.nulls(len(n), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array([h[0] for h in hashes], pa.int64()),
                     pa.array([h[1] for h in hashes], pa.int64()), pa.nulls(len(n), pa.int32()), empty],
                    schema=kinds,
                )
        size = len(counts) // _PARTS
        # one byte each: beyond 255 in one task a shingle is frequent enough
        counts = np.minimum(counts, 255).astype(np.uint8)
        parts = [(p, counts[p * size : (p + 1) * size]) for p in range(_PARTS)]
        parts = [(p, c) for p, c in parts if c.any()]
        none = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array([p for p, _ in parts], pa.int32()),
             pa.array([c.tobytes() for _, c in parts], pa.binary())],
            schema=kinds,
        )

    return written(docs.mapInArrow(profile, schema), "profiles")


def _frequencies(profiles: DataFrame) -> np.ndarray:
    """Counts of all cells: a table of fixed size, summed part by part inside tasks."""

    def add(frames: Iterator[pd.DataFrame], kind=np.uint8) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for part, cells in zip(frame["part"], frame["cells"]):
                seen = np.frombuffer(cells, kind).astype(np.uint32)
                sums[part] = np.minimum(sums[part] + seen, 0xFFFF) if part in sums else seen
        for part, total in sums.items():
            yield pd.DataFrame({"part": [part], "cells": [total.astype(np.uint16).tobytes()]})

    cells = profiles.where("part IS NOT NULL").select("part", "cells")
    # two steps, so that no task adds up what all tasks have seen of a part
    salted = cells.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("part", "salt")
    some = salted.select("part", "cells").mapInPandas(add, "part int, cells binary")
    summed = some.repartition("part").mapInPandas(lambda f: add(f, np.uint16), "part int, cells binary")
    out = np.zeros(1 << _CELL_BITS, np.uint16)
    size = len(out) // _PARTS
    for r in summed.collect():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["cells"], np.uint16)
    return out


def _windows(docs: DataFrame, how: Similarity, frequencies: np.ndarray) -> DataFrame:
    """``(pivot, a, n)``: the first pivots of every set, once for the copies in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)
    kinds = pa.schema([("shingle", pa.int64()), ("a", pa.int64()), ("n", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for whole in batches:
            for batch in _slices(whole, 0):
                out, names, sizes, times = [], [], [], []
                for found in shingle_sets(batch.column(0), how.words):
                    first = how.window(len(found))
                    # a set of so few shingles is linked with equal sets only
                    if len(found) * 100 < (len(found) + 1) * how.percent or not len(found):
                        continue
                    name = _set_hash(found)[0]
                    if name in seen:
                        continue
                    seen.add(name)
                    rank = counts[(found >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]
                    # equal frequencies are ordered by hash, as sets are sorted by it
                    chosen = found[np.argsort(rank, kind="stable")[:first]]
                    out.append(chosen)
                    names.append(name)
                    sizes.append(len(found))
                    times.append(first)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(names, times), pa.int64()),
                         pa.array(np.repeat(sizes, times), pa.int32())],
                        schema=kinds,
                    )

    return docs.select("text").mapInArrow(place, "shingle long, a long, n int")


class _Joined:
    """Sets of a region as an inverted index, with labels of what is linked so far."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.keys, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.labels = np.arange(len(sets))

    def distances(self, found: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Distance of every member to a set, and whether it is linked with it."""
        shared = np.zeros(len(self.sizes), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            at = at[self.keys[at] == found]
            low, count = self.first[at], self.first[at + 1] - self.first[at]
            total = int(count.sum())
            if total:
                steps = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                shared = np.bincount(self.owner[np.repeat(low, count) + steps], minlength=len(self.sizes))
        union = self.sizes + len(found) - shared
        return 1 - shared / np.maximum(union, 1), 100 * shared >= percent * union

    def link(self, members: np.ndarray) -> None:
        labels = np.unique(self.labels[members])
        if len(labels) > 1:
            self.labels[np.isin(self.labels, labels)] = labels[0]


def _join_region(sets: list[np.ndarray], how: Similarity) -> list[tuple[int, int]]:
    """Links that connect whatever links inside one region connect."""
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * shared >= how.percent * (len(sets[0]) + len(sets[1]) - shared) else []
    region = _Joined(sets)
    links, pivots = [], []
    open_ = np.ones(len(sets), bool)
    reach = how.radius + 1e-9
    for q in range(len(sets)):
        open_[q] = False
        others = open_ & (region.labels != region.labels[q])
        for away in pivots:
            others &= np.abs(away - away[q]) <= reach
        # sizes of linked sets are within the similarity of each other
        others &= (100 * region.sizes >= how.percent * len(sets[q])) & (100 * len(sets[q]) >= how.percent * region.sizes)
        if not others.any():
            continue
        away, near = region.distances(sets[q], how.percent)
        near[q] = False
        new = np.flatnonzero(near & (region.labels != region.labels[q]))
        # one link to each group is enough
        _, one = np.unique(region.labels[new], return_index=True)
        links += [(q, int(x)) for x in new[one]]
        region.link(np.append(new, q))
        if len(pivots) < 8:
            pivots.append(away)
        if (region.labels == region.labels[0]).all():
            break
    return links


_MEMBER = "region long, a long, b long, n int, found binary"
_LINK = "a1 long, b1 long, a2 long, b2 long"


def _members(docs: DataFrame, wanted: DataFrame, how: Similarity) -> DataFrame:
    """Sets of the documents in ``wanted (doc_id, a, regions)``, one row for each region."""
    kinds = pa.schema(
        [("region", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("found", pa.binary())]
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 0):
                out = []
                sets = shingle_sets(batch.column(0), how.words)
                for found, name, regions in zip(sets, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    a, b = _set_hash(found)
                    if a == name:  # another row may have the same id
                        data = found.tobytes()
                        out += [(r, a, b, len(found), data) for r in regions]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], schema=kinds
                    )

    joined = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).select("text", "a", "regions")
    return joined.mapInArrow(make, _MEMBER)


def _by_group(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows of each group of a partition sorted by ``columns``."""
    held: list[pd.DataFrame] = []
    for frame in batches:
        if frame.empty:
            continue
        keys = frame[columns]
        cuts = np.flatnonzero((keys.to_numpy()[1:] != keys.to_numpy()[:-1]).any(axis=1)) + 1
        pieces = np.split(np.arange(len(frame)), cuts)
        for i, piece in enumerate(pieces):
            part = frame.iloc[piece]
            if held and (held[0][columns].iloc[0] != part[columns].iloc[0]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _small_links(members: DataFrame, how: Similarity) -> DataFrame:
    """Links of regions that fit in a task."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for group in _by_group(batches, ["region"]):
            group = group.drop_duplicates(["a", "b"])
            if len(group) < 2:
                continue
            a, b = group["a"].to_numpy(), group["b"].to_numpy()
            sets = [np.frombuffer(f, np.uint64) for f in group["found"]]
            out += [(a[x], b[x], a[y], b[y]) for x, y in _join_region(sets, how)]
            if len(out) > 10000:
                yield pd.DataFrame(out, columns=["a1", "b1", "a2", "b2"])
                out = []
        yield pd.DataFrame(out, columns=["a1", "b1", "a2", "b2"], dtype="int64")

    return members.repartition("region").sortWithinPartitions("region", "a").mapInPandas(join, _LINK)


def _against(blocks: DataFrame, members: DataFrame, how: Similarity) -> DataFrame:
    """Links between block sets, held in memory, and members, streamed, per ``(region, block, slice)``.

    A member outside all windows around the block's distances to the region's
    pivot is passed over. ``away`` is that distance; ``away1`` is given back for
    the member when the block holds the pivot itself (``block`` -1).
    """
    reach = how.radius + 1e-9

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, ready, held, away, labels, done = None, None, [], None, None, set()
        for frame in batches:
            out = []
            for r in frame.itertuples(index=False):
                if (r.region, r.block, r.slice) != now:
                    now, ready, held, done = (r.region, r.block, r.slice), None, [], set()
                found = np.frombuffer(r.found, np.uint64)
                if r.role == 0:
                    held.append((r.a, r.b, found, r.away, r.label))
                    continue
                if ready is None:
                    ready = _Joined([h[2] for h in held])
                    away = np.array([h[3] for h in held])
                    labels = [h[4] for h in held]
                if r.block >= 0 and not (np.abs(away - r.away) <= reach).any():
                    continue
                d, near = ready.distances(found, how.percent)
                if r.block < 0:
                    first = min(range(len(held)), key=lambda i: held[i][:2])
                    out.append((r.a, r.b, None, None, r.region, float(d[first])))
                for i in np.flatnonzero(near):
                    # one link between two groups is enough; a lone set is a group of its own
                    pair = (labels[i], r.label) if r.block >= 0 else (held[i][:2], (r.a, r.b))
                    if held[i][:2] != (r.a, r.b) and pair[0] != pair[1] and pair not in done:
                        done.add(pair)
                        out.append((*held[i][:2], r.a, r.b, r.region, None))
            yield pd.DataFrame(out, columns=["a1", "b1", "a2", "b2", "region", "away"]).astype(
                {c: "Int64" for c in ("a1", "b1", "a2", "b2", "region")} | {"away": "float64"}
            )

    columns = ["region", "block", "slice", "role", "a", "b", "found", "away", "label"]
    rows = blocks.withColumn("role", F.lit(0)).select(columns).unionByName(
        members.withColumn("role", F.lit(1)).select(columns)
    )
    key = ["region", "block", "slice"]
    return (
        rows.repartition(*key)
        .sortWithinPartitions(*key, "role", "a")
        .mapInPandas(join, f"{_LINK}, region long, away double")
    )


def _node(a: str, b: str):
    return F.concat(F.hex(a), F.lit("."), F.hex(b))


def _large_links(members: DataFrame, sizes: DataFrame, how: Similarity) -> DataFrame:
    """Links of regions larger than a task, in two rounds over slices."""
    members = written(members.dropDuplicates(["region", "a", "b"]), "large")
    # slices of at most half of what a task takes
    slices = sizes.select("region", F.ceil(F.col("elements") * 2 / REGION_ELEMENTS).cast("int").alias("slices"))
    cut = members.join(slices, "region").withColumn("slice", F.pmod(F.col("b"), F.col("slices")).cast("int"))
    cut = cut.withColumns({"block": F.lit(-1), "away": F.lit(0.0), "label": F.lit("")})
    local = F.row_number().over(Window.partitionBy("region", "slice").orderBy("a", "b"))
    few = cut.select("*", local.alias("_place")).where(F.col("_place") <= ROUND_PIVOTS)
    place = F.row_number().over(Window.partitionBy("region").orderBy("a", "b"))
    pivots = few.withColumn("_place", place).where(F.col("_place") <= ROUND_PIVOTS)
    pivots = pivots.withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    first = written(_against(pivots, cut, how), "round")
    links = first.where("a2 IS NOT NULL").select("a1", "b1", "a2", "b2")
    away = first.where("a2 IS NULL").select("region", F.col("a1").alias("a"), F.col("b1").alias("b"), "away")

    label = written(components(_link_members(links)), "labels").withColumnRenamed("component", "label")
    known = cut.drop("away", "label", "block").join(away, ["region", "a", "b"])
    known = known.withColumn("node", _node("a", "b")).join(label, "node", "left")
    known = written(known.withColumn("label", F.coalesce("label", "node")), "known")
    most = known.groupBy("region", "label").agg(F.count("*").alias("k")).groupBy("region")
    main = most.agg(F.max_by("label", F.struct("k", "label")).alias("main"))
    rest = known.join(main, "region").where("label <> main").drop("main")
    # blocks of neighbours by distance, so that their windows are narrow
    order = Window.partitionBy("region", "band").orderBy("away", "a", "b")
    band = F.floor(F.col("away") / how.radius * 4).cast("int")
    rest = rest.withColumn("band", band)
    filled = F.floor(F.sum("n").over(order) * 2 / REGION_ELEMENTS).cast("int")
    rest = rest.withColumn("block", F.col("band") * 100000 + filled)
    spans = rest.groupBy("region", "block").agg(F.min("away").alias("low"), F.max("away").alias("high"))
    reach = F.lit(how.radius + 1e-9)
    inside = (F.col("away") >= F.col("low") - reach) & (F.col("away") <= F.col("high") + reach)
    streamed = known.join(spans, "region").where(inside)
    held = rest.withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    second = _against(held, streamed, how).select("a1", "b1", "a2", "b2").where("a2 IS NOT NULL")
    return links.unionByName(second)


def _link_members(links: DataFrame) -> DataFrame:
    """``(node, key)``: both ends of every link, under the link's name."""
    key = F.concat(_node("a1", "b1"), F.lit("-"), _node("a2", "b2"))
    ends = F.explode(F.array(_node("a1", "b1"), _node("a2", "b2")))
    return links.select(ends.alias("node"), key.alias("key"))


def near_duplicates(
    docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each row of ``docs``.

    Words are runs of anything but white space, A-Z as a-z. A set holds the
    distinct shingles of the whole text, with fewer words the text as one. Sets are
    linked by ``how``; the component is the smallest id that links lead to. Null and
    empty texts have no shingles and are alone: their component is their own id.
    Rows that repeat an id are rows of their own; null ids name a component only if
    no other id is in it. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profiles = _profiles(docs, how)
    rows = profiles.where("part IS NULL").select("doc_id", "n", "a", "b")
    classes = written(rows.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("first_id")), "classes")

    windows = _windows(docs, how, _frequencies(profiles))
    # sets of one shingle pivot fall apart where their sizes are too far from each other for a link
    by_size = Window.partitionBy("shingle").orderBy("n", "a")
    apart = F.coalesce(100 * F.lag("n").over(by_size) < how.percent * F.col("n"), F.lit(True))
    runs = windows.withColumn("_apart", apart.cast("int"))
    runs = runs.withColumn("_run", F.sum("_apart").over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
    meet = Window.partitionBy("shingle", "_run")
    placed = runs.select("a", "n", F.min("a").over(meet).alias("region"), F.max("a").over(meet).alias("_last"))
    placed = placed.where("region < _last").select("region", "a", "n").distinct()
    placed = written(placed, "placed")
    sizes = written(placed.groupBy("region").agg(F.sum("n").alias("elements")), "sizes")
    large = sizes.where(F.col("elements") > REGION_ELEMENTS)

    def members(pairs: DataFrame) -> DataFrame:
        regions = pairs.groupBy("a").agg(F.collect_set("region").alias("regions"))
        named = classes.join(regions, "a").select(F.col("first_id").alias("doc_id"), "a", "regions")
        return _members(docs, named, how)

    if large.isEmpty():
        links = _small_links(members(placed), how)
    else:
        links = _small_links(members(placed.join(large, "region", "left_anti")), how).unionByName(
            _large_links(members(placed.join(large, "region", "left_semi")), large, how)
        )
    links = written(links, "links")

    groups = components(_link_members(links))
    named = classes.withColumn("node", _node("a", "b")).join(groups, "node")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = named.join(least, "component").select("a", "b", "component_id")
    ids = classes.join(linked, ["a", "b"], "left")
    ids = ids.select("a", "b", F.coalesce("component_id", "first_id").alias("component_id"))
    full = rows.where("n > 0").join(ids, ["a", "b"])
    out = full.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Similarity(words=4, percent=85))
