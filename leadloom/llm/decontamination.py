"""Benchmark passages in training text, found with a positional inverted index.

The index is kept in blocks of documents, as search engines keep segments: per
block a sorted list of terms, and for each the ascending positions of its
tokens. It is written as a table, so that any number of item sets can be looked
up in it. Building it moves no row between tasks, and neither does a lookup:
every window of benchmark words is looked up in every block. It starts with the
term that is rarest in the block and intersects the others' lists, shifted by
their offsets, from rare to frequent.

Windows reach the tasks in groups of bounded size, one pass over the index for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.words import ALNUM, rolled, text_buffers, words
from leadloom.sources.scratch import written

WINDOW = 10
# text bytes of an index block (a longer text is a block of its own)
BLOCK_BYTES = 8 << 20
# words of items whose windows are looked up in one pass
GROUP_WORDS = 1 << 18
# the terms of all items as a bit set of fixed size; a false hit only makes the index larger
_FILTER_BITS = 20

_INDEX = (
    "block long, doc_ids array<long>, firsts array<int>, terms array<long>, term_firsts array<int>, positions binary"
)


def _index_block(ids: list, column: pa.Array, block: int, wanted: np.ndarray | None) -> dict:
    hashes, at = words(column, ALNUM)
    place = np.arange(len(hashes), dtype=np.int32)
    if wanted is not None:
        known = wanted[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        hashes, place = hashes[known], place[known]
    order = np.argsort(hashes, kind="stable")
    terms, firsts = np.unique(hashes[order], return_index=True)
    return {
        "block": block,
        "doc_ids": ids,
        "firsts": at.astype(np.int32),
        "terms": terms.view(np.int64),
        "term_firsts": np.append(firsts, len(hashes)).astype(np.int32),
        "positions": place[order].tobytes(),
    }


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wanted: bytes | None = None
) -> DataFrame:
    """Positional index of all words of ``docs``, one row for each block of documents.

    ``wanted``, a bit set over the first bits of term hashes, leaves out tokens that
    no lookup will ask for. Null and empty texts have no tokens but stay listed.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bits = None if wanted is None else np.unpackbits(np.frombuffer(wanted, np.uint8)).astype(bool)
        number = TaskContext.get().partitionId() << 32
        types = pa.schema(
            [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int32())),
             ("terms", pa.list_(pa.int64())), ("term_firsts", pa.list_(pa.int32())), ("positions", pa.binary())]
        )
        for batch in batches:
            bounds = text_buffers(batch.column(1))[1]
            low = 0
            while low < batch.num_rows:
                high = max(int(np.searchsorted(bounds, bounds[low] + BLOCK_BYTES, "right")) - 1, low + 1)
                part = batch.slice(low, high - low)
                row = _index_block(part.column(0).to_pylist(), part.column(1), number, bits)
                yield pa.RecordBatch.from_pylist([row], schema=types)
                number, low = number + 1, high

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(blocks, _INDEX), "index")


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, tokens)``: words of every item as hashes; a null id becomes the text ``null``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, at = words(batch.column(1), ALNUM)
            tokens = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), tokens], ["item_id", "tokens"])

    id = F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item_id")
    rows = items.select(id, F.col(text_col).alias("text"))
    return written(rows.mapInArrow(split, "item_id string, tokens array<long>").where("size(tokens) > 0"), "items")


def _term_filter(items: DataFrame) -> bytes:
    """Bit set of the items' terms; at most ``2**_FILTER_BITS`` numbers come to the driver."""
    top = F.shiftrightunsigned("term", 64 - _FILTER_BITS).alias("top")
    bits = np.zeros(1 << _FILTER_BITS, np.uint8)
    bits[[r["top"] for r in items.select(F.explode("tokens").alias("term")).select(top).distinct().collect()]] = 1
    return np.packbits(bits).tobytes()


def _windows(rows: list, length: int) -> dict:
    """Distinct windows of some items, and which items have them."""
    found: dict[int, int] = {}
    tokens, sizes, owners = [], [], []
    names = sorted({r["item_id"] for r in rows})
    number = {name: i for i, name in enumerate(names)}
    for r in rows:
        hashes = np.array(r["tokens"], np.int64).view(np.uint64)
        size = min(length, len(hashes))
        for k, key in enumerate(rolled(hashes, size).tolist()):
            if key not in found:
                found[key] = len(tokens)
                tokens.append(np.pad(hashes[k : k + size], (0, length - size)))
                sizes.append(size)
                owners.append(set())
            owners[found[key]].add(number[r["item_id"]])
    return {
        "tokens": np.array(tokens, np.uint64).reshape(-1, length),
        "sizes": np.array(sizes, np.int64),
        "owners": [np.array(sorted(o), np.int64) for o in owners],
        "names": names,
    }


def _occurrences(place: list[np.ndarray], size: int, firsts: np.ndarray, slop: int) -> np.ndarray:
    """Positions of the words of each occurrence, one row each, given the lists of the window's words."""
    order = sorted(range(size), key=lambda k: len(place[k]))
    rare = order[0]
    start = place[rare].astype(np.int64) - rare
    spots = {rare: place[rare].astype(np.int64)}
    for k in order[1:]:
        listed = place[k]
        aim = start + k
        at = np.searchsorted(listed, aim - slop)
        safe = np.minimum(at, len(listed) - 1)
        near = listed[safe].astype(np.int64)
        if slop:  # the nearest of those within reach
            for step in range(1, 2 * slop + 1):
                other = listed[np.minimum(safe + step, len(listed) - 1)].astype(np.int64)
                near = np.where(np.abs(other - aim) < np.abs(near - aim), other, near)
        good = (at < len(listed)) & (np.abs(near - aim) <= slop)
        start = start[good]
        if not len(start):
            return np.zeros((0, size), np.int64)
        spots = {j: s[good] for j, s in spots.items()} | {k: near[good]}
    found = np.stack([spots[k] for k in range(size)], axis=1)
    # all in one document
    inside = np.searchsorted(firsts, found.min(axis=1), "right") == np.searchsorted(firsts, found.max(axis=1), "right")
    return found[inside]


def _look_up(block: dict, windows: dict, slop: int) -> pd.DataFrame:
    """Hit words and items for every document of one index block."""
    firsts = np.asarray(block["firsts"], np.int64)
    terms = np.asarray(block["terms"], np.int64).view(np.uint64)
    term_firsts = np.asarray(block["term_firsts"], np.int64)
    positions = np.frombuffer(block["positions"], np.int32)
    docs = len(firsts) - 1
    hit = np.zeros(firsts[-1], bool)
    pairs = []
    if len(terms) and len(windows["tokens"]):
        at = np.minimum(np.searchsorted(terms, windows["tokens"]), len(terms) - 1)
        used = np.arange(windows["tokens"].shape[1]) < windows["sizes"][:, None]
        there = ((terms[at] == windows["tokens"]) | ~used).all(axis=1)
        for w in np.flatnonzero(there):
            size = int(windows["sizes"][w])
            lists = [positions[term_firsts[t] : term_firsts[t + 1]] for t in at[w, :size]]
            found = _occurrences(lists, size, firsts, slop)
            if len(found):
                hit[found.ravel()] = True
                doc = np.unique(np.searchsorted(firsts, found[:, 0], "right") - 1)
                owners = windows["owners"][w]
                pairs.append(np.stack([np.repeat(doc, len(owners)), np.tile(owners, len(doc))], axis=1))
    spots = np.flatnonzero(hit)
    bounds = np.searchsorted(spots, firsts)
    items: list[list[str]] = [[] for _ in range(docs)]
    if pairs:
        for doc, owner in np.unique(np.concatenate(pairs), axis=0):
            items[doc].append(windows["names"][owner])
    return pd.DataFrame(
        {
            "block": block["block"],
            "ordinal": np.arange(docs),
            "doc_id": pd.array(list(block["doc_ids"]), dtype="Int64"),
            "n_words": np.diff(firsts),
            "hits": [(spots[a:b] - firsts[i]).astype(np.int32) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))],
            "items": items,
        }
    )


_FOUND = "block long, ordinal long, doc_id long, n_words long, hits array<int>, items array<string>"


def find_items(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``(doc_id, n_words, hits, items)`` for every indexed document.

    ``hits`` are the places of the words inside any occurrence of a window of
    ``window`` consecutive item words (an item of fewer words is one window),
    ``items`` the ids of the items with such windows, ascending. With ``slop`` a
    word may be that many places off (proximity); 0 means exact phrases. Documents
    without words or matches have empty lists, and so have all if there are no items.
    """
    spark = index.sparkSession
    total = items.agg(F.sum(F.size("tokens"))).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP_WORDS))
    passes = []
    for g in range(groups):
        mine = items if groups == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g)
        shared = spark.sparkContext.broadcast(_windows(mine.collect(), window))

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {n: batch.column(n)[i] for n in batch.schema.names}
                    block = {
                        "block": row["block"].as_py(),
                        "doc_ids": row["doc_ids"].as_py(),
                        "positions": row["positions"].as_py(),
                        **{n: row[n].values.to_numpy() for n in ("firsts", "terms", "term_firsts")},
                    }
                    found = _look_up(block, shared.value, slop)
                    yield pa.RecordBatch.from_pandas(found, schema=_found_types(), preserve_index=False)

        passes.append(index.mapInArrow(look, _FOUND))
    if groups == 1:
        return passes[0].select("doc_id", "n_words", "hits", "items")
    together = passes[0]
    for more in passes[1:]:
        together = together.unionByName(more)
    merged = together.groupBy("block", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.select("doc_id", "n_words", "hits", "items")


def _found_types() -> pa.Schema:
    return pa.schema(
        [("block", pa.int64()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
         ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, hits, items)`` of every row of ``docs``, against all ``items``."""
    tokens = item_words(items)
    index = build_index(docs, id_col, text_col, _term_filter(tokens))
    return find_items(index, tokens, window, slop)


def query(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return report(decontaminate(docs, items))


def report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_SPLIT = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SPLIT} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, w[i:i + {WINDOW - 1}] AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM windows),
places AS (
  SELECT r, i, n, w[i:i + n - 1] AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
found AS MATERIALIZED (SELECT r, i, n, item_id FROM places JOIN windows USING (words)),
hits AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""
