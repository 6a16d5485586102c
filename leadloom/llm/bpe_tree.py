"""Byte-pair encoding and decoding, with unsplit text encoded in halves that are put together again.

A tokenizer splits a text into pieces and merges pairs inside each of them. Pieces
never hold white space, so a text falls apart at its ASCII white space; what lies
between is encoded by the tokenizers library, once for each distinct string that a
task remembers.

Text that is not split, however long, is cut into halves down to ``LEAF`` symbols.
The leaves are encoded on their own, in parallel, and joined pair by pair up the
tree: a window of tokens around the join is encoded again, and grows until its
first token is the left side's token at that place and its last one the right
side's, or it holds a whole side. A sequence of tokens is the encoding of its text
if every two neighbours are the encoding of theirs, so the result is exact.

Texts of more than ``PART_BYTES`` bytes are cut into parts that different tasks
encode, and their tokens are joined in the same way.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import sys
import types
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import read
from leadloom.sources.scratch import written

# symbols of a leaf; shorter unsplit text is encoded in one go
LEAF = 4096
# bytes of a text, or of a part of one, that one task encodes
PART_BYTES = 64 << 10
# tokens on each side of a join that are encoded again at first
WINDOW = 4
# strings that a worker remembers at least; those not used among so many others are forgotten
_MEMORY = 200_000
# what a pattern of words, digits and all else makes of printable ASCII and the letters of Latin-1, in
# normal form and with simple lower case, is plain to see; special tokens apart
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN_WORD = re.compile(f"[!-~{_LATIN}]+")
_PLAIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")


class Joiner:
    """Encodes one piece of unsplit text, given as symbols of the model, by halves."""

    def __init__(self, spec: dict, leaf: int = LEAF, window: int = WINDOW):
        self.leaf, self.window = leaf, window
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self._spec = {**spec, "normalizer": None, "pre_tokenizer": None, "added_tokens": []}

    @cached_property
    def _token(self) -> dict[int, str]:
        return {i: t for t, i in self._spec["model"]["vocab"].items()}

    @cached_property
    def _closed(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(json.dumps(self._spec))

    @cached_property
    def _open(self):
        """The model without the mark of a piece's end, for what does not end a piece."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(json.dumps({**self._spec, "model": {**self._spec["model"], "end_of_word_suffix": None}}))

    def _plain(self, symbols: str, ends: bool) -> list[int]:
        return (self._closed if ends else self._open).encode(symbols, add_special_tokens=False).ids if symbols else []

    def _symbols(self, ids: list[int], ends: bool) -> str:
        text = "".join(self._token[i] for i in ids)
        return text[: len(text) - len(self.suffix)] if ends and self.suffix else text

    def leaves(self, symbols: str) -> list[str]:
        """Halves of halves, until none has more than ``leaf`` symbols."""
        if len(symbols) <= self.leaf:
            return [symbols]
        half = len(symbols) // 2
        return self.leaves(symbols[:half]) + self.leaves(symbols[half:])

    def encode_leaves(self, leaves: list[str], ends: bool) -> list[list[int]]:
        return [self._plain(s, ends and i == len(leaves) - 1) for i, s in enumerate(leaves)]

    def joined(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """Tokens of both sides' text; ``ends`` says that the right side, which has text then, ends the piece."""
        if not left or not right:
            return left or right
        size = self.window
        while True:
            a, b = max(len(left) - size, 0), min(size, len(right))
            whole = b == len(right)
            inner = self._symbols(left[a:], False) + self._symbols(right[:b], ends and whole)
            made = self._plain(inner, ends and whole)
            if (a == 0 or made[0] == left[a]) and (whole or made[-1] == right[b - 1]):
                return left[:a] + made + right[b:]
            size *= 2

    def tree(self, sides: list[list[int]], ends: bool) -> list[int]:
        """Neighbours joined pair by pair until one is left."""
        while len(sides) > 1:
            last = len(sides) - 2
            pairs = [self.joined(sides[i], sides[i + 1], ends and i >= last) for i in range(0, len(sides) - 1, 2)]
            sides = pairs + sides[len(pairs) * 2 :]
        return sides[0] if sides else []

    def encode(self, symbols: str) -> list[int]:
        return self.tree(self.encode_leaves(self.leaves(symbols), True), True)


class Memory:
    """A dictionary of bounded size: when the newer half is full, the older one is forgotten."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys) -> list:
        """Distinct keys that are not known; all others are in the newer half afterwards."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old, out = self.new, self.old, []
        for key in set(keys):
            if key not in new:
                if key in old:
                    new[key] = old[key]
                else:
                    out.append(key)
        return out


class Encoder:
    """Encodes texts as the library does, by the strings between white space.

    What is remembered of a string are its tokens, their numbers and their names.
    """

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _check(spec)
        spec["truncation"] = spec["padding"] = None
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.join = Joiner(spec, leaf, window)
        self.leaf = leaf
        self._normal, self._split = self.whole.normalizer, self.whole.pre_tokenizer
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._names = {i: t for t, i in self.whole.get_vocab(True).items()}
        self._known, self._pieces = Memory(_MEMORY), Memory(_MEMORY)
        # the pattern that the plain pieces follow
        self._plain = json.dumps(spec["pre_tokenizer"]).find(json.dumps(_PATTERN)[1:-1]) >= 0 and _lowers(spec)
        # the symbols of each letter beyond ASCII, which is what the model sees
        letters = [chr(c) for c in range(0xC0, 0x100) if self._plain and _PLAIN_WORD.fullmatch(chr(c))]
        self._symbols = {ord(c): "".join(part for part, _ in self._split.pre_tokenize_str(c)) for c in letters}

    def special_parts(self, text: str) -> list[str]:
        """The text cut before and after the special tokens that stand in it."""
        parts, at = [], 0
        while self._special:
            found = [(place, -len(s), s) for s in self._special if (place := text.find(s, at)) >= 0]
            if not found:
                break
            place, _, name = min(found)
            parts += [text[at:place], name]
            at = place + len(name)
        return [*parts, text[at:]]

    def pieces(self, text: str) -> Iterator[tuple[int | None, str]]:
        """Special tokens by their id, and the symbols of every piece of unsplit text, in order."""
        for i, part in enumerate(self.special_parts(text)):
            if i % 2:
                yield self._special[part], ""
            elif part:
                for symbols, _ in self._split.pre_tokenize_str(self._normal.normalize_str(part)):
                    yield None, symbols

    def _long(self, text: str) -> list[int]:
        """A string without white space, by its pieces."""
        out: list[int] = []
        for special, symbols in self.pieces(text):
            out += [special] if special is not None else self.join.encode(symbols)
        return out

    def _entry(self, ids) -> tuple[tuple[int, ...], str, str]:
        names = self._names
        # tuples of numbers and texts cost the garbage collector nothing
        return tuple(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids])

    def _learn(self, words: list[bytes]) -> None:
        """Looks up strings of at most ``leaf`` bytes that are not known yet."""
        known, plain, split, odd, odd_texts = self._known.new, [], [], [], []
        for word in words:
            text = word.decode()
            if self._plain and "<|" not in text and _PLAIN_WORD.fullmatch(text):
                plain.append(word)
                split.append(_PLAIN_PIECE.findall(text.lower()))
            else:
                odd.append(word)
                odd_texts.append(text)
        for at in range(0, len(odd), 10_000):
            found = self.whole.encode_batch_fast(odd_texts[at : at + 10_000], add_special_tokens=False)
            for word, made in zip(odd[at : at + 10_000], found):
                known[word] = self._entry(made.ids)
        new = self._pieces.missing(itertools.chain.from_iterable(split))
        pieces, symbols = self._pieces.new, self._symbols
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            found = self.join._closed.encode_batch_fast([p.translate(symbols) for p in some], add_special_tokens=False)
            for piece, made in zip(some, found):
                pieces[piece] = tuple(made.ids)
        for word, own in zip(plain, split):
            ids = pieces[own[0]] if len(own) == 1 else tuple(itertools.chain.from_iterable([pieces[p] for p in own]))
            known[word] = self._entry(ids)

    def encode(self, texts: list[bytes]) -> list[list[tuple[tuple[int, ...], str, str]]]:
        """For each text the tokens of each of its strings between ASCII white space, with numbers and names."""
        split = [t.split() for t in texts]
        new = self._known.missing(itertools.chain.from_iterable(split))
        self._learn([w for w in new if len(w) <= self.leaf])
        known = self._known.new
        long = {w: self._entry(self._long(w.decode())) for w in new if len(w) > self.leaf}
        if long:
            return [[long[w] if w in long else known[w] for w in words] for words in split]
        return [[known[w] for w in words] for words in split]


# the pattern of words, digits and all else that ``_PLAIN_PIECE`` follows on printable ASCII in lower case
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _lowers(spec: dict) -> bool:
    return '"Lowercase"' in json.dumps(spec["normalizer"])


def _check(spec: dict) -> None:
    """Raises for tokenizers whose texts do not fall apart at white space, or whose merges are not in order."""
    model = spec["model"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
        raise ValueError("a plain byte-pair model is needed")
    if spec["pre_tokenizer"] is None or "\\s" not in json.dumps(spec["pre_tokenizer"]):
        raise ValueError("the tokenizer must split at white space")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("special tokens must stand for themselves")
    made: set[str] = set()
    products = {a + b for a, b in map(_pair, model["merges"])}
    for a, b in map(_pair, model["merges"]):
        if (a in products and a not in made) or (b in products and b not in made):
            raise ValueError("a merge comes before the merge that makes one of its sides")
        made.add(a + b)


def _pair(merge) -> tuple[str, str]:
    return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)


class Decoder:
    """Texts of token ids, special tokens included, as the library puts them together."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        size = self._whole.get_vocab_size()
        self._names = [self._whole.id_to_token(i) for i in range(size)]
        self._numbers = [str(i) for i in range(size)]
        # a tokenizer without a decoder joins the tokens' names with spaces
        self.joins = self._whole.decoder is None

    def text(self, ids: list[int]) -> str:
        if self.joins:
            names = self._names
            return " ".join([names[i] for i in ids])
        return self._whole.decode(ids, skip_special_tokens=False)

    def numbers(self, ids: list[int]) -> str:
        numbers = self._numbers
        return " ".join([numbers[i] for i in ids])


def _remembered(key: tuple, make: Callable):
    """What ``make`` gives, once for each Python process: a worker keeps it from task to task.

    Functions travel to workers by value, so a global of this module would not outlive a task.
    """
    kept = sys.modules.setdefault("leadloom_remembered", types.ModuleType("leadloom_remembered")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def encoder(path: str, leaf: int = LEAF, window: int = WINDOW) -> Encoder:
    return _remembered(("encoder", path, leaf, window), lambda: Encoder(path, leaf, window))


def decoder(path: str) -> Decoder:
    return _remembered(("decoder", path), lambda: Decoder(path))


def _flat(words: list[list[int]]) -> list[int]:
    return list(itertools.chain.from_iterable(words))


def _batches(make: Callable, names: list[str], rows: int = 500) -> Callable:
    """``make`` for slices of batches, so that tokens of few texts are in memory at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield pa.RecordBatch.from_arrays(make(batch.slice(at, rows)), names)

    return run


_DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_WHOLE = "n_tokens long, ids array<int>"


def _digests(count: int, numbers: str, text: str) -> list:
    return [count, hashlib.sha256(numbers.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]


def _finished(ids: list[int], path: str, digests: bool) -> list:
    if not digests:
        return [len(ids), ids]
    own = decoder(path)
    return _digests(len(ids), own.numbers(ids), own.text(ids))


def _finished_words(words: list[tuple[tuple[int, ...], str, str]], path: str, digests: bool) -> list:
    """As ``_finished``, from what is remembered of the strings."""
    if not digests or not decoder(path).joins:
        return _finished(_flat([w[0] for w in words]), path, digests)
    some = [w for w in words if w[0]]
    return _digests(sum(len(w[0]) for w in some), " ".join([w[1] for w in some]), " ".join([w[2] for w in some]))


def _arrays(out: list[list], digests: bool) -> list[pa.Array]:
    kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.int64(), pa.list_(pa.int32())]
    return [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]


# kinds of parts: strings between white space; whole pieces; a piece of unsplit text, and the last of one
TEXT, PIECES, INNER, LAST = 0, 1, 2, 3


def parts_of(text: bytes, own: Encoder, size: int) -> Iterator[tuple[int, str]]:
    """A long text as ``(kind, data)``, in order, each of about ``size`` bytes at most.

    Parts end at ASCII white space. A string without any that is longer is taken
    apart into its pieces; a piece that is longer still is cut into halves.
    """
    plain: list[bytes] = []
    held = 0
    for word in text.split():
        if held and held + len(word) > size:
            yield TEXT, b" ".join(plain).decode()
            plain, held = [], 0
        if len(word) <= size:
            plain.append(word)
            held += len(word) + 1
            continue
        whole: list[str] = []
        count = 0
        for special, symbols in own.pieces(word.decode()):
            # a special token has no symbols; its id is a piece of its own
            data = f"\t{special}" if special is not None else symbols
            if whole and (count + len(data) > size or len(data) > size):
                yield PIECES, " ".join(whole)
                whole, count = [], 0
            if len(data) <= size:
                whole.append(data)
                count += len(data) + 1
                continue
            halves = [data]
            while len(halves[0]) > size:
                halves = [h for s in halves for h in (s[: len(s) // 2], s[len(s) // 2 :])]
            for i, half in enumerate(halves):
                yield (LAST if i == len(halves) - 1 else INNER), half
        if whole:
            yield PIECES, " ".join(whole)
    if plain:
        yield TEXT, b" ".join(plain).decode()


def _encoded_part(kind: int, data: str, own: Encoder) -> list[int]:
    if kind == TEXT:
        return _flat([w[0] for w in own.encode([data.encode()])[0]])
    if kind == PIECES:
        out: list[int] = []
        for piece in data.split(" "):
            out += [int(piece[1:])] if piece.startswith("\t") else own.join.encode(piece)
        return out
    return own.join.tree(own.join.encode_leaves(own.join.leaves(data), kind == LAST), kind == LAST)


def joined_parts(parts: list[tuple[int, list[int]]], own: Encoder) -> list[int]:
    """Tokens of a text from those of its parts, in order: pieces up the tree, all else one after the other."""
    out: list[int] = []
    sides: list[list[int]] = []
    for kind, ids in parts:
        if kind in (TEXT, PIECES):
            out += ids
            continue
        sides.append(ids)
        if kind == LAST:
            out += own.join.tree(sides, True)
            sides = []
    return out


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
    part_bytes: int = PART_BYTES,
    leaf: int = LEAF,
    window: int = WINDOW,
) -> DataFrame:
    """``(id, n_tokens, ids)``, one row for each row of ``docs``, by the tokenizer in the file ``path``.

    The tokens are those of the library without added special tokens, truncation
    and padding. Null and empty texts have none. With ``digests`` the ids give way
    to ``ids_sha256``, of the decimal ids joined by spaces, and ``decoded_sha256``,
    of the text that they decode to. Ids of ``docs`` are kept as they are, of any
    type, null or repeated; other columns play no part. No rows give no rows. The
    file must be readable in every task at the same path.
    """
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    added = T._parse_datatype_string(_DIGESTS if digests else _WHOLE).fields
    result = T.StructType([id_field, *added])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))

    def short(batch: pa.RecordBatch) -> list[pa.Array]:
        found = encoder(path, leaf, window).encode(batch.column(1).to_pylist())
        return [batch.column(0), *_arrays([_finished_words(words, path, digests) for words in found], digests)]

    whole = rows.where(F.octet_length("text") <= part_bytes).mapInArrow(_batches(short, result.names), result)

    cut = T.StructType([id_field, *T._parse_datatype_string("key string, place int, kind int, data string").fields])

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = parts_of(batch.column(2)[i].as_py(), encoder(path, leaf, window), part_bytes)
                # a text of nothing but white space has one empty part
                found = itertools.chain(found, [(TEXT, "")])
                for place, (kind, data) in enumerate(found):
                    one = [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([place], pa.int32())]
                    yield pa.RecordBatch.from_arrays([*one, pa.array([kind], pa.int32()), pa.array([data])], cut.names)

    # rows of long texts are told apart by their own number, since ids may repeat; it is fixed by writing the parts
    key = F.monotonically_increasing_id().cast("string").alias("key")
    long = rows.where(F.octet_length("text") > part_bytes).select("id", key, "text").mapInArrow(take_apart, cut)
    parts = written(long, "parts").repartition("key", "place")
    coded = T.StructType([id_field, *T._parse_datatype_string("key string, place int, kind int, ids binary").fields])

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _encoded_part(batch.column(3)[i].as_py(), batch.column(4)[i].as_py(), encoder(path, leaf, window))
                made = pa.array([np.array(ids, np.int32).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns[:4]), made], coded.names)

    pieces = parts.mapInArrow(encode_parts, coded)
    # a group is one text's tokens
    texts = pieces.groupBy("key").agg(
        F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("place", "kind", "ids"))).alias("parts")
    )

    def put_together(batch: pa.RecordBatch) -> list[pa.Array]:
        own, out = encoder(path, leaf, window), []
        for i in range(batch.num_rows):
            parts = [(p["kind"], np.frombuffer(p["ids"], np.int32).tolist()) for p in batch.column(1)[i].as_py()]
            out.append(_finished(joined_parts(parts, own), path, digests))
        return [batch.column(0), *_arrays(out, digests)]

    return whole.unionByName(texts.select("id", "parts").mapInArrow(_batches(put_together, result.names, 20), result))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its token ids with special tokens kept; null ids give null."""
    names = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{ids_col}`").alias("__ids"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        own = decoder(path)
        texts = [None if ids is None else own.text(ids) for ids in batch.column(len(names)).to_pylist()]
        return [*batch.columns[: len(names)], pa.array(texts, pa.string())]

    return rows.mapInArrow(_batches(make, schema.names), schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    encoded = encode(read(spark, sf_dir, "documents"), default_path(), digests=True)
    return encoded.withColumnRenamed("id", "doc_id")
