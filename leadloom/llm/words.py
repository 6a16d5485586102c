"""Words and shingles of whole Arrow columns as 64-bit hashes, without a Python object per word.

Works on the UTF-8 bytes. A-Z count as a-z; bytes of 0x80 and above belong to
words, so letters of any script stay whole. Memory is bounded by the chunk, not
by the longest text. Two different words get the same hash with a probability of
about 2**-64; that is what "equal" means wherever these hashes are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# bytes hashed at a time; small enough to stay in a core's cache
_CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xFF51AFD7ED558CCD

# bytes that end a word: white space only, or all ASCII but letters and digits
SPACED, ALNUM = "spaced", "alnum"


def _tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    every = np.arange(256)
    lower = np.where((every >= 0x41) & (every <= 0x5A), every + 32, every).astype(np.uint64)
    if kind == SPACED:
        inside = ~((every == 0x20) | ((every >= 0x09) & (every <= 0x0D)))
    else:
        digit = (every >= 0x30) & (every <= 0x39)
        inside = digit | ((lower >= 0x61) & (lower <= 0x7A)) | (every >= 0x80)
    return lower + 1, inside


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of unsigned 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each text begins and the last ends. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, bounds: np.ndarray, kind: str = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word and the byte after its last, in order."""
    inside = _tables(kind)[1][data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Polynomial hashes of spans: differences of prefix sums, brought to one power."""
    out = np.empty(len(starts), np.uint64)
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    size = int(min(len(data), _CHUNK)) + 1
    up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(_BASE))]))
    down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]))
    at = 0
    while at < len(starts):
        begin = starts[at]
        to = int(np.searchsorted(ends, begin + _CHUNK, "right"))
        if to <= at:  # a word longer than a chunk
            part = data[begin : ends[at]].tobytes().lower()
            out[at] = np.uint64(hash_bytes(part))
            at += 1
            continue
        part = values[data[begin : ends[to - 1]]]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * up[: len(part)])])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = to
    return mixed(out)


def hash_bytes(text: bytes) -> int:
    """The unmixed hash of one lower-cased word, the same as in a column."""
    total, power = 0, 1
    for byte in text:
        total = (total + (byte + 1) * power) & 0xFFFFFFFFFFFFFFFF
        power = (power * _BASE) & 0xFFFFFFFFFFFFFFFF
    return (total + len(text)) & 0xFFFFFFFFFFFFFFFF


def words(column: pa.Array, kind: str = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text where its words begin (one more entry at the end)."""
    data, bounds = text_buffers(column)
    starts, ends = word_spans(data, bounds, kind)
    return _span_hashes(data, starts, ends, _tables(kind)[0]), np.searchsorted(starts, bounds)


def word_hash(word: str) -> int:
    """Hash of one word (lower-cased), signed as Spark stores it."""
    return int(mixed(np.array([hash_bytes(word.encode().lower())], np.uint64)).view(np.int64)[0])


def rolled(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words; runs across texts are included."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    n = len(hashes) - length + 1
    total = np.full(n, np.uint64(length), np.uint64)
    for i in range(length):
        total = mixed(total * np.uint64(_BASE) + hashes[i : i + n])
    return total


def shingle_sets(column: pa.Array, length: int) -> list[np.ndarray]:
    """Per text its distinct runs of ``length`` words, sorted; with fewer words, the whole text as one."""
    hashes, at = words(column)
    runs = rolled(hashes, length)
    found = []
    for i in range(len(at) - 1):
        count = at[i + 1] - at[i]
        if count >= length:
            found.append(np.unique(runs[at[i] : at[i + 1] - length + 1]))
        else:
            found.append(rolled(hashes[at[i] : at[i + 1]], int(count)) if count else runs[:0])
    return found
