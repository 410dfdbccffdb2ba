"""Vectorised kernels over the UTF-8 bytes of Arrow string batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; the kernels need about 60 bytes of memory for each.
CHUNK = 1 << 19
U = np.uint64
_rng = np.random.default_rng(20240229)
_BASE = U(0x9E3779B97F4A7C15)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: One random number a byte value; A-Z have those of a-z.
FOLDED = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
EXACT = FOLDED.copy()
FOLDED[65:91] = FOLDED[97:123]
#: Multipliers of the first to fifth word of a shingle.
PLACES = _rng.integers(1, 2**63, 8, dtype=np.uint64) * U(2) + U(1)
#: Separators of words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2**64, of an odd base and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, U(pow(int(_BASE), -1, 2**64)))):
            grown = np.full(size, base)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the result hangs on every bit of h."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each starts (one more than there are texts). Null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    bufs = array.buffers()
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64) if bufs[1] is not None and len(array) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, name: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about size bytes together; a longer text is a slice of its own."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(name)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        to = min(to, n)
        yield batch.slice(at, to - at)
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (one more than there are texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = FOLDED) -> np.ndarray:
    """64-bit hashes of the bytes in spans that ascend and don't overlap, in pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        low = int(starts[at])
        piece = data[low : int(ends[to - 1])]
        power, inverse = powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(table[piece] * power[:-1], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * U(0xD1B54A32D192ED03))
        at = to
    return out


def shingles(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words, and the index of each text's first run; a text of fewer words has its whole sequence as one."""
    n = len(words)
    count = np.diff(first)
    runs = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    if not n:
        return np.zeros(0, np.uint64), bounds
    total = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        total[: n - k] += words[k:] * PLACES[k]
    total += U(size * int(PLACES[7]) % 2**64)
    begin = np.repeat(first[:-1] - bounds[:-1], runs) + np.arange(bounds[-1])
    out = total[begin]
    for d in np.flatnonzero((count < size) & (count > 0)):
        w = words[first[d] : first[d + 1]]
        out[bounds[d]] = U((int((w * PLACES[: len(w)]).sum(dtype=np.uint64)) + len(w) * int(PLACES[7])) % 2**64)
    return mix(out), bounds


def text_shingles(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """shingles() of the texts of an Arrow array, A-Z lower-cased."""
    data, offsets = text_bytes(array)
    starts, ends, first = word_spans(data, offsets)
    return shingles(span_hashes(data, starts, ends), first)
