"""Texts of an Arrow batch as one byte array, and hashes of their words, computed for all rows at once.

A hash of a byte range is ``sum(T[byte] * R**position) * R**-start`` modulo 2**64, so one running sum
gives the hash of every word or line; a final mix spreads the bits.
"""

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # texts are worked on in parts of about this size, so that memory stays bounded

BLOCK = 1 << 16  # entries of the power tables
SEGMENT_BYTES = 4 * SLICE_BYTES  # longer arrays are summed up part by part, so that a long text needs no more memory

_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it

#: The bytes of white space, 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def _table(base: int) -> np.ndarray:
    """``base**0 .. base**(BLOCK-1)`` modulo 2**64."""
    powers = np.full(BLOCK, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS, _BACK = _table(_R), _table(_R_INVERSE)


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums of ``values[k] * _R**k``, with the empty sum first."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    for start in range(0, len(values), BLOCK):
        part = values[start : start + BLOCK]
        scale = np.uint64(pow(_R, start, 1 << 64))
        np.cumsum(part * _POWERS[: len(part)] * scale, out=out[start + 1 : start + 1 + len(part)])
        out[start + 1 : start + 1 + len(part)] += out[start]
    return out


def _ranges(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges from running sums: what lies between, moved back to position 0."""
    far = np.array([pow(_R_INVERSE, k * BLOCK, 1 << 64) for k in range(len(sums) // BLOCK + 1)], dtype=np.uint64)
    raw = sums[ends] - sums[starts]
    raw *= _BACK[starts % BLOCK]
    raw *= far[starts // BLOCK]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offsets of each text's start with the last end; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


_held: dict = {}


def held(key, make: Callable):
    """What ``make`` gives, held by the worker for its next tasks, as the only thing that it holds."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def _give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def sliced(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, holds: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``limit`` bytes of text; a longer text stands alone.

    Unless the task ``holds`` something of its own, what the worker held for other tasks is let go first.
    """
    if not holds:
        _held.clear()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_buffers(column)
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    _give_back()


class Hasher:
    """Hashes of byte ranges of one array.

    A long array has no sums of its own: the ranges are taken segment by segment of their starts, and only what the
    ranges of one segment cover is summed up at a time.
    """

    def __init__(self, data: np.ndarray):
        self._data = data
        self._sums = _sums(_TABLE[data]) if len(data) <= SEGMENT_BYTES else None

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._sums is not None:
            return _ranges(self._sums, starts, ends)
        out = np.zeros(len(starts), dtype=np.uint64)
        segment = starts // SEGMENT_BYTES
        order = None if (segment[1:] >= segment[:-1]).all() else np.argsort(segment, kind="stable")
        in_order = segment if order is None else segment[order]
        edges = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1])) if len(starts) else []
        for a, b in zip(edges, np.append(edges, len(starts))[1:]):
            own = slice(a, b) if order is None else order[a:b]
            low, high = int(starts[own].min()), int(ends[own].max())
            out[own] = _ranges(_sums(_TABLE[self._data[low:high]]), starts[own] - low, ends[own] - low)
        return out


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values, by running sums as above."""
    return _ranges(_sums(mix(values + np.uint64(1))), starts, ends)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends where its text ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, stops = inside.copy(), inside.copy()
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    stops[:-1] &= ~inside[1:]
    stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it (with the last total)."""
    starts, ends = spans(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and for each text the number of words before it."""
    lower = LOWER[data]
    starts, ends, firsts = word_spans(lower, offsets)
    return Hasher(lower).of(starts, ends), firsts


def shingles(words: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words, and for each text the number of runs before it.

    A text of fewer words has its whole sequence as its one run; a text without words has none.
    """
    counts = np.diff(firsts)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    before = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(int(before[-1]), dtype=np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            rolled += mix(words[k : len(words) - width + 1 + k] + np.uint64(k + 1)) * np.uint64((2 * k + 3) * _R % (1 << 64) | 1)
        rolled = mix(rolled)
        text = np.repeat(np.arange(len(counts)), runs)
        at = firsts[text] + np.arange(len(out)) - before[text]
        whole = counts[text] >= width
        out[whole] = rolled[at[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        total = int(counts[i]) * 0xD6E8FEB86659FD93
        for k, w in enumerate(words[firsts[i] : firsts[i + 1]].tolist()):
            total += int(w) * ((2 * k + 5) * _R % (1 << 64) | 1)
        out[before[i]] = mix(np.array([total % (1 << 64)], dtype=np.uint64))[0]
    return out, before


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes in the signed type that Spark has."""
    return x.view(np.int64)
