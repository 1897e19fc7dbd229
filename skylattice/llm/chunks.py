"""Text of many documents as one byte array: words, lines and rolling hashes in numpy.

Operators see Arrow batches inside Spark tasks. A batch is cut into chunks of a
few MB, so that memory does not depend on the batch; a chunk holds whole
documents. Null texts are empty. Hashes are 64-bit and of sequences, so equal
sequences meet whatever document they are in.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

CHUNK_BYTES = 2 << 20
U64 = np.uint64

#: ``[^\x20\x09-\x0D]+`` are words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the offsets of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[
        filled.offset : filled.offset + len(filled) + 1
    ]
    raw = filled.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first : offsets[-1]], offsets - first


def chunked(batch: pa.RecordBatch, text_col: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text, one row at least."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text_col))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(start, end - start)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Spans longer than this are hashed one at a time.
LONG_SPAN = 256
GOLDEN = U64(0x9E3779B97F4A7C15)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to its end.

    Every eight bytes go through ``mix``, so that no two texts are equal for all
    seeds, as they may be under a polynomial modulo a power of two. Long spans
    are hashed by XXH3.
    """
    size = ends - starts
    out = mix(size.astype(U64) * GOLDEN + U64(seed))
    if len(starts) == 0:
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    short = np.flatnonzero(size <= LONG_SPAN)
    at = 0
    while len(short):
        left = size[short] - at
        short, left = short[left > 0], left[left > 0]
        if len(short) == 0:
            break
        value = eight[starts[short] + at]
        cut = np.minimum(left, 8).astype(U64) * U64(8)
        value = value & (~U64(0) >> (U64(64) - cut))
        out[short] = mix((out[short] ^ value) * GOLDEN + U64(at + 1))
        at += 8
    long = np.flatnonzero(size > LONG_SPAN)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        for i in long.tolist():
            out[i] = xxhash.xxh3_64_intdigest(view[starts[i] : ends[i]], seed)
    return out


def run_hashes(values: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` values from each position in ``first``.

    Hashes of two neighbouring runs are mixed into that of the run twice as long;
    a size that is no power of two is covered by two runs that overlap.
    """
    level = mix(values + GOLDEN)
    reach = 1
    while 2 * reach <= size:
        level = mix(level[:-reach] * GOLDEN + mix(level[reach:] + U64(reach)))
        reach *= 2
    if reach == size:
        return level[first]
    return mix(level[first] * GOLDEN + mix(level[first + size - reach] + U64(size)))


class Rolling:
    """Hashes of short ranges of a value sequence; the base is odd, so it has an inverse mod 2**64.

    Some sequences of 1024 values and more are equal under every base, so this is
    for ranges well below that, or where values are compared afterwards.
    """

    def __init__(self, base: int):
        self.base = base | 1
        self._up = self._down = np.ones(1, U64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n:
            size = max(n, min(2 * len(self._up), 1 << 21))
            inverse = pow(self.base, -1, 1 << 64)
            for name, value in (("_up", self.base), ("_down", inverse)):
                steps = np.full(size, value, U64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Running sums, to be given to ``ranges``."""
        n = len(values)
        self._powers(n + 1)
        out = np.zeros(n + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * self._up[:n], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the values from each start to its end."""
        h = (sums[ends] - sums[starts]) * self._down[starts]
        return mix(h + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


BYTES = Rolling(0x5851F42D4C957F2D)


def counts_between(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of ``mask`` are set in each range."""
    run = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=run[1:])
    return run[ends] - run[starts]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that stay in one document, and their document."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the words."""
    return runs(~SPACE[data], offsets)


def windows(doc: np.ndarray, size: int) -> np.ndarray:
    """First positions of the windows of ``size`` consecutive items of one document."""
    n = len(doc) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(doc[:n] == doc[size - 1 :])


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in any of the ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n], dtype=np.int32) > 0


def seen_twice(*keys: np.ndarray) -> np.ndarray:
    """Which rows have an equal row elsewhere; rows are equal if all ``keys`` are."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(0, bool)
    order = np.lexsort(keys[::-1])
    same = np.ones(n - 1, bool)
    for k in keys:
        s = k[order]
        same &= s[1:] == s[:-1]
    twice = np.zeros(n, bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.zeros(n, bool)
    out[order] = twice
    return out


def gathered(batches: Iterator[pa.RecordBatch], text_col: str, limit: int) -> Iterator[pa.Table]:
    """The rows of a task in blocks of about ``limit`` bytes of text, whatever the batches were."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in chunked(batch, text_col, limit // 4):
            held.append(part)
            size += part.column(part.schema.get_field_index(text_col)).nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda pad: 0


def release() -> None:
    """Give freed memory back to the system, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def squeeze(values: np.ndarray, level: int = 1) -> bytes:
    """Integers as zstandard of their byte planes, which suits sorted or small numbers."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def expand(packed: bytes, dtype: str) -> np.ndarray:
    """The integers that ``squeeze`` packed."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()
