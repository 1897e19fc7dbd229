"""Documents packed into stored blocks, for operators that look at every window of a text.

A block is one row: the ids of its documents and their text, compressed. Blocks
are written once and named by the row, so that later passes agree on what a
position in a block means whatever the cluster does meanwhile. Passes exchange
sorted, delta-coded arrays per block and hash range instead of rows per window.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from skylattice.llm import chunks as ch
from skylattice.session import broadcast_if_small, materialize

BLOCK_BYTES = 8 << 20
#: The order of a null id: before all others.
NULL_ID = -(1 << 63)


def with_copies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text, __first, __copies): per row the smallest id and the number of rows of its very text.

    Texts are compared by 128 bits and their length; only texts with copies are
    joined back, by broadcast where their measured size allows it.
    """
    marked = docs.select(
        F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    ).select(
        "*",
        F.coalesce("__id", F.lit(NULL_ID)).alias("__order"),
        F.xxhash64("__text").alias("__t1"),
        F.xxhash64(F.lit(7), F.col("__text"), F.octet_length("__text")).alias("__t2"),
    )
    copied = materialize(
        marked.groupBy("__t1", "__t2")
        .agg(F.min("__order").alias("__first"), F.count(F.lit(1)).alias("__copies"))
        .where("__copies > 1"),
        "copies",
    )
    joined = marked.join(broadcast_if_small(copied), ["__t1", "__t2"], "left")
    return joined.select(
        "__id",
        "__text",
        F.coalesce("__first", "__order").alias("__first"),
        F.coalesce("__copies", F.lit(1)).alias("__copies"),
    )


def pack_blocks(
    rows: DataFrame, prepare: Callable[[str], tuple[bytes, int]], least: int, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The stored blocks, of about ``block_bytes`` of text, of the rows of ``with_copies``.

    ``prepare`` gives a text's stored bytes and its count (bytes or words).
    Later copies of a text with ``least`` or more are listed, but not stored:
    their first copy stands for them. Columns: block, ids, orders, counts,
    copies, sizes (stored bytes) as arrays, total and text.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for block in ch.gathered(batches, "__text", block_bytes):
            ids = block.column("__id").combine_chunks()
            order = block.column("__id").fill_null(NULL_ID).to_numpy()
            first = block.column("__first").to_numpy()
            copies = block.column("__copies").to_numpy()
            parts = [prepare(x) for x in block.column("__text").to_pylist()]
            counts = np.array([n for _, n in parts], np.int64)
            left_out = (order > first) & (counts >= least)
            stored = [b"" if out else x for (x, _), out in zip(parts, left_out)]
            rows_in = pa.array([0, len(ids)], pa.int32())
            listed = lambda x: pa.ListArray.from_arrays(rows_in, x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    listed(ids),
                    listed(pa.array(order)),
                    listed(pa.array(counts)),
                    listed(pa.array(np.where(left_out, -copies, copies))),
                    listed(pa.array(np.fromiter(map(len, stored), np.int64, len(stored)))),
                    pa.array([int(counts[~left_out].sum())]),
                    pa.array([packer.compress(b"".join(stored))], pa.binary()),
                ],
                ["block", "ids", "orders", "counts", "copies", "sizes", "total", "text"],
            )

    many = "array<long>"
    schema = f"block string, ids {many}, orders {many}, counts {many}, copies {many}, sizes {many}, total long, text binary"
    return materialize(rows.mapInArrow(pack, schema), "blocks")


class Block:
    """A block row, unpacked."""

    def __init__(self, row: dict):
        self.name = row["block"]
        self.ids = row["ids"]
        self.orders = np.array(row["orders"], np.int64)
        self.counts = np.array(row["counts"], np.int64)
        self.copies = np.array(row["copies"], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(np.array(row["sizes"], np.int64))])
        self.raw = zstandard.ZstdDecompressor().decompress(row["text"])
        self.data = np.frombuffer(self.raw, np.uint8)

    def chunks(self, limit: int) -> Iterator[tuple[int, int]]:
        """Ranges of documents with about ``limit`` bytes, one document at least."""
        n, at = len(self.offsets) - 1, 0
        while at < n:
            to = int(np.searchsorted(self.offsets, self.offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), n)
            yield at, to
            at = to


def rows_of(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """The rows one at a time, so that one block is unpacked at once."""
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


def sorted_bytes(values: np.ndarray) -> bytes:
    """Rising unsigned numbers, compressed by their differences."""
    first = values[:1].astype(values.dtype)
    return ch.squeeze(np.concatenate([first, np.diff(values)]))


def sorted_values(packed: bytes, dtype: str) -> np.ndarray:
    return np.cumsum(ch.expand(packed, dtype), dtype=dtype)


def bits(mask: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(mask).tobytes())


def mask_of(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.unpackbits(raw, count=n).astype(bool)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges, as rising ranges that do not touch."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], reach[last]


def seen_in_two(keys: list[np.ndarray], multi: list[np.ndarray]) -> list[np.ndarray]:
    """Per array of distinct keys, which occur in another array too or are marked ``multi``."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    same = s[1:] == s[:-1]
    hit = np.concatenate(multi)[order]
    hit[1:] |= same
    hit[:-1] |= same
    # a mark holds for the key wherever it occurs
    group = np.concatenate([[0], np.cumsum(~same)])
    marked = np.zeros(group[-1] + 1, bool)
    marked[group[hit]] = True
    out = np.empty(len(flat), bool)
    out[order] = marked[group]
    return np.split(out, np.cumsum([len(k) for k in keys])[:-1])
