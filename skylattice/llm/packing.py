"""Harmonic packing of tokenised documents into fixed-length sequences.

Each worker packs its own documents. A document's full-length pieces are
sequences as they are. Of the rest, the binary parts down to ``least_cut`` are
cut off; what remains is short. A piece of length s is of class floor(capacity /
s): its bins take exactly that many pieces, so a bin is known to be full by
counting, and a class wastes at most 1 / (class + 1) of a bin. Bins that are not
full when the worker ends are run together, cut at the sequence ends.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skylattice.llm import chunks as ch

#: Texts of these characters only are encoded from the rank file, all others from
#: the tokenizer file: both hold one vocabulary, and classes of rarer characters
#: are those of the tokenizer's own pattern.
COMMON = re.compile("[^\\n\x20-\x7e\xa1-\xac\xae-\u024f]")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the file that defines the ids, added tokens in the text
    included. With ``ranks``, the file of the same vocabulary in rank order, texts
    of common characters without an added token are encoded several times as fast,
    to the same ids.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer)
        added = [x.content for x in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        self._fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def _has_added(self, text: str) -> bool:
        return self._added is not None and self._added.search(text) is not None

    def __call__(self, texts: list[str]) -> list[bytes]:
        slow = [i for i, x in enumerate(texts) if self._fast is None or COMMON.search(x) or self._has_added(x)]
        ids: list = [None] * len(texts)
        found = self._tokenizer.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)
        for i, x in zip(slow, found):
            ids[i] = x.ids
        if self._fast is not None:
            ids = [self._fast.encode_ordinary(x) if y is None else y for x, y in zip(texts, ids)]
        return [np.array(x, "<u4").tobytes() for x in ids]


@lru_cache(maxsize=2)
def encoder(*files: str | None) -> Encoder:
    """One encoder per worker process, whatever number of tasks it runs."""
    return Encoder(*files)


def tail_pieces(length: int, capacity: int, least_cut: int) -> list[int]:
    """Lengths that the rest of a document, shorter than ``capacity``, is cut into."""
    out = []
    part = capacity // 2
    while part >= least_cut:
        if length >= part:
            out.append(part)
            length -= part
        part //= 2
    if length:
        out.append(length)
    return out


class Packer:
    """The bins of one worker; pieces are (doc, start, ids, doc_tokens)."""

    def __init__(self, emit: Callable, capacity: int, least_cut: int):
        self.emit, self.capacity, self.least_cut = emit, capacity, least_cut
        self.bins: dict[tuple[int, bool], list] = defaultdict(list)

    def add(self, doc, ids: bytes) -> None:
        n = len(ids) // 4
        start = 0
        while n - start >= self.capacity:
            self.emit([(doc, start, ids[4 * start : 4 * (start + self.capacity)], n)])
            start += self.capacity
        for length in tail_pieces(n - start, self.capacity, self.least_cut):
            kind = (self.capacity // length, self.capacity % length == 0)
            self.bins[kind].append((doc, start, ids[4 * start : 4 * (start + length)], n))
            start += length
            if len(self.bins[kind]) == kind[0]:
                self.emit(self.bins.pop(kind))

    def close(self) -> None:
        """Run the pieces of bins that are not full together."""
        held, room = [], self.capacity
        for kind in sorted(self.bins):
            for doc, start, ids, n in self.bins[kind]:
                while ids:
                    part = ids[: 4 * room]
                    held.append((doc, start, part, n))
                    room -= len(part) // 4
                    start += len(part) // 4
                    ids = ids[len(part) :]
                    if room == 0:
                        self.emit(held)
                        held, room = [], self.capacity
        if held:
            self.emit(held)
        self.bins.clear()


COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    least_cut: int = 128,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its document, place there, checksum, sequence and place in the sequence.

    A document is its token ids and then ``end_id``; each id lies in exactly one
    piece. Null and empty texts are the end id alone. Repeated rows are packed
    each on its own; a null id stays null; other columns are not read; an empty
    table gives no row. Sequence ids hold the worker's partition in their high
    bits, so workers need no exchange: there is no shuffle, and a task that runs
    again gives the same rows. ``with_ids`` adds the ids as ``array<int>``.
    """
    source = docs.select(id_col, text_col)
    id_type = source.schema[id_col].dataType.simpleString()
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks, pattern)
        partition = TaskContext.get().partitionId()
        rows: list[list] = [[] for _ in range(8)]
        made = 0

        def emit(pieces: list) -> None:
            nonlocal made
            offset = 0
            for doc, start, ids, n in pieces:
                values = (doc, start, len(ids) // 4, zlib.crc32(ids), n, (partition << 36) + made, offset, ids)
                for column, value in zip(rows, values):
                    column.append(value)
                offset += len(ids) // 4
            made += 1

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(rows[0], id_arrow), *(pa.array(x, pa.int64()) for x in rows[1:7])]
            if with_ids:
                ends = np.cumsum([0, *rows[2]]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(rows[7]), "<i4"))
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            for column in rows:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, [id_col, *names, *(["ids"] if with_ids else [])])

        packer = Packer(emit, capacity, least_cut)
        end = np.array([end_id], "<u4").tobytes()
        id_arrow = None
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for part in ch.chunked(batch, text_col):
                texts = [x or "" for x in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encode(texts)):
                    packer.add(doc, ids + end)
                yield flush()
        packer.close()
        if rows[0]:
            yield flush()

    return source.mapInArrow(run, f"`{id_col}` {id_type}, {COLUMNS}" + ", ids array<int>" * with_ids)
