"""Removal of word windows that occur twice, with a count-min prefilter.

Pass one counts: every partition's block of documents sketches its windows, two
rows of cells each, and the sketches are merged by ranges of cells. A cell's
count is at least that of any of its windows, so a window is given up only if
one of its cells was hit once. Pass two groups the windows that both rows
estimate as repeated, by 96 bits of their words. Nothing repeated is lost, and
what the sketch overestimates is put right.

A sketch is exchanged as the sorted cells that a block hits, not as an array of
counters; its width is four cells per window of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm import blocks as bl
from skylattice.llm import chunks as ch
from skylattice.session import materialize

ROWS = 2
BLOCK_BYTES = bl.BLOCK_BYTES
CELLS_PER_WINDOW = 4
#: Cells in one range of a merged sketch.
RANGE_BITS = 24
CHUNK_BYTES = 1 << 20
U64 = np.uint64


def _words(text: str) -> tuple[bytes, int]:
    found = text.encode().split()
    return b" ".join(found) + b" " if found else b"", len(found)


def window_hashes(block: bl.Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window (numbered in the block) and 128 bits of it; the words' documents."""
    first, one, two, docs = [], [], [], []
    base = 0
    for a, b in block.chunks(CHUNK_BYTES):
        data = block.data[block.offsets[a] : block.offsets[b]]
        offsets = block.offsets[a : b + 1] - block.offsets[a]
        starts, ends, doc = ch.words(data, offsets)
        at = ch.windows(doc, size)
        for seed, out in enumerate((one, two)):
            out.append(ch.run_hashes(ch.span_hashes(data, starts, ends, seed), at, size))
        first.append(at + base)
        docs.append(doc + a)
        base += len(doc)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(first, np.int64), join(one, U64), join(two, U64), join(docs, np.int64)


def cells(one: np.ndarray, two: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of every window in one row of the sketch."""
    return (one if row == 0 else ch.mix(two ^ U64(0x2545F4914F6CDD1D))) >> U64(64 - bits)


def _split(keys: np.ndarray, shift: int) -> Iterator[tuple[int, slice]]:
    """The ranges of sorted ``keys`` that share the bits above ``shift``."""
    group = (keys >> U64(shift)).astype(np.int64)
    cut = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cut], [*cut, len(keys)]):
        if b > a:
            yield int(group[a]), slice(a, b)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and which occurred twice."""
    s = np.sort(keys)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.flatnonzero(new)
    return s[at], np.diff(np.append(at, len(s))) > 1


def _rows(values: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*values) if values else [[]] * len(kinds), kinds)], names
    )


def _verdicts(keys_type: str):
    """Merge the keys of all blocks in one range; say per block which are repeated."""

    def merge(table: pa.Table) -> pa.Table:
        names = table.column("block").to_pylist()
        keys = [bl.sorted_values(x, keys_type) for x in table.column("keys").to_pylist()]
        multi = [bl.mask_of(x, len(k)) for x, k in zip(table.column("multi").to_pylist(), keys)]
        if "more" in table.column_names:
            more = [ch.expand(x, "<u4") for x in table.column("more").to_pylist()]
            wide = [np.rec.fromarrays([k, m], names="k,m") for k, m in zip(keys, more)]
            found = _repeated_wide(wide, multi)
        else:
            found = bl.seen_in_two(keys, multi)
        part = table.column("part")[0].as_py()
        kept = [(n, part, bl.bits(f)) for n, f in zip(names, found) if f.any()]
        return pa.Table.from_batches([_rows(kept, ["block", "part", "mask"], [pa.string(), pa.int64(), pa.binary()])])

    return merge


def _repeated_wide(keys: list[np.ndarray], multi: list[np.ndarray]) -> list[np.ndarray]:
    """``seen_in_two`` for keys of two fields."""
    k = np.concatenate([x["k"] for x in keys])
    m = np.concatenate([x["m"] for x in keys])
    order = np.lexsort((m, k))
    new = np.ones(len(order), bool)
    new[1:] = (k[order][1:] != k[order][:-1]) | (m[order][1:] != m[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return bl.seen_in_two(np.split(number, np.cumsum([len(x) for x in keys])[:-1]), multi)


def sketch(blocks: DataFrame, size: int, bits: int, range_bits: int) -> DataFrame:
    """(part, block, keys, multi): the cells that each block hits, by row and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in bl.rows_of(batch):
                block = bl.Block(row)
                _, one, two, docs = window_hashes(block, size)
                out = []
                for r in range(ROWS):
                    keys, twice = _distinct(cells(one, two, r, bits))
                    for part, where in _split(keys, range_bits):
                        low = (keys[where] & U64((1 << range_bits) - 1)).astype("<u4")
                        out.append((ROWS * part + r, block.name, bl.sorted_bytes(low), bl.bits(twice[where])))
                yield _rows(out, ["part", "block", "keys", "multi"], [pa.int64(), pa.string(), pa.binary(), pa.binary()])

    return blocks.mapInArrow(run, "part long, block string, keys binary, multi binary")


def _estimated(masks: dict[int, bytes], one: np.ndarray, two: np.ndarray, bits: int, range_bits: int) -> np.ndarray:
    """Which windows both rows of the merged sketch estimate as repeated."""
    found = np.ones(len(one), bool)
    for r in range(ROWS):
        own = cells(one, two, r, bits)
        keys, _ = _distinct(own)
        hit = np.zeros(len(keys), bool)
        for part, where in _split(keys, range_bits):
            mask = masks.get(ROWS * part + r)
            if mask is not None:
                hit[where] = bl.mask_of(mask, where.stop - where.start)
        found &= hit[np.searchsorted(keys, own)]
    return found


def _candidates(block: bl.Block, masks: dict[int, bytes], size: int, bits: int, range_bits: int):
    """First words of the estimated windows, their distinct 96-bit keys, and the key of each window."""
    first, one, two, docs = window_hashes(block, size)
    keep = _estimated(masks, one, two, bits, range_bits)
    first, one, two = first[keep], one[keep], two[keep] >> U64(32)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    at = order[new]
    return first, one[at], two[at], number, docs


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 35,
    with_text: bool = True,
    cells_per_window: int = CELLS_PER_WINDOW,
    range_bits: int = RANGE_BITS,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) for every row of ``docs``; ``kept`` if ``with_text``.

    Words are maximal runs of anything but ASCII white space. Every word inside
    a window of ``size`` words that starts anywhere else too, in the same or
    another row, is removed; ``kept`` is what is left, joined by one space.
    Windows are judged on the input. Ids are integers. Null and empty texts have no words and give
    an empty text; rows that repeat are copies of each other, and a null id stays
    null. Other columns are not read; an empty table gives no row.

    Copies of a whole text meet by a hash first and enter the windows once, and a
    block names a window once, so a passage in any share of the corpus costs one
    key per block.
    """
    blocks = bl.pack_blocks(bl.with_copies(docs, id_col, text_col), _words, size, BLOCK_BYTES)
    total = blocks.agg(F.sum("total")).first()[0] or 0
    bits = max(range_bits, int(cells_per_window * total).bit_length())
    parts = max(1, total >> 21)
    masks = materialize(
        sketch(blocks, size, bits, range_bits)
        .groupBy("part")
        .applyInArrow(_verdicts("<u4"), "block string, part long, mask binary"),
        "estimates",
    )
    key_bits = max(0, (parts - 1).bit_length() - 2)

    def group(key, table: pa.Table, found: pa.Table) -> pa.Table:
        by_part = dict(zip(found.column("part").to_pylist(), found.column("mask").to_pylist()))
        out = []
        for row in bl.rows_of(table):
            block = bl.Block(row)
            first, one, two, number, docs = _candidates(block, by_part, size, bits, range_bits)
            twice = np.bincount(number, minlength=len(one)) > 1
            twice |= _always(block, docs, first, number, len(one))
            for part, where in _split(one, 64 - key_bits) if key_bits else [(0, slice(0, len(one)))] * bool(len(one)):
                out.append(
                    (part, block.name, bl.sorted_bytes(one[where]), bl.bits(twice[where]), ch.squeeze(two[where].astype("<u4")))
                )
        return pa.Table.from_batches(
            [_rows(out, ["part", "block", "keys", "multi", "more"], [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()])]
        )

    def finish(key, table: pa.Table, found: pa.Table) -> pa.Table:
        kinds = found.column("kind").to_pylist()
        pairs = list(zip(kinds, found.column("part").to_pylist(), found.column("mask").to_pylist()))
        sketched = {p: m for k, p, m in pairs if k == "sketch"}
        exact = {p: m for k, p, m in pairs if k == "exact"}
        out = []
        for row in bl.rows_of(table):
            block = bl.Block(row)
            first, one, two, number, docs = _candidates(block, sketched, size, bits, range_bits)
            hit = np.zeros(len(one), bool)
            for part, where in _split(one, 64 - key_bits) if key_bits else [(0, slice(0, len(one)))] * bool(len(one)):
                if part in exact:
                    hit[where] = bl.mask_of(exact[part], where.stop - where.start)
            first = first[hit[number]]
            gone = ch.covered(first, first + size, len(docs))
            ends = np.searchsorted(docs, np.arange(len(block.ids)), "right")
            begin = np.searchsorted(docs, np.arange(len(block.ids)), "left")
            for i, doc in enumerate(block.ids):
                if abs(block.copies[i]) > 1 and block.counts[i] >= size:  # copies of each other
                    out.append((doc, int(block.counts[i]), int(block.counts[i]), EMPTY, *[""] * with_text))
                    continue
                text = block.raw[block.offsets[i] : block.offsets[i + 1]]
                mine = gone[begin[i] : ends[i]]
                kept = text[:-1]
                if mine.any():
                    kept = b" ".join(w for w, g in zip(text.split(), mine.tolist()) if not g)
                out.append((doc, int(block.counts[i]), int(mine.sum()), hashlib.sha256(kept).hexdigest(), *[kept.decode()] * with_text))
        return pa.Table.from_batches([_rows(out, [id_col, *names], [*[pa.int64()] * 3, *[pa.string()] * len(names[2:])])])

    names = ["n_words", "n_removed", "kept_sha256", *["kept"] * with_text]

    exact = (
        blocks.groupBy("block")
        .cogroup(masks.groupBy("block"))
        .applyInArrow(group, "part long, block string, keys binary, multi binary, more binary")
        .groupBy("part")
        .applyInArrow(_verdicts("<u8"), "block string, part long, mask binary")
    )
    both = masks.select("block", F.lit("sketch").alias("kind"), "part", "mask").unionByName(
        exact.select("block", F.lit("exact").alias("kind"), "part", "mask")
    )
    return (
        blocks.groupBy("block")
        .cogroup(both.groupBy("block"))
        .applyInArrow(finish, f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
    )


EMPTY = hashlib.sha256(b"").hexdigest()


def _always(block: bl.Block, docs: np.ndarray, first: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    """Which keys are of a stored text that has later copies: they are repeated for certain."""
    out = np.zeros(n, bool)
    out[number[block.copies[docs[first]] > 1]] = True
    return out
