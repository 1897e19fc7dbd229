"""Removal of byte strings that also start in an earlier document, over sorted suffixes.

The repeated strings are the runs of equal neighbours in the corpus's suffix
array. It is never built as a whole: suffixes are dealt to ranges of an anchor's
hash and sorted there. A window's anchor is its 24-byte gram with the smallest
hash, so equal windows have equal anchors at equal places, and one anchor in
about fourteen bytes speaks for all windows around it.

First the anchors of all documents are counted per hash range; what occurs in one
document only is out. For the others the bytes around them are exchanged. Equal
surroundings are settled at once; where they differ, every window over the
anchor is a suffix to sort, by multikey quicksort to a shallow depth and blind
tries beyond it. Anchors that occur very often, such as the head of an address,
would bring all documents to one range; the windows over those are dealt one by
one, by a hash of all their bytes, and sorted where they arrive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm import blocks as bl
from skylattice.llm import chunks as ch
from skylattice.llm.substring_dedup import EMPTY, _rows, _split
from skylattice.llm.suffixes import sort_suffixes
from skylattice.session import materialize

BLOCK_BYTES = 3 << 20
CHUNK_BYTES = 1 << 19
#: Bytes of an anchor.
GRAM = 24
#: Bytes of text whose anchors go to one hash range.
RANGE_BYTES = 8 << 20
SHALLOW = 24
#: Windows that are sorted at once; those of one anchor stay together.
WINDOWS = 1 << 16
#: An anchor with more occurrences than this is dealt by its windows.
HOT = 1 << 12
#: Hash ranges of such windows for each range of anchors, as a power of two.
HOT_BITS = 2
#: Anchors whose surroundings are cut out at once.
PIECE = 1 << 13
U64 = np.uint64


def _bytes(text: str) -> tuple[bytes, int]:
    raw = text.encode()
    return raw, len(raw)


def _gram(size: int) -> int:
    return min(GRAM, max(1, size // 2))


def anchors(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every anchor's hash, document, place, first window over it and number of windows over it."""
    none = np.zeros(0, np.int64)
    gram = _gram(size)
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, U64), none, none, none, none
    sums = ch.BYTES.sums(data)
    at = np.arange(len(data) - gram + 1)
    value = ch.BYTES.ranges(sums, at, at + gram)
    place = at.astype(np.int32)
    low, where = value, place
    reach = 1  # low[i] is the least of value[i : i + reach], the first of equal ones
    span = size - gram + 1
    while reach < span:
        step = min(reach, span - reach)
        right = low[step:] < low[:-step]
        where = np.where(right, where[step:], where[:-step])
        low = np.where(right, low[step:], low[:-step])
        reach += step
    doc = np.searchsorted(offsets, np.arange(n), "right") - 1
    first = np.flatnonzero(np.arange(n) + size <= offsets[doc + 1])
    if len(first) == 0:
        return np.zeros(0, U64), none, none, none, none
    of = where[first].astype(np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (of[1:] != of[:-1]) | (doc[first][1:] != doc[first][:-1])
    cut = np.flatnonzero(new)
    return value[of[cut]], doc[first[cut]], of[cut], first[cut], np.diff(np.append(cut, len(first)))


def block_anchors(block: bl.Block, size: int) -> list[np.ndarray]:
    """``anchors`` of a block, places and documents counted in the block."""
    found = []
    for a, b in block.chunks(CHUNK_BYTES):
        base = block.offsets[a]
        h, doc, place, first, many = anchors(block.data[base : block.offsets[b]], block.offsets[a : b + 1] - base, size)
        found.append((h, doc + a, place + base, first + base, many))
    if not found:
        return [np.zeros(0, U64), *[np.zeros(0, np.int64)] * 4]
    return [np.concatenate(x) for x in zip(*found)]


def _counted(h: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, which occur under two document orders, and how often each does."""
    by = np.lexsort((order, h))
    h, order = h[by], order[by]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    other = np.zeros(len(h), bool)
    other[1:] = ~new[1:] & (order[1:] != order[:-1])
    cut = np.flatnonzero(new)
    times = np.diff(np.append(cut, len(h)))
    return h[cut], np.add.reduceat(other, cut) > 0 if len(cut) else other, times


def _low(keys: np.ndarray, key_bits: int) -> np.ndarray:
    """32 bits of a hash below the ones that name its range."""
    return ((keys << U64(key_bits)) >> U64(32)).astype("<u4")


def count_anchors(blocks: DataFrame, size: int, key_bits: int) -> DataFrame:
    """(part, block, keys, multi, times): the distinct anchors of each block by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in bl.rows_of(batch):
                block = bl.Block(row)
                h, doc, *_ = block_anchors(block, size)
                keys, multi, times = _counted(h, block.orders[doc])
                times = np.minimum(times, np.iinfo(np.uint16).max).astype("<u2")
                out = [
                    (
                        part,
                        block.name,
                        bl.sorted_bytes(_low(keys[where], key_bits)),
                        bl.bits(multi[where]),
                        ch.squeeze(times[where]),
                    )
                    for part, where in _ranges(keys, key_bits)
                ]
                yield _rows(out, ["part", "block", "keys", "multi", "times"], [pa.int64(), pa.string(), *[pa.binary()] * 3])
                ch.release()

    return blocks.mapInArrow(run, "part long, block string, keys binary, multi binary, times binary")


def _verdicts(hot: int):
    """Merge the anchors of all blocks in one range; say per block which are repeated, and which very often."""

    def merge(table: pa.Table) -> pa.Table:
        names = table.column("block").to_pylist()
        part = table.column("part")[0].as_py()
        keys = [bl.sorted_values(x, "<u4") for x in table.column("keys").to_pylist()]
        multi = [bl.mask_of(x, len(k)) for x, k in zip(table.column("multi").to_pylist(), keys)]
        found = bl.seen_in_two(keys, multi)
        flat = np.concatenate(keys)
        times = np.concatenate([ch.expand(x, "<u2") for x in table.column("times").to_pylist()])
        order = np.argsort(flat, kind="stable")
        new = np.ones(len(flat), bool)
        new[1:] = flat[order][1:] != flat[order][:-1]
        number = np.empty(len(flat), np.int64)
        number[order] = np.cumsum(new) - 1
        often = (np.bincount(number, times) > hot)[number]
        often = np.split(often, np.cumsum([len(k) for k in keys])[:-1])
        kept = [(n, part, bl.bits(f), bl.bits(o)) for n, f, o in zip(names, found, often) if f.any()]
        ch.release()
        return pa.Table.from_batches([_rows(kept, MASKS, [pa.string(), pa.int64(), pa.binary(), pa.binary()])])

    return merge


MASKS = ["block", "part", "mask", "hot"]


def repeated_anchors(blocks: DataFrame, size: int, key_bits: int, hot: int = HOT) -> DataFrame:
    """(block, part, mask, hot): which anchors of a block are in two documents, and which occur more than ``hot`` times."""
    return materialize(
        count_anchors(blocks, size, key_bits)
        .groupBy("part")
        .applyInArrow(_verdicts(hot), "block string, part long, mask binary, hot binary"),
        "repeated_anchors",
    )


def _ranges(keys: np.ndarray, key_bits: int):
    if key_bits == 0:
        return [(0, slice(0, len(keys)))] if len(keys) else []
    return _split(keys, 64 - key_bits)


def _surroundings(data: np.ndarray, first: np.ndarray, many: np.ndarray, size: int, width: int) -> np.ndarray:
    """The bytes of all windows over an anchor, one row each, zero behind their end."""
    out = np.zeros((len(first), width), np.uint8)
    for at in range(0, len(first), PIECE):
        a, m = first[at : at + PIECE, None], many[at : at + PIECE, None]
        place = np.arange(width)[None, :]
        inside = place < m + size - 1
        out[at : at + PIECE] = np.where(inside, data[np.minimum(a + place, len(data) - 1)], 0)
    return out


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """64 bits of every row of bytes; the width is a multiple of eight."""
    words = rows.view("<u8").astype(U64)
    h = np.zeros(len(rows), U64)
    for i in range(words.shape[1]):
        h = ch.mix(h * U64(0x9E3779B97F4A7C15) + words[:, i] + U64(i + 1))
    return h


def _group_rows(h: np.ndarray, lead: np.ndarray, around: np.ndarray) -> np.ndarray:
    """A number per distinct (anchor, place in the surroundings, surroundings)."""
    key = ch.mix(_row_hash(around) ^ ch.mix(h + lead.astype(U64)))
    order = np.lexsort((key, h))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (h[order][1:] != h[order][:-1])
    # equal hashes are looked at: bytes decide
    same = np.flatnonzero(~new)
    differ = (around[order[same]] != around[order[same - 1]]).any(axis=1) | (lead[order[same]] != lead[order[same - 1]])
    new[same[differ]] = True
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number


def gather(
    block: bl.Block, masks: dict[int, tuple[bytes, bytes]], size: int, key_bits: int
) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray]]:
    """What a block sends to each range, and the ranges of bytes that it can settle alone.

    Of equal surroundings in the block only those of the smallest document are
    sent; in the other documents all windows over them are repeats. The same goes
    for the windows over hot anchors.
    """
    h, doc, place, first, many = block_anchors(block, size)
    keys, inverse = np.unique(h, return_inverse=True)
    hit = np.zeros(len(keys), bool)
    hot = np.zeros(len(keys), bool)
    for part, where in _ranges(keys, key_bits):
        if part in masks:
            hit[where], hot[where] = (bl.mask_of(x, where.stop - where.start) for x in masks[part])
    apart = (hit & hot)[inverse]
    sent, (start, end) = _gather_windows(block, doc[apart], first[apart], many[apart], size, key_bits + HOT_BITS)
    keep = (hit & ~hot)[inverse]
    more, (a, b) = _gather_anchors(block, h[keep], doc[keep], place[keep], first[keep], many[keep], size, key_bits)
    return sent + more, bl.merged(np.concatenate([start, a]), np.concatenate([end, b]))


def _gather_windows(
    block: bl.Block, doc: np.ndarray, first: np.ndarray, many: np.ndarray, size: int, bits: int
) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray]]:
    """``gather`` for hot anchors: a window each, dealt by a hash of all its bytes; parts count down from -2."""
    at = _expand(first, many)
    if len(at) == 0:
        return [], (at, at)
    order = block.orders[np.repeat(doc, many)]
    windows = np.lib.stride_tricks.sliding_window_view(block.data, size)
    key = np.empty(len(at), U64)
    low, high = first.min(), at.max() + size  # of the text only what windows cover
    sums = ch.BYTES.sums(block.data[low:high])
    for x in range(0, len(at), WINDOWS):
        y = at[x : x + WINDOWS] - low
        key[x : x + WINDOWS] = ch.BYTES.ranges(sums, y, y + size)
    by = np.lexsort((at, key))
    new = np.ones(len(by), bool)
    new[1:] = key[by][1:] != key[by][:-1]
    same = np.flatnonzero(~new)
    for x in range(0, len(same), WINDOWS):  # bytes decide
        i = same[x : x + WINDOWS]
        new[i] = (windows[at[by[i]]] != windows[at[by[i - 1]]]).any(axis=1)
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new) - 1
    least = np.full(number[by[-1]] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, order)
    later = order > least[number]
    sent = by[~later[by]]
    head = np.ones(len(sent), bool)
    head[1:] = number[sent][1:] != number[sent][:-1]
    cut = np.flatnonzero(head)
    times = np.diff(np.append(cut, len(sent)))
    heads, ends = sent[cut], np.cumsum(times)
    out = []
    for part, where in _ranges(key[heads], bits):
        mine = heads[where]
        places = at[sent[ends[where.start] - times[where.start] : ends[where.stop - 1]]]
        out.append(
            (
                -2 - part,
                block.name,
                bl.sorted_bytes(key[mine]),
                ch.squeeze(order[mine]),
                b"",
                ch.squeeze(np.diff(places, prepend=0).astype("<i4")),
                ch.squeeze(times[where].astype("<u4")),
                ch.zstandard.ZstdCompressor(level=3).compress(windows[at[mine]].tobytes()),
            )
        )
    return out, (at[later], at[later] + size)


def _gather_anchors(
    block: bl.Block, h: np.ndarray, doc: np.ndarray, place: np.ndarray, first: np.ndarray, many: np.ndarray, size: int, key_bits: int
) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray]]:
    """``gather`` for the other anchors: their surroundings, dealt by the anchor's hash."""
    if len(h) == 0:
        return [], (np.zeros(0, np.int64), np.zeros(0, np.int64))
    width = _width(size)
    around = _surroundings(block.data, first, many, size, width)
    lead = place - first
    number = _group_rows(h, lead, around)
    order = block.orders[doc]
    least = np.full(number.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, order)
    later = order > least[number]
    settled = (first[later], first[later] + many[later] + size - 1)
    sent = np.flatnonzero(~later)
    sent = sent[np.lexsort((first[sent], number[sent], h[sent]))]
    group = number[sent]
    head = np.ones(len(sent), bool)
    head[1:] = group[1:] != group[:-1]
    cut = np.flatnonzero(head)
    times = np.diff(np.append(cut, len(sent)))
    heads = sent[cut]
    out = []
    ends = np.cumsum(times)
    for part, where in _ranges(h[heads], key_bits):
        mine = heads[where]
        places = first[sent[ends[where.start] - times[where.start] : ends[where.stop - 1]]]
        out.append(
            (
                part,
                block.name,
                bl.sorted_bytes(h[mine]),
                ch.squeeze(order[mine]),
                ch.squeeze(np.stack([lead[mine], many[mine]]).astype(np.uint8).ravel()),
                ch.squeeze(np.diff(places, prepend=0).astype("<i4")),
                ch.squeeze(times[where].astype("<u4")),
                ch.zstandard.ZstdCompressor(level=3).compress(around[mine].tobytes()),
            )
        )
    return out, settled


def _width(size: int) -> int:
    """Bytes that hold all windows over an anchor, in whole words."""
    return -(-(2 * size - _gram(size)) // 8) * 8


def settle(table: pa.Table, size: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """For every block the ranges of bytes of one hash range that an earlier document has too."""
    width = _width(size)
    rows = table.to_pylist()
    keys = [bl.sorted_values(r["keys"], "<u8") for r in rows]
    sizes = [len(k) for k in keys]
    h = np.concatenate(keys)
    order = np.concatenate([ch.expand(r["orders"], "<i8") for r in rows])
    shape = [ch.expand(r["shape"], "u1").reshape(2, -1) for r in rows]
    lead = np.concatenate([s[0] for s in shape]).astype(np.int64)
    many = np.concatenate([s[1] for s in shape]).astype(np.int64)
    around = np.empty((len(h), width), np.uint8)
    at = 0
    for r, n in zip(rows, sizes):
        raw = ch.zstandard.ZstdDecompressor().decompress(r.pop("around"))
        around[at : at + n] = np.frombuffer(raw, np.uint8).reshape(-1, width)
        at += n
    times = np.concatenate([ch.expand(r["times"], "<u4") for r in rows]).astype(np.int64)
    places = np.concatenate([np.cumsum(ch.expand(r["places"], "<i4").astype(np.int64)) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)

    number = _group_rows(h, lead, around)
    least = np.full(number.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, order)
    whole = order > least[number]
    # one row for each distinct surroundings, of its smallest document
    same = np.flatnonzero(~whole)
    same = same[np.argsort(number[same], kind="stable")]
    head = np.unique(number[same], return_index=True)[1]
    tail = np.append(head[1:], len(same))
    one = same[head]  # the groups are numbered by anchor, so these are in order of it
    anchor = np.ones(len(one), bool)
    anchor[1:] = h[one][1:] != h[one][:-1]
    first_of = np.flatnonzero(anchor)
    crowd = np.diff(np.append(first_of, len(one)))
    starts, ends, blocks = [], [], []
    begin = np.cumsum(times) - times

    def mark(rows_of: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Add the bytes from ``low`` to ``high`` behind every place of these rows."""
        place = places[_expand(begin[rows_of], times[rows_of])]
        starts.append(place + np.repeat(low, times[rows_of]))
        ends.append(place + np.repeat(high, times[rows_of]))
        blocks.append(np.repeat(owner[rows_of], times[rows_of]))

    done = np.flatnonzero(whole)
    mark(done, np.zeros(len(done), np.int64), many[done] + size - 1)
    busy = np.flatnonzero(crowd > 1)
    load = np.add.reduceat(many[one], first_of) if len(one) else crowd
    for mine in np.split(busy, np.flatnonzero(np.diff(np.cumsum(load[busy]) // WINDOWS)) + 1):
        if len(mine) == 0:
            continue
        rep = _expand(first_of[mine], crowd[mine])
        rows_in = one[rep]
        found, offset = _repeated_windows(around[rows_in], many[rows_in], order[rows_in], size)
        owner_rep = np.repeat(np.arange(len(rep)), many[rows_in])
        hit = found < order[rows_in][owner_rep]
        # runs of repeated windows over one anchor
        a, b, which = ch.runs(hit, np.append(offset, len(hit)))
        copies = (tail - head)[rep[which]]
        row = same[_expand(head[rep[which]], copies)]
        low, high = a - offset[which], b - offset[which] + size - 1
        mark(row, np.repeat(low, copies), np.repeat(high, copies))
    return _by_block(rows, np.concatenate(starts), np.concatenate(ends), np.concatenate(blocks))


def _by_block(rows: list[dict], start: np.ndarray, end: np.ndarray, block: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """The ranges of each block, merged."""
    by = np.argsort(block, kind="stable")
    bounds = np.searchsorted(block[by], np.arange(len(rows) + 1))
    out = []
    for r, x, y in zip(rows, bounds[:-1], bounds[1:]):
        if y > x:
            out.append((r["block"], *bl.merged(start[by[x:y]], end[by[x:y]])))
    return out


def settle_windows(table: pa.Table, size: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """``settle`` for a hash range of single windows.

    Equal windows have equal hashes, so the range is sorted in pieces that end
    where a hash does.
    """
    rows = table.to_pylist()
    keys = [bl.sorted_values(r["keys"], "<u8") for r in rows]
    sizes = [len(k) for k in keys]
    key = np.concatenate(keys)
    order = np.concatenate([ch.expand(r["orders"], "<i8") for r in rows])
    windows = np.empty((len(key), size), np.uint8)
    at = 0
    for r, n in zip(rows, sizes):
        raw = ch.zstandard.ZstdDecompressor().decompress(r.pop("around"))
        windows[at : at + n] = np.frombuffer(raw, np.uint8).reshape(-1, size)
        at += n
    times = np.concatenate([ch.expand(r["times"], "<u4") for r in rows]).astype(np.int64)
    places = np.concatenate([np.cumsum(ch.expand(r["places"], "<i4").astype(np.int64)) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    by = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]])
    cut = edge[np.r_[True, np.diff(edge // WINDOWS) > 0]]
    later = np.zeros(len(key), bool)
    for a, b in zip(cut, [*cut[1:], len(by)]):
        mine = by[a:b]
        later[mine] = order[mine] > _least_equal(windows[mine], order[mine])
    found = np.flatnonzero(later)
    start = places[_expand((np.cumsum(times) - times)[found], times[found])]
    return _by_block(rows, start, start + size, np.repeat(owner[found], times[found]))


def _least_equal(windows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every window the smallest document with the same one; equal windows are neighbours when sorted."""
    _, number = sort_suffixes(windows, SHALLOW)
    least = np.full(number.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, order)
    return least[number]


def _expand(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], ..., begin[0] + n[0] - 1, begin[1], ..."""
    total = int(n.sum())
    out = np.arange(total)
    return out + np.repeat(begin - (np.cumsum(n) - n), n)


def _repeated_windows(around: np.ndarray, many: np.ndarray, order: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window over every anchor the smallest document with the same window; where a row's windows begin.

    The windows are suffixes of the surroundings, cut at ``size`` bytes. An anchor
    that is not hot has a bounded number of them.
    """
    offset = np.cumsum(many) - many
    row = np.repeat(np.arange(len(many)), many)
    step = np.arange(len(row)) - np.repeat(offset, many)
    flat = np.lib.stride_tricks.sliding_window_view(around.ravel(), size)
    return _least_equal(flat[row * around.shape[1] + step], order[row]), offset


#: The part of what a block settles alone.
OWN = -1


def surroundings(blocks: DataFrame, masks: DataFrame, size: int, key_bits: int) -> DataFrame:
    """What every block sends (``gather``), stored: to a range of anchors (part from 0 on) or of windows (from -2 down)."""
    sent = ["part", "block", "keys", "orders", "shape", "places", "times", "around"]
    kinds = [pa.int64(), pa.string(), *[pa.binary()] * 6]

    def send(key, table: pa.Table, found: pa.Table) -> pa.Table:
        part, mask, hot = (found.column(c).to_pylist() for c in ("part", "mask", "hot"))
        by_part = dict(zip(part, zip(mask, hot)))
        out = []
        for row in bl.rows_of(table):
            rows, (start, end) = gather(bl.Block(row), by_part, size, key_bits)
            out += rows
            if len(start):
                packed = (bl.sorted_bytes(start.astype("<i8")), bl.sorted_bytes(end.astype("<i8")))
                out.append((OWN, row["block"], *packed, b"", b"", b"", b""))
        ch.release()
        return pa.Table.from_batches([_rows(out, sent, kinds)])

    return materialize(
        blocks.groupBy("block")
        .cogroup(masks.groupBy("block"))
        .applyInArrow(send, "part long, block string, keys binary, orders binary, shape binary, places binary, times binary, around binary"),
        "surroundings",
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 50,
    with_bytes: bool = True,
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row of ``docs``.

    Texts are UTF-8 bytes. Every byte inside a string of ``size`` bytes that also
    starts in a document with a smaller id is removed; matches lie within one
    document, and strings are judged on the input. ``spans`` are the maximal
    removed runs (start, end), ``kept`` the bytes that are left, which may not be
    valid UTF-8; both come if ``with_bytes``. Ids are integers.

    Null and empty texts have no byte. A null id is smaller than all others.
    Rows with the same id are not earlier than one another, so repeated rows
    have one result. Other columns are not read; an empty table gives no row. A
    text is looked at whole and in one task, however long it is.

    Whole copies meet by a hash first. A block sends equal surroundings or windows
    once, so a passage in any share of the corpus costs one entry per block.
    ``hot`` says from how many occurrences on the windows over an anchor are dealt
    one by one over ranges of their own; it changes no result. ``size`` is 255 at
    most, since places in the surroundings are stored in a byte.
    """
    if not 2 <= size <= 255:
        raise ValueError("size must be from 2 to 255")
    blocks = bl.pack_blocks(bl.with_copies(docs, id_col, text_col), _bytes, size, block_bytes)
    total = blocks.agg(F.sum("total")).first()[0] or 0
    key_bits = int(total // range_bytes).bit_length()
    gathered = surroundings(blocks, repeated_anchors(blocks, size, key_bits, hot), size, key_bits)

    def answer(table: pa.Table) -> pa.Table:
        judge = settle if table.column("part")[0].as_py() >= 0 else settle_windows
        out = [
            (name, bl.sorted_bytes(a.astype("<i8")), bl.sorted_bytes(b.astype("<i8")))
            for name, a, b in judge(table, size)
        ]
        ch.release()
        return pa.Table.from_batches([_rows(out, ["block", "starts", "ends"], [pa.string(), pa.binary(), pa.binary()])])

    spans = (
        gathered.where(F.col("part") != OWN)
        .groupBy("part")
        .applyInArrow(answer, "block string, starts binary, ends binary")
        .unionByName(
            gathered.where(F.col("part") == OWN).select("block", F.col("keys").alias("starts"), F.col("orders").alias("ends"))
        )
    )
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def finish(key, table: pa.Table, found: pa.Table) -> pa.Table:
        ranges = [
            (bl.sorted_values(a, "<i8"), bl.sorted_values(b, "<i8"))
            for a, b in zip(found.column("starts").to_pylist(), found.column("ends").to_pylist())
        ]
        out = []
        for row in bl.rows_of(table):
            block = bl.Block(row)
            gone = np.zeros(len(block.data), bool)
            if ranges:
                start, end = bl.merged(*(np.concatenate(x) for x in zip(*ranges)))
                gone = ch.covered(start, end, len(block.data))
            a, b, doc = ch.runs(gone, block.offsets)
            cut = np.searchsorted(doc, np.arange(len(block.ids) + 1))
            for i, name in enumerate(block.ids):
                n = int(block.counts[i])
                if block.copies[i] < 0:  # a later copy of a stored text
                    out.append((name, n, n, 1, EMPTY, *[[{"start": 0, "end": n}], b""] * with_bytes))
                    continue
                base = int(block.offsets[i])
                runs = [(int(x) - base, int(y) - base) for x, y in zip(a[cut[i] : cut[i + 1]], b[cut[i] : cut[i + 1]])]
                text = block.raw[base : int(block.offsets[i + 1])]
                edges = [0, *(e for r in runs for e in r), len(text)]
                kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2]))
                more = [[{"start": x, "end": y} for x, y in runs], kept] * with_bytes
                out.append((name, n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), *more))
        ch.release()
        arrow = [*[pa.int64()] * 4, pa.string(), *[pa.list_(span), pa.binary()] * with_bytes]
        return pa.Table.from_batches([_rows(out, [id_col, *names, *["spans", "kept"] * with_bytes], arrow)])

    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return (
        blocks.groupBy("block")
        .cogroup(spans.groupBy("block"))
        .applyInArrow(finish, schema + ", spans array<struct<start:long,end:long>>, kept binary" * with_bytes)
    )
