"""SimHash fingerprints and near-duplicate groups by pigeonring filtering.

A 64-bit fingerprint is cut into a ring of ``parts`` segments. If two
fingerprints differ in at most d bits, some chain of consecutive segments has,
at each length l, at most l * d / parts differing bits. With d = 3 and four
segments a chain starts with an equal segment, and the first two differ in one
bit at most; so of four nibbles of the second segment three are equal. Equal
segment and three nibbles are the join key: 28 equal bits, 16 keys a
fingerprint. Rows that meet on a key go through the rest of the chain condition
and then the full Hamming check, whatever the size of their bucket. A crowded
bucket is dealt out by more bits first, and of its n fingerprints each gives one
link at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skylattice.llm import chunks as ch
from skylattice.llm.components import components
from skylattice.session import broadcast_if_small, materialize

BITS = 64
SEED = 42
U64 = np.uint64
#: Members of a bucket that are compared with each other before it is dealt out by more bits.
CROWD = 32
#: Bytes of a text whose words are held at once.
STRETCH = 1 << 20
SPACE = re.compile(rb"[\x20\t-\r]")


def _stretches(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, those of about ``STRETCH`` bytes at a time."""
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + STRETCH) if len(text) - at > STRETCH else None
        end = space.start() if space else len(text)
        yield text[at:end].lower().split()
        at = end


def _shingle_hashes(items: list[bytes], shingle: int) -> np.ndarray:
    """The hash of every run of ``shingle`` words."""
    buffer = b" ".join(items)
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1)
    starts = [0, *ends[: len(items) - shingle].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(buffer[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], U64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of one text, whose words are held a stretch at a time."""
    set_bits, n = np.zeros(BITS, np.int64), 0
    items: list[bytes] = []
    for words in _stretches(text):
        items += words
        if len(items) < shingle:
            continue
        hashes = _shingle_hashes(items, shingle)
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
            set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        items = items[len(items) - shingle + 1 :]
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(items), SEED) if items else 0
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number for every row of ``docs``.

    ASCII letters are lower-cased; a text shorter than ``shingle`` words is one
    shingle, and one without words (or null) has fingerprint zero. Texts are
    read whole, a stretch of words at a time, so a long one costs little more
    than its own bytes.
    """
    source = docs.select(id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in texts), U64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], [id_col, "fp"])
            ch.release()

    id_type = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(compute, f"`{id_col}` {id_type}, fp long")


def _budgets(distance: int, parts: int) -> list[int]:
    """Most differing bits of the first 1, 2, ... segments of a chain."""
    return [distance * length // parts for length in range(1, parts + 1)]


def chain_keys(fps: np.ndarray, parts: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint its join keys, and the bits that a key compares, one column per key.

    A chain's first segment may differ in f = distance // parts bits, the first
    two in s. The pair of segments is cut into s + 1 pieces more than needed
    (2 * (s + 1)), of which any pair in budget agrees on all but s; one key per
    choice of the s pieces left out, with segments that must agree kept whole.
    """
    width = BITS // parts
    budget = _budgets(distance, parts)
    s = budget[min(1, parts - 1)]
    whole = 1 if budget[0] == 0 else 0
    free = width * (2 - whole)
    pieces = min(free, 4 * max(1, s))
    cuts = [free * i // pieces for i in range(pieces + 1)]
    keys, masks = [], []
    for chain in range(parts):
        for out in combinations(range(pieces), s) if s else [()]:
            mask = 0
            if whole:
                mask |= ((1 << width) - 1) << (chain * width)
            for i in range(pieces):
                if i not in out:
                    for bit in range(cuts[i], cuts[i + 1]):
                        at = chain * width + whole * width + bit
                        mask |= 1 << (at % BITS)
            masks.append(mask)
            keys.append(ch.mix((fps & U64(mask)) ^ U64(len(masks) * 0x9E3779B97F4A7C15 % (1 << 64))))
    return np.stack(keys, axis=1), np.array(masks, U64)


def in_chain(diff: np.ndarray, parts: int, distance: int) -> np.ndarray:
    """Which XORs have a chain whose every prefix is within its proportional budget."""
    width = BITS // parts
    part = np.stack(
        [np.bitwise_count((diff >> U64(i * width)) & U64((1 << width) - 1)) for i in range(parts)]
    ).astype(np.int64)
    budget = _budgets(distance, parts)
    found = np.zeros(diff.shape, bool)
    for start in range(parts):
        total = np.zeros(diff.shape, np.int64)
        fine = np.ones(diff.shape, bool)
        for length in range(parts):
            total = total + part[(start + length) % parts]
            fine &= total <= budget[length]
        found |= fine
    return found


def _near(fps: np.ndarray, group: np.ndarray, parts: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y) of linked fingerprints in one group; ``group`` is sorted.

    Pairs go through the chain condition first, those left through the Hamming check.
    """
    rows, shift = np.arange(len(group)), 1
    while True:
        rows = rows[rows + shift < len(group)]
        rows = rows[group[rows] == group[rows + shift]]
        if len(rows) == 0:
            return
        diff = fps[rows] ^ fps[rows + shift]
        chained = in_chain(diff, parts, distance)
        x = rows[chained][np.bitwise_count(diff[chained]) <= distance]
        yield x, x + shift
        shift += 1


def _join(low: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Put the groups of each x and y together; ``low`` names a member's group by its smallest one."""
    while True:
        a, b = low[x], low[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low[:] = low[low]


def _settle(fps: np.ndarray, low: np.ndarray, parts: int, distance: int) -> None:
    """Join in ``low`` all linked fingerprints of one bucket, in which some may be joined already."""
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [b for b in range(BITS) if free >> b & 1]
    if len(fps) <= CROWD or len(bits) <= 2 * distance:
        for x, y in _near(fps, np.zeros(len(fps), np.int64), parts, distance):
            _join(low, x, y)
        return
    for kept in combinations(range(2 * distance), distance):
        value = fps & U64(sum(1 << b for piece in kept for b in bits[piece :: 2 * distance]))
        rows = np.argsort(value, kind="stable")
        value = value[rows]
        cut = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        size = np.diff(np.r_[cut, len(rows)])
        open_ = np.minimum.reduceat(low[rows], cut) != np.maximum.reduceat(low[rows], cut)
        few = np.repeat(open_ & (size <= CROWD), size)
        for x, y in _near(fps[rows[few]], value[few], parts, distance):
            _join(low, rows[few][x], rows[few][y])
        for g in np.flatnonzero(open_ & (size > CROWD)):
            own = rows[cut[g] : cut[g] + size[g]]
            _, first, place = np.unique(low[own], return_index=True, return_inverse=True)
            if len(first) > 1:
                inner = first[place]
                _settle(fps[own], inner, parts, distance)
                _join(low, own, own[inner])


def bucket_links(fps: np.ndarray, parts: int, distance: int) -> list[tuple[int, int]]:
    """For the distinct fingerprints of one bucket, links from each to the smallest place it reaches.

    A crowd is dealt out again: its varying bits are cut into 2 * distance
    pieces, and two members within ``distance`` agree on some ``distance`` of
    them whole. Each choice of pieces halves the bits that still vary. Groups
    whose members are linked already are settled; all others end in groups of
    ``CROWD`` or few varying bits, where every pair is tested. Many members
    without links need many varying bits, so that both kinds stay small.
    """
    low = np.arange(len(fps))
    if distance > 0 and len(fps):  # distinct fingerprints differ in a bit at least
        _settle(fps, low, parts, distance)
    linked = np.flatnonzero(low != np.arange(len(fps)))
    return list(zip(linked.tolist(), low[linked].tolist()))


def _sorted_links(keys: np.ndarray, fps: np.ndarray, parts: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in rows sorted by key: small buckets all at once, crowded ones each on its own."""
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[cut, len(keys)])
    group = np.repeat(np.arange(len(cut)), size)
    small = size[group] <= CROWD
    left, right = [np.zeros(0, U64)], [np.zeros(0, U64)]
    own = fps[small]
    for x, y in _near(own, group[small], parts, distance):
        left.append(own[x])
        right.append(own[y])
    for g in np.flatnonzero(size > CROWD):
        own = np.unique(fps[cut[g] : cut[g] + size[g]])
        pairs = bucket_links(own, parts, distance)
        if pairs:
            a, b = np.array(pairs).T
            left.append(own[a])
            right.append(own[b])
    return np.concatenate(left), np.concatenate(right)


def near_links(fps: DataFrame, distance: int = 3, parts: int = 4) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints (column ``fp``) within ``distance`` bits.

    Links of a crowded bucket go to the smallest fingerprint reached in it, which
    may be further away than ``distance``; what hangs together is the same.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 15):
                values = batch.column(0).slice(at, 1 << 15).to_numpy().view(U64)
                keys, _ = chain_keys(values, parts, distance)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.repeat(values, keys.shape[1]).view(np.int64)),
                    ],
                    ["key", "fp"],
                )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, U64)

        def links(upto: int) -> pa.RecordBatch:
            a, b = _sorted_links(keys[:upto], fps[:upto], parts, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(U64)])
            upto = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            if upto:  # the last key may go on in the next batch
                yield links(upto)
                keys, fps = keys[upto:], fps[upto:]
        if len(keys):
            yield links(len(keys))

    dealt = fps.mapInArrow(keyed, "key long, fp long")
    parts_n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts_n, "key")
        .sortWithinPartitions("key")
        .mapInArrow(linked, "a long, b long")
        .distinct()
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    parts: int = 4,
    max_rounds: int = 100,
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is
    the smallest id reachable over links, the row's own included. Null and empty
    texts have fingerprint zero and are linked like any other; repeated rows
    keep a row each; a null id is passed over when the smallest is taken, and a
    group of null ids only has a null component. Copies meet in one fingerprint
    before anything is compared, so a group of copies of any size costs one row.
    An empty table gives none; columns of ``docs`` but id and text are not read,
    so no name clashes. ``max_rounds`` goes to ``components``, whose rounds grow
    with the logarithm of the largest group; it raises beyond them.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    per_fp = marked.groupBy("fp").agg(F.min(id_col).alias("low"))
    links = near_links(per_fp.select("fp"), distance, parts)
    roots = components(links, max_rounds)
    merged = per_fp.join(roots, per_fp.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    smallest = merged.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = merged.join(smallest, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` with one document of each group, all columns kept.

    The smallest by (id, row hash) stays; a null id is the smallest. Rows that
    repeat id and text are one document, of which one row stays. Nothing is
    shuffled with its text if the dropped rows are few enough to broadcast.
    """
    keyed = docs.select(
        "*",
        F.xxhash64(id_col, text_col).alias("__k1"),
        F.xxhash64(F.lit(7), F.col(id_col), F.col(text_col)).alias("__k2"),
    )
    named = keyed.withColumn("__row", F.struct(id_col, "__k1", "__k2"))
    groups = materialize(near_groups(named, "__row", text_col, shingle, distance), "groups")
    gone = groups.where(~F.col("__row").eqNullSafe(F.col("component_id"))).select("__row.__k1", "__row.__k2")
    left = keyed.join(broadcast_if_small(gone.distinct()), ["__k1", "__k2"], "left_anti")
    repeats = groups.groupBy("__row").count().where("count > 1").limit(1).count()
    if repeats:
        left = left.dropDuplicates(["__k1", "__k2"])
    return left.select(*docs.columns)
