"""Benchmark decontamination over a positional inverted index of the corpus.

The index is a table with one row per block of documents: for every token of the
block its sorted positions, delta-coded and compressed. It is written once and
can be searched again. A benchmark window is looked up by the posting lists of
its words, moved by their place in the window and intersected from the rarest
word on; what is left are the exact occurrences. Proximity matches need every
word near an occurrence of one of them, in any order, in one document.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skylattice.llm import chunks as ch
from skylattice.session import broadcast_if_small, materialize

BLOCK_BYTES = 4 << 20
#: Benchmark windows that one pass over the index takes along.
SHARD_WINDOWS = 200_000
#: Bytes of the table of words and stretches that proximity is first looked up in.
TABLE_BYTES = 32 << 20
#: Stretches whose places are compared at once.
STRETCHES = 1 << 12
#: A distance that is no distance.
FAR = np.iinfo(np.int64).max

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z are words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text; none for null."""
    return (text or "").encode().translate(FOLD).split()


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """The stored index: per block its postings, and the ids, carried columns and word counts of its documents.

    Null and empty texts have no postings but are listed. Rows that repeat are
    listed once each. Written to the checkpoint folder.
    """
    kept = [id_col, *(c for c in carry if c != id_col)]
    source = docs.select(*kept, text_col)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for block in ch.gathered(batches, text_col, BLOCK_BYTES):
            split = [tokens(x) for x in block.column(text_col).to_pylist()]
            sizes = np.fromiter(map(len, split), np.int64, len(split))
            local: dict[bytes, int] = defaultdict()
            local.default_factory = local.__len__
            term = np.fromiter(map(local.__getitem__, chain.from_iterable(split)), np.int32, int(sizes.sum()))
            del split
            order = np.argsort(term, kind="stable").astype(np.int32)
            freq = np.bincount(term, minlength=len(local)).astype(np.uint32)
            row = pa.array([0, block.num_rows], pa.int32())
            listed = [
                pa.ListArray.from_arrays(row, block.column(c).combine_chunks()) for c in kept
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([packer.compress(b" ".join(local))], pa.binary()),
                    pa.array([ch.squeeze(freq)], pa.binary()),
                    pa.array([ch.squeeze(np.diff(order, prepend=np.int32(0)))], pa.binary()),
                    *listed,
                    pa.ListArray.from_arrays(row, pa.array(sizes)),
                ],
                ["block", "terms", "freqs", "positions", *kept, "n_words"],
            )
            del term, order, freq, local
            ch.release()

    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            *(T.StructField(x, T.BinaryType()) for x in ("terms", "freqs", "positions")),
            *(T.StructField(c, T.ArrayType(source.schema[c].dataType)) for c in kept),
            T.StructField("n_words", T.ArrayType(T.LongType())),
        ]
    )
    return materialize(source.mapInArrow(index, schema), "postings")


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(words, items): every distinct window and the items that have it; shorter items are one window."""
    source = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                w = tokens(text)
                found += [
                    (item, b" ".join(w[i : i + size]).decode())
                    for i in range(max(1, len(w) - size + 1) if w else 0)
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())],
                ["item", "words"],
            )

    return source.mapInArrow(cut, "item string, words string").groupBy("words").agg(
        F.sort_array(F.collect_set("item")).alias("items")
    )


class Shard:
    """A bounded set of windows, with their words as numbers."""

    def __init__(self, rows: Sequence[tuple[str, Sequence[str]]]):
        vocabulary: dict[bytes, int] = {}
        self.items = [list(items) for _, items in rows]
        split = [w.encode().split() for w, _ in rows]
        self.length = np.fromiter(map(len, split), np.int64, len(split))
        self.words = np.full((len(split), max(self.length, default=0)), -1, np.int64)
        for i, ws in enumerate(split):
            self.words[i, : len(ws)] = [vocabulary.setdefault(w, len(vocabulary)) for w in ws]
        self.vocabulary = vocabulary


def _lists(row: dict, shard: Shard) -> list[np.ndarray | None]:
    """The posting lists of the shard's words in one block."""
    unpack = zstandard.ZstdDecompressor()
    terms = unpack.decompress(row["terms"]).split(b" ")
    freqs = ch.expand(row["freqs"], "<u4").astype(np.int64)
    if len(freqs) == 0:
        return [None] * len(shard.vocabulary)
    ends = np.cumsum(freqs)
    order = np.cumsum(ch.expand(row["positions"], "<i4").astype(np.int64))
    out: list[np.ndarray | None] = [None] * len(shard.vocabulary)
    get = shard.vocabulary.get
    for i, term in enumerate(terms):
        at = get(term)
        if at is not None:
            out[at] = order[ends[i] - freqs[i] : ends[i]]
    return out


def _present(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_list, values)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == values


def phrase_starts(words: np.ndarray, lists: list, freq: np.ndarray) -> np.ndarray:
    """Where the words stand one after the other: lists intersected from the rarest on."""
    order = np.argsort(freq[words], kind="stable")
    starts = lists[words[order[0]]] - order[0]
    for place in order[1:]:
        if len(starts) == 0:
            break
        starts = starts[_present(starts + place, lists[words[place]])]
    return starts


def near_spans(
    words: np.ndarray, lists: list, doc: np.ndarray, span: int, shared: np.ndarray, stretch: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where all words stand within ``span`` of an occurrence of one of them, in its document.

    ``doc`` are the starts of the documents and the end of the last; ``shared``
    are the stretches, ``stretch`` places long, that may hold such an occurrence.
    The place of a word is the nearest one, the earlier of two.
    """
    distinct = np.unique(words)
    found = [np.zeros((2, 0), np.int64)]
    for at in range(0, len(shared), STRETCHES):
        mine = shared[at : at + STRETCHES]
        begin, end = _runs_around(mine, stretch)
        place, word = [], []
        for row, w in enumerate(distinct):
            low, high = np.searchsorted(lists[w], begin), np.searchsorted(lists[w], end)
            place += [lists[w][a:b] for a, b in zip(low, high) if b > a]
            word += [np.full(b - a, row) for a, b in zip(low, high) if b > a]
        place, word = np.concatenate(place).astype(np.int64), np.concatenate(word)
        order = np.argsort(place)
        place, word = place[order], word[order]
        own = np.searchsorted(doc, place, "right") - 1
        is_word = word == np.arange(len(distinct))[:, None]
        before = np.maximum.accumulate(np.where(is_word, place, -1), axis=1)
        after = np.minimum.accumulate(np.where(is_word, place, FAR)[:, ::-1], axis=1)[:, ::-1]
        to_left = np.where(before >= doc[own], place - before, FAR)
        to_right = np.where(after < doc[own + 1], after - place, FAR)
        fine = (np.minimum(to_left, to_right) <= span).all(axis=0)
        fine &= np.isin(place // stretch, mine)
        nearest = np.where(to_left <= to_right, before, after)[:, fine]
        if nearest.shape[1]:
            found.append(np.stack([nearest.min(axis=0), nearest.max(axis=0)]))
    low, high = np.unique(np.concatenate(found, axis=1), axis=1)
    return low, high + 1


def _runs_around(shared: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of rising stretches and their neighbours, as ranges that do not touch."""
    new = np.ones(len(shared), bool)
    new[1:] = np.diff(shared) > 2
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(shared) - 1)
    return (shared[first] - 1) * stretch, (shared[last] + 2) * stretch


def shared_stretches(words: np.ndarray, lists: list, n: int, stretch: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of ``words`` (-1 behind their end) with the stretches around which all their words stand.

    The ``n`` places are cut into stretches. Words within a stretch's length of a
    place stand in its stretch or the next on either side, so with a bit per
    word and stretch, spread to the neighbours, no match is passed over.
    """
    stretches = n // stretch + 1
    step = max(1, TABLE_BYTES // (stretches * max(1, words.shape[1])))
    for at in range(0, len(words), step):
        distinct, number = np.unique(words[at : at + step], return_inverse=True)
        number = number.reshape(-1, words.shape[1])
        there = np.zeros((len(distinct), stretches), bool)
        for row, word in enumerate(distinct):
            if word < 0:
                there[row] = True
                continue
            own = lists[word] // stretch
            there[row, own] = True
            there[row, own[own > 0] - 1] = True
            there[row, own[own < stretches - 1] + 1] = True
        bits = np.packbits(there, axis=1)
        common = bits[number[:, 0]]
        for column in number.T[1:]:
            common &= bits[column]
        for row in np.flatnonzero(common.any(axis=1)):
            yield at + row, np.flatnonzero(np.unpackbits(common[row], count=stretches))


def search(index: DataFrame, shard: Shard, slop: int | None = None) -> DataFrame:
    """(block, row, kind, start, length, items): matches of the shard's windows; ``row`` counts in the block."""
    shared = index.sparkSession.sparkContext.broadcast(shard)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                found: list[tuple] = []
                doc_start = np.cumsum([0, *row["n_words"]])
                lists = _lists(row, mine)
                freq = np.array([0 if x is None else len(x) for x in lists] + [1], np.int64)
                known = np.flatnonzero((freq[mine.words] > 0).all(axis=1))
                spans = []
                for i in known:
                    n = int(mine.length[i])
                    starts = phrase_starts(mine.words[i, :n], lists, freq)
                    spans.append((i, "phrase", starts, starts + n))
                if slop is not None and len(known):
                    stretch = int(mine.length.max()) + slop
                    for at, around in shared_stretches(mine.words[known], lists, int(doc_start[-1]), stretch):
                        i = known[at]
                        n = int(mine.length[i])
                        spans.append((i, "near", *near_spans(mine.words[i, :n], lists, doc_start, n + slop, around, stretch)))
                for i, kind, a, b in spans:
                    at = np.searchsorted(doc_start, a, "right") - 1
                    inside = b <= doc_start[at + 1]
                    for r, s, e in zip(at[inside], a[inside], b[inside]):
                        found.append((row["block"], int(r), kind, int(s - doc_start[r]), int(e - s), mine.items[i]))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(MATCH.names, x)) for x in found], schema=MATCH
                )
                ch.release()

    return index.select("block", "terms", "freqs", "positions", "n_words").mapInArrow(
        match, "block string, row int, kind string, start long, length long, items array<string>"
    )


MATCH = pa.schema(
    [
        ("block", pa.string()),
        ("row", pa.int32()),
        ("kind", pa.string()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("items", pa.list_(pa.string())),
    ]
)


def find_matches(
    index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = 10, slop: int | None = None
) -> DataFrame:
    """All matches of all windows of ``items`` in an index; ``slop`` adds proximity matches.

    The windows are the stated query set: they go over the index in shards of
    ``SHARD_WINDOWS``, each sent to the tasks, so no size of benchmark is cut
    off. An empty benchmark gives no row.
    """
    spark = index.sparkSession
    windows = materialize(benchmark_windows(items, item_col, text_col, size), "windows")
    n = windows.count()
    shards = max(1, -(-n // SHARD_WINDOWS))
    found = None
    for i in range(shards):
        mine = windows.where(F.pmod(F.xxhash64("words"), F.lit(shards)) == i)
        part = search(index, Shard([(r.words, r["items"]) for r in mine.collect()]), slop)
        found = part if found is None else found.union(part)
    return found


def contamination_report(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    carry: Sequence[str] = (),
    slop: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its words, hit words, the items found and whether any was.

    A window is ``size`` consecutive words of an item, or a shorter item as a
    whole; a document word inside an occurrence of one is hit. Items are named
    by their id as text; repeated items count once, items without words never
    match. Documents without words (null included) are listed with zeros.

    ``slop`` adds ``near_items``: the items with a window whose words all stand, in
    any order, within its length plus ``slop`` words of one of them. It holds the
    items found exactly and does not change the other columns.
    """
    index = build_index(docs, id_col, text_col, carry)
    exact = F.col("kind") == "phrase"

    def items_where(kind: Column) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(kind, F.col("items"))))))

    span = F.struct("start", (F.col("start") + F.col("length")).alias("end"))
    per_row = (
        find_matches(index, items, item_col, item_text_col, size, slop)
        .groupBy("block", "row")
        .agg(
            F.array_sort(F.collect_set(F.when(exact, span))).alias("spans"),
            items_where(exact).alias("found"),
            items_where(~exact).alias("near"),
        )
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    n_hit = F.aggregate(
        "spans",
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
    )["n"]
    kept = [id_col, *(c for c in carry if c != id_col)]
    listed = index.select("block", F.posexplode(F.arrays_zip(*kept, "n_words")).alias("row", "d")).select(
        "block", "row", *(F.col(f"d.{c}").alias(c) for c in [*kept, "n_words"])
    )
    none = F.array().cast("array<string>")
    found = F.coalesce("found", none)
    near = [] if slop is None else [F.coalesce("near", none).alias("near_items")]
    return listed.join(per_row, ["block", "row"], "left").select(
        *kept,
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
        F.coalesce(F.size("spans") > 0, F.lit(False)).alias("contaminated"),
        found.alias("items"),
        *near,
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 10) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    Rows are matched by a 128-bit hash of id and text, so null and repeated ids are fine.
    """
    keys = [
        F.xxhash64(id_col, text_col).alias("__k1"),
        F.xxhash64(F.lit(7), F.col(id_col), F.col(text_col)).alias("__k2"),
    ]
    keyed = docs.select("*", *keys)
    report = contamination_report(keyed, items, id_col, text_col, size=size, carry=["__k1", "__k2"])
    bad = materialize(report.where("contaminated").select("__k1", "__k2").distinct(), "contaminated")
    return keyed.join(broadcast_if_small(bad), ["__k1", "__k2"], "left_anti").select(*docs.columns)
