"""Similarity join of word-shingle sets by count vectors in R-trees.

A set's shingles are hashed into groups; the counts by group are a point, and
two sets share at most the sum of the smaller counts. An R-tree over the points
of all sets would prune by size only, as random counts fill its boxes, so sets are
first dealt to cells where similar ones are sure to meet, and the trees stand in
the cells.

Cells: sets that are similar enough differ in at most d shingles. Cut into more
than d groups that hold a shingle, they agree on one group as a whole. A cell is the content of
a group; a set enters those of its d + 1 groups with the smallest hashes, for its
size class and, where the smaller partner may be of the class below, for that one.
The first group that two similar sets share is among these for both. A set with
too few groups that hold a shingle enters all of them and the cells of its d + 1
smallest shingles too, where it meets its like. Most cells have one set, which a
pass of sorted keys per block and range finds without moving any text.

In the cells of two sets and more, points go into a tree. First each set seeks its
best partner among the first points of its three lowest cells; the pairs are
verified, and what is linked is one component. Then the cells that still hold two
components are searched whole, all pairs the bound leaves are verified, and the
links closed to components.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skylattice.llm import blocks as bl
from skylattice.llm import chunks as ch
from skylattice.llm.components import components
from skylattice.llm.count_tree import FAN, CountTree, counts_by_group, enough, packed_point, unpacked_points
from skylattice.llm.substring_dedup import _distinct, _rows, _split, _verdicts
from skylattice.session import broadcast_if_small, materialize

U64 = np.uint64
GROUPS = 256
BLOCK_BYTES = 8 << 20
#: Lowest crowded cells in which a set seeks its first partner, and the points it is compared with in each.
LEADS = 3
PIVOTS = 32
#: Sets of a cell that one task compares with each other.
PIECE = 4096
#: Lowest searched cells of a set that tell whether a pair is met in an earlier one.
LOWEST = 32
#: Pairs whose lowest cells are compared at once.
MEETINGS = 4096
#: Cells in one hash range.
RANGE_CELLS = 1 << 21


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted inside a text, and where each text's begin.

    ASCII letters are lower-cased; a text of fewer words is one shingle.
    """
    n = len(offsets) - 1
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    starts, ends, doc = ch.words(data, offsets)
    hashed = ch.span_hashes(data, starts, ends)
    first = ch.windows(doc, size)
    tokens, owner = [ch.run_hashes(hashed, first, size)], [doc[first]]
    words = np.bincount(doc, minlength=n)
    begin = np.cumsum(words) - words
    for few in range(1, size):
        short = np.flatnonzero(words == few)
        tokens.append(ch.run_hashes(hashed, begin[short], few))
        owner.append(short)
    token, doc = np.concatenate(tokens), np.concatenate(owner)
    order = np.lexsort((token, doc))
    token, doc = token[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    token, doc = token[new], doc[new]
    return token, np.searchsorted(doc, np.arange(n + 1))


def class_bounds(largest: int, percent: int) -> np.ndarray:
    """Smallest sizes of the size classes; partners are of one class or two neighbouring ones."""
    ratio = max(1.5, 125 / percent)
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out, np.int64)


def most_differing(a, b, percent: int):
    """The most elements in which sets of sizes ``a`` and ``b`` differ if they are similar enough."""
    return (a + b) * (100 - percent) // (100 + percent)


def cells_of(token: np.ndarray, begin: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells that every set enters, and the set of each; rising by set, distinct in a set."""
    size = np.diff(begin)
    bounds = class_bounds(int(size.max(initial=1)) * 100 // percent + 1, percent)
    own = np.searchsorted(bounds, size, "right") - 1
    found, owners = [], []
    for below in (0, 1):
        cls = own - below
        high = bounds[np.maximum(cls + 1, 0)] - 1  # the largest set of the class
        partner = size * 100 // percent if below == 0 else high
        use = np.flatnonzero((size > 0) & (cls >= 0) & (size * percent <= 100 * high))
        if len(use) == 0:
            continue
        differ = most_differing(size, partner, percent)[use]
        widest = most_differing(high, high * 100 // percent, percent)[use]
        groups = (115 * (widest + 1) // 100) + 2
        seed = ch.mix(cls[use].astype(U64) + U64(0x51ED))
        many = size[use]
        row = np.repeat(np.arange(len(use)), many)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[use], many)
        mixed = ch.mix(token[at] ^ seed[row])
        first = np.cumsum(groups) - groups
        group = first[row] + ((mixed >> U64(11)) % groups[row].astype(U64)).astype(np.int64)
        content = np.zeros(int(groups.sum()), U64)
        np.add.at(content, group, ch.mix(mixed + ch.GOLDEN))
        held = np.flatnonzero(np.bincount(group, minlength=len(content)))
        which = np.searchsorted(first, held, "right") - 1
        cell = ch.mix(ch.mix(content[held] + (held - first[which]).astype(U64)) ^ seed[which])
        order = np.lexsort((cell, which))
        cell, which = cell[order], which[order]
        n_held = np.bincount(which, minlength=len(use))
        place = np.arange(len(which)) - np.repeat(np.cumsum(n_held) - n_held, n_held)
        keep = place <= differ[which]
        found.append(cell[keep])
        owners.append(use[which[keep]])
        few = n_held <= differ
        if few.any():  # too few groups hold a shingle: the smallest shingles themselves
            inside = few[row]
            lone, lone_row = ch.mix(mixed[inside] + U64(1)), row[inside]
            order = np.lexsort((lone, lone_row))
            lone, lone_row = lone[order], lone_row[order]
            held_by = np.bincount(lone_row, minlength=len(use))
            place = np.arange(len(lone)) - (np.cumsum(held_by) - held_by)[lone_row]
            keep = place <= differ[lone_row]
            found.append(lone[keep])
            owners.append(use[lone_row[keep]])
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    cell, owner = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((cell, owner))
    return cell[order], owner[order]


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text, __t1, __t2): texts are the same if 128 bits and their length are."""
    return docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).select(
        "*",
        F.xxhash64("__text").alias("__t1"),
        F.xxhash64(F.lit(7), F.col("__text"), F.octet_length("__text")).alias("__t2"),
    )


def _firsts(marked: DataFrame) -> DataFrame:
    """``marked`` with ``__later``: whether a smaller id has the very same text."""
    copied = materialize(
        marked.groupBy("__t1", "__t2")
        .agg(F.min("__id").alias("__low"), F.count(F.lit(1)).alias("__copies"))
        .where("__copies > 1")
        .drop("__copies"),
        "copies",
    )
    joined = marked.join(
        broadcast_if_small(copied.withColumn("__copied", F.lit(True))), ["__t1", "__t2"], "left"
    )
    later = F.coalesce("__copied", F.lit(False)) & ~F.col("__id").eqNullSafe(F.col("__low"))
    return joined.select("__id", "__text", "__t1", "__t2", later.alias("__later"))


def _pack(rows: DataFrame, size: int, percent: int, block_bytes: int) -> DataFrame:
    """Stored blocks: the sizes of all rows' sets, and the cells of each text's first row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId() << 40
        for table in ch.gathered(batches, "__text", block_bytes):
            ids, t1, t2 = (table.column(c).combine_chunks() for c in ("__id", "__t1", "__t2"))
            later = table.column("__later").to_numpy()
            rows_n = table.num_rows
            n_tokens, many, cells = np.zeros(rows_n, np.int64), np.zeros(rows_n, np.int64), []
            seen: set[tuple[int, int]] = set()
            first = ~later
            for i in np.flatnonzero(first).tolist():  # rows that repeat id and text
                key = (t1[i].as_py(), t2[i].as_py())
                first[i] = key not in seen
                seen.add(key)
            at = 0
            for part in table.to_batches():
                for piece in ch.chunked(part, "__text", 1 << 20):
                    data, offsets = ch.text_bytes(piece.column(piece.schema.get_field_index("__text")))
                    token, begin = shingle_sets(data, offsets, size)
                    span = slice(at, at + piece.num_rows)
                    n_tokens[span] = np.diff(begin)
                    stored = np.flatnonzero(first[span])
                    if len(stored):
                        length = np.diff(begin)[stored]
                        sub = np.concatenate([token[begin[i] : begin[i + 1]] for i in stored.tolist()])
                        cell, owner = cells_of(sub, np.concatenate([[0], np.cumsum(length)]), percent)
                        many[at + stored] = np.bincount(owner, minlength=len(stored))
                        cells.append(cell)
                    at += piece.num_rows
            flat = np.concatenate(cells) if cells else np.zeros(0, U64)
            one = pa.array([0, rows_n], pa.int32())
            listed = lambda x: pa.ListArray.from_arrays(one, x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([node]),
                    listed(ids),
                    listed(t1),
                    listed(t2),
                    listed(pa.array(n_tokens)),
                    listed(pa.array(many)),
                    pa.array([len(flat)]),
                    pa.array([flat.tobytes()], pa.binary()),
                ],
                ["block", "base", "ids", "t1", "t2", "sizes", "many", "total", "cells"],
            )
            node += rows_n
            ch.release()

    kind = rows.schema["__id"].dataType.simpleString()
    long = "array<long>"
    return materialize(
        rows.mapInArrow(
            pack,
            f"block string, base long, ids array<{kind}>, t1 {long}, t2 {long}, sizes {long}, many {long}, total long, cells binary",
        ),
        "blocks",
    )


def _crowded(blocks: DataFrame) -> DataFrame:
    """(cell, node, size, lead, t1, t2): the cells with two sets and more, a row per set.

    ``lead`` numbers a set's lowest such cells from 0, -1 for the others; the text's
    hash stands in the first.
    """
    total = blocks.agg(F.sum("total")).first()[0] or 0
    key_bits = max(0, (max(1, total // RANGE_CELLS) - 1).bit_length())

    def split(keys: np.ndarray) -> list[tuple[int, slice]]:
        return list(_split(keys, 64 - key_bits)) if key_bits else [(0, slice(0, len(keys)))] * bool(len(keys))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, twice = _distinct(np.frombuffer(row["cells"], U64))
                out = [(p, row["block"], bl.sorted_bytes(keys[w]), bl.bits(twice[w])) for p, w in split(keys)]
                yield _rows(out, ["part", "block", "keys", "multi"], [pa.int64(), pa.string(), pa.binary(), pa.binary()])

    def members(key, table: pa.Table, found: pa.Table) -> pa.Table:
        masks = dict(zip(found.column("part").to_pylist(), found.column("mask").to_pylist()))
        out = []
        for row in bl.rows_of(table):
            cells = np.frombuffer(row["cells"], U64)
            keys, _ = _distinct(cells)
            hit = np.zeros(len(keys), bool)
            for part, where in split(keys):
                if part in masks:
                    hit[where] = bl.mask_of(masks[part], where.stop - where.start)
            at = np.repeat(np.arange(len(row["many"])), row["many"])
            keep = hit[np.searchsorted(keys, cells)]
            cells, at = cells[keep], at[keep]
            # the cells of a set rise, so its first ones are its lowest
            count = np.bincount(at, minlength=len(row["many"]))
            place = np.arange(len(at)) - (np.cumsum(count) - count)[at]
            lead = np.where(place < LEADS, place, -1)
            head = lead == 0
            hash_of = lambda name: pa.array(np.array(row[name], np.int64)[at], mask=~head)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells.view(np.int64)),
                        pa.array(row["base"] + at),
                        pa.array(np.array(row["sizes"], np.int64)[at]),
                        pa.array(lead.astype(np.int32)),
                        hash_of("t1"),
                        hash_of("t2"),
                    ],
                    names,
                )
            )
        return pa.Table.from_batches(out)

    names = ["cell", "node", "size", "lead", "t1", "t2"]
    masks = (
        blocks.select("block", "cells")
        .mapInArrow(sketch, "part long, block string, keys binary, multi binary")
        .groupBy("part")
        .applyInArrow(_verdicts("<u8"), "block string, part long, mask binary")
    )
    narrow = blocks.where("total > 0").select("block", "base", "t1", "t2", "sizes", "many", "cells")
    return materialize(
        narrow.groupBy("block")
        .cogroup(masks.groupBy("block"))
        .applyInArrow(members, "cell long, node long, size long, lead int, t1 long, t2 long"),
        "crowded",
    )


def _points(rows: DataFrame, crowded: DataFrame, size: int) -> DataFrame:
    """(node, point, tokens) of every set in ``crowded``: counts by group, and the sorted shingle hashes."""
    nodes = crowded.where("lead = 0").select("node", F.col("t1").alias("__t1"), F.col("t2").alias("__t2"))
    texts = rows.where(~F.col("__later")).join(broadcast_if_small(nodes), ["__t1", "__t2"]).select("node", "__text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in ch.chunked(batch, "__text", 1 << 20):
                token, begin = shingle_sets(*ch.text_bytes(piece.column(1)), size)
                sets = [token[a:b] for a, b in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array([packed_point(counts_by_group(s, GROUPS)) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["node", "point", "tokens"],
                )
            ch.release()

    points = materialize(texts.mapInArrow(compute, "node long, point binary, tokens binary"), "points")
    if points.groupBy("node").count().where("count > 1").limit(1).count():  # rows that repeat id and text
        points = materialize(points.dropDuplicates(["node"]), "points")
    return points


def _plain(column: pa.Array):
    return column if pa.types.is_list(column.type) else column.to_numpy()


def _by_cell(rows: DataFrame, keys: list[str], search, schema: str) -> DataFrame:
    """``search`` over the rows of one cell at a time, held in pieces as they come sorted."""
    names = [*keys, "node", "point"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(len(keys))]
            new = np.ones(batch.num_rows, bool)
            if batch.num_rows:
                new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                cell = tuple(c[a] for c in columns)
                node = batch.column(len(keys)).slice(a, b - a).to_numpy()
                extra = [_plain(batch.column(i).slice(a, b - a)) for i in range(len(names), batch.num_columns)]
                point = unpacked_points(batch.column(len(keys) + 1).slice(a, b - a).to_pylist(), GROUPS)
                yield from search(state, cell, node, point, *extra)
        yield from search(state, None, np.zeros(0, np.int64), np.zeros((0, GROUPS)), np.zeros(0, np.int64))

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, *(c for c in ("side", "node") if c in rows.columns and c not in keys)]
    extra = [c for c in rows.columns if c not in names]
    return rows.select(*names, *extra).repartition(parts, *keys).sortWithinPartitions(*order).mapInArrow(run, schema)


def _pairs(a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(bound)], ["a", "b", "bound"])


def _padded(lists: pa.Array, fill: int) -> np.ndarray:
    """Lists of at most ``LOWEST`` numbers as rows filled up with ``fill``."""
    count = lists.value_lengths().to_numpy()
    out = np.full((len(count), LOWEST), fill, np.int64)
    out[np.arange(LOWEST) < count[:, None]] = lists.flatten().to_numpy()
    return out


def _met_before(earlier: np.ndarray, others: np.ndarray, q: np.ndarray, p: np.ndarray, cell: int) -> np.ndarray:
    """Whether rows ``q`` of ``earlier`` and ``p`` of ``others`` share a number other than ``cell``, their filling."""
    out = np.zeros(len(q), bool)
    for a in range(0, len(q), MEETINGS):
        x, y = earlier[q[a : a + MEETINGS]], others[p[a : a + MEETINGS]]
        for i in range(LOWEST):
            out[a : a + MEETINGS] |= (x[:, i] != cell) & (y == x[:, i : i + 1]).any(axis=1)
    return out


def _first_partners(crowded: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """(a, b): for a set the partner of the highest bound among the first points of its lowest cells."""

    def search(state: dict, cell, node: np.ndarray, point: np.ndarray, *_) -> Iterator[pa.RecordBatch]:
        if state.get("cell") != cell:
            state.clear()
            state.update(cell=cell, nodes=np.zeros(0, np.int64), points=np.zeros((0, GROUPS), np.uint8), tree=None)
        if cell is None:
            return
        room = PIVOTS - len(state["nodes"])
        if room > 0:
            state["nodes"] = np.concatenate([state["nodes"], node[:room]])
            state["points"] = np.concatenate([state["points"], point[:room]])
            state["tree"] = CountTree(state["points"], percent)
        for q, p, bound in state["tree"].search(point):
            earlier = state["nodes"][p] < node[q]
            q, p, bound = q[earlier], p[earlier], bound[earlier]
            order = np.lexsort((-bound, q))
            best = np.ones(len(order), bool)
            best[1:] = q[order][1:] != q[order][:-1]
            q, p, bound = q[order][best], p[order][best], bound[order][best]
            yield _pairs(node[q], state["nodes"][p], bound)

    rows = crowded.where("lead >= 0").join(points.select("node", "point"), "node").select("cell", "node", "point")
    found = _by_cell(rows, ["cell"], search, "a long, b long, bound long")
    return found.groupBy("a").agg(F.max_by("b", F.struct("bound", "b")).alias("b"))


def _open_pairs(crowded: DataFrame, points: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of sets of different components that a cell and the bound leave.

    A cell with no more sets than a leaf has is compared as one. A cell of more
    than ``PIECE`` sets is cut into pieces, each pair of which is compared in a
    task of its own. Similar sets share most of their cells: a pair is named in the
    lowest searched cell that both have among their ``LOWEST`` lowest, and in no
    later one. Repeats are left where sets share only cells beyond those.
    """
    known = crowded.select("cell", "node").join(broadcast_if_small(roots), "node", "left")
    known = known.select("cell", "node", F.coalesce("root", "node").alias("root"))
    open_cells = (
        known.groupBy("cell")
        .agg(F.min("root").alias("__a"), F.max("root").alias("__b"), F.count(F.lit(1)).alias("__n"))
        .where("__a < __b")
        .select("cell", F.ceil(F.col("__n") / F.lit(float(PIECE))).cast("int").alias("pieces"), (F.col("__n") <= FAN).alias("leaf"))
    )
    rows = known.join(open_cells, "cell").withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    # a piece is a query (side 1) to the pieces up to its own, and a tree (side 0) for those from its own on
    side = lambda n: F.lit(n).cast("int").alias("side")
    leaves = rows.where("leaf").select("cell", "node", "root", "leaf", F.lit(0).alias("i"), F.lit(0).alias("j"), side(0))
    as_tree = rows.where("not leaf").select(
        "cell", "node", "root", "leaf", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("pieces") - 1)).alias("j"), side(0)
    )
    as_query = rows.where("not leaf").select(
        "cell", "node", "root", "leaf", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("i"), F.col("own").alias("j"), side(1)
    )
    lowest = (
        rows.where("not leaf")
        .groupBy("node")
        .agg(F.slice(F.sort_array(F.collect_list("cell")), 1, LOWEST).alias("lowest"))
    )
    sets = points.select("node", "point").join(lowest, "node", "left")
    earlier = F.when(~F.col("leaf"), F.filter("lowest", lambda c: c < F.col("cell"))).alias("earlier")
    dealt = materialize(
        leaves.unionByName(as_tree)
        .unionByName(as_query)
        .join(sets, "node")
        .select("cell", "node", "root", "leaf", "i", "j", "side", "point", earlier),
        "open",
    )

    def search(state: dict, cell, node: np.ndarray, point: np.ndarray, root=None, side=None, earlier=None) -> Iterator[pa.RecordBatch]:
        if state.get("cell") != cell:
            state.clear()
            state.update(cell=cell, nodes=[], points=[], roots=[], earlier=[], tree=None)
        if cell is None:
            return
        earlier = _padded(earlier, cell[0])
        of_tree = side == 0
        if of_tree.any():
            for name, values in (("nodes", node), ("points", point), ("roots", root), ("earlier", earlier)):
                state[name].append(values[of_tree])
        asks = ~of_tree
        if not asks.any() or not state["nodes"]:
            return
        if state["tree"] is None:  # rows come sorted, those of the tree first
            state["tree"] = CountTree(np.concatenate(state["points"]), percent)
            for name in ("nodes", "roots", "earlier"):
                state[name] = [np.concatenate(state[name])]
        node, point, root, earlier = node[asks], point[asks], root[asks], earlier[asks]
        nodes, roots = state["nodes"][0], state["roots"][0]
        for q, p, bound in state["tree"].search(point):
            apart = (nodes[p] < node[q]) & (roots[p] != root[q]) if cell[1] == cell[2] else roots[p] != root[q]
            q, p, bound = q[apart], p[apart], bound[apart]
            new = ~_met_before(earlier, state["earlier"][0], q, p, cell[0])
            q, p, bound = q[new], p[new], bound[new]
            yield _pairs(np.maximum(node[q], nodes[p]), np.minimum(node[q], nodes[p]), bound)

    def compare(cell: np.ndarray, node: np.ndarray, point: np.ndarray, root: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = point.sum(axis=1, dtype=np.int64)
        for shift in range(1, min(FAN, len(cell))):
            x = np.flatnonzero((cell[shift:] == cell[:-shift]) & (root[shift:] != root[:-shift]))
            y = x + shift
            alike = percent * np.maximum(size[x], size[y]) <= 100 * np.minimum(size[x], size[y])
            x, y = x[alike], y[alike]
            bound = np.minimum(point[x], point[y]).sum(axis=1, dtype=np.int64)
            fits = enough(bound, size[x], size[y], percent)
            x, y, bound = x[fits], y[fits], bound[fits]
            yield _pairs(np.maximum(node[x], node[y]), np.minimum(node[x], node[y]), bound)

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            cell = table.column("cell").to_numpy()
            upto = int(np.searchsorted(cell, cell[-1], "left")) if len(cell) else 0
            held = table.slice(upto)  # the last cell may go on in the next batch
            yield from compare(*unpacked(table.slice(0, upto)))
        if held is not None:
            yield from compare(*unpacked(held))

    def unpacked(table: pa.Table) -> tuple:
        cell, node, root = (table.column(c).to_numpy() for c in ("cell", "node", "root"))
        return cell, node, unpacked_points(table.column("point").to_pylist(), GROUPS), root

    schema = "a long, b long, bound long"
    parts = int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_leaves = dealt.where("leaf").select("cell", "node", "point", "root")
    in_leaves = in_leaves.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(small, schema)
    in_trees = _by_cell(
        dealt.where("not leaf").select("cell", "i", "j", "node", "point", "root", "side", "earlier"), ["cell", "i", "j"], search, schema
    )
    return in_leaves.unionByName(in_trees).select("a", "b")


def _verified(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, by their shingles."""
    named = materialize(pairs, "pairs")
    nodes = named.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = points.select("node", "tokens").join(broadcast_if_small(nodes), "node", "left_semi")
    both = named.join(sets.withColumnsRenamed({"node": "a", "tokens": "x"}), "a").join(
        sets.withColumnsRenamed({"node": "b", "tokens": "y"}), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                s, t = np.frombuffer(x[i].as_buffer(), U64), np.frombuffer(y[i].as_buffer(), U64)
                if len(s) > len(t):
                    s, t = t, s
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum()) if len(t) else 0
                keep[i] = common > 0 and 100 * common >= percent * (len(s) + len(t) - common)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Words are maximal runs of anything but ASCII white space, ASCII letters are
    lower-cased. A row's set is its distinct shingles of ``shingle`` words, or
    the whole sequence where it has fewer; sets link if 100 * intersection >=
    ``percent`` * union. component_id is the smallest id reachable over links,
    the row's own included; shingles are compared by 64 bits. Null, empty and
    wordless texts have no set and link with nothing, not even each other. Rows
    that repeat a text share its set; a null id is passed over when the smallest
    is taken, and where there is no other, component_id is null. Other columns
    are not read; an empty table gives no row. A text is read whole, and a worker
    holds about 60 bytes per byte of the longest one.

    No link is lost: see the module for why similar sets meet in a cell. Copies
    of a text meet by 128 bits first and enter the cells once; a cell is named
    once per block, and one of any number of sets is compared in pieces.
    """
    rows = _firsts(_marked(docs, id_col, text_col))
    blocks = _pack(rows, shingle, percent, block_bytes)
    crowded = _crowded(blocks)
    points = _points(rows, crowded, shingle)
    links = materialize(_verified(_first_partners(crowded, points, percent), points, percent), "links")
    roots = components(links)
    rest = _verified(_open_pairs(crowded, points, roots, percent).distinct(), points, percent)
    roots = components(materialize(links.unionByName(rest), "links"))
    return _with_components(blocks, crowded, roots, id_col)


def _with_components(blocks: DataFrame, crowded: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    """Every row of the blocks with the smallest id of its component."""
    listed = blocks.select(F.explode(F.arrays_zip("ids", "t1", "t2", "sizes")).alias("x")).select(
        F.col("x.ids").alias("__id"), F.col("x.t1").alias("t1"), F.col("x.t2").alias("t2"), F.col("x.sizes").alias("n_shingles")
    )
    by_text = (
        listed.where("n_shingles > 0")
        .groupBy("t1", "t2")
        .agg(F.min("__id").alias("__low"), F.count(F.lit(1)).alias("__copies"))
    )
    linked = (
        crowded.where("lead = 0")
        .join(broadcast_if_small(roots), "node")
        .groupBy("t1", "t2")
        .agg(F.min("root").alias("root"))
    )
    grouped = by_text.join(broadcast_if_small(linked), ["t1", "t2"], "left")
    smallest = grouped.where("root is not null").groupBy("root").agg(F.min("__low").alias("__least"))
    changed = (
        grouped.where("root is not null or __copies > 1")
        .join(broadcast_if_small(smallest), "root", "left")
        .select("t1", "t2", F.coalesce("__least", "__low").alias("__component"))
    )
    return listed.join(broadcast_if_small(materialize(changed, "changed")), ["t1", "t2"], "left").select(
        F.col("__id").alias(id_col),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("__component", "__id")).otherwise(F.col("__id")).alias("component_id"),
    )
