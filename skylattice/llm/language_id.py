"""Language identification by cross-parsing entropy.

For each language the whole texts of a bounded number of labelled documents are
turned into a suffix automaton, kept as a hash table of its edges, so that its
size follows the reference and not the alphabet. A text is parsed against every automaton into
phrases, each the longest match with the reference. The fewer phrases, the more
alike the two; phrase counts are normalised by the reference length, whose
logarithm is what a phrase costs, and the language with the least cost wins.

Whole batches of texts, cut into segments, step through all automata at once. No character is left out; a phrase ends where a
segment ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from skylattice.llm import chunks as ch

UNKNOWN = "und"
SEGMENT = 1024


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@dataclass(frozen=True)
class Bounds:
    """How many labelled rows a model learns from, whatever the corpus.

    Per language ``documents`` rows are drawn by a hash of their id, first from
    those of at most ``points`` code points, then the next longer ones; each
    teaches with its whole text. Of more than ``languages`` labels the most
    frequent ones are learned.
    """

    documents: int = 24
    points: int = 8_000
    languages: int = 200


def folded(text: str) -> str:
    """Lower-cased letters, with every run of other characters as one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return points[keep].astype("<u4").tobytes().decode("utf-32-le")


def automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The edges (from, symbol, to) of the suffix automaton of ``symbols``, and its number of states."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] != length[p] + 1:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        last = new
    sizes = np.fromiter(map(len, step), np.int64, len(step))
    source = np.repeat(np.arange(len(step)), sizes)
    symbol = np.fromiter((c for out in step for c in out), np.int64, int(sizes.sum()))
    target = np.fromiter((t for out in step for t in out.values()), np.int64, int(sizes.sum()))
    return source, symbol, target, len(step)


class Edges:
    """A hash table from (state, symbol) to the next state, 24 bytes an edge at most."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray, targets: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, self.EMPTY, np.uint64)
        self.targets = np.full(size, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == self.EMPTY
            claimed, first = np.unique(at[free], return_index=True)
            row = left[free][first]
            self.keys[claimed], self.targets[claimed] = keys[row], targets[row]
            waiting = np.ones(len(left), bool)
            waiting[np.flatnonzero(free)[first]] = False
            left, at = left[waiting], (at[waiting] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (ch.mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is no edge."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.targets[at], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != self.EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            held, wanted = self.keys[at[left]], keys[left]
            out[left] = np.where(held == wanted, self.targets[at[left]], np.int32(-1))
            left = left[(held != wanted) & (held != self.EMPTY)]
        return out

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.targets.nbytes


class Model:
    """The automata of all languages as one table of edges; states are numbered through."""

    def __init__(self, references: dict[str, str]):
        self.languages = sorted(references)
        alphabet = sorted(set("".join(references.values())))
        self.other = len(alphabet)
        self.width = len(alphabet) + 1
        self.classes = np.full(0x110000, self.other, np.int32)
        self.classes[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        keys, targets, base, self.roots = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], 0, []
        #: where a phrase begins, per language and symbol; -1 for a symbol the language has not
        self.begin = np.full((len(self.languages), self.width), -1, np.int32)
        for i, name in enumerate(self.languages):
            source, symbol, target, states = automaton(self.classes[[ord(c) for c in references[name]]].tolist())
            keys.append(((source + base) * self.width + symbol).astype(np.uint64))
            targets.append((target + base).astype(np.int32))
            self.begin[i, symbol[source == 0]] = target[source == 0] + base
            self.roots.append(base)
            base += states
        self.edges = Edges(np.concatenate(keys), np.concatenate(targets))
        self.cost = np.array([math.log2(max(2, len(references[x]))) for x in self.languages])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts, one row per language and one column per text; texts are folded."""
        sizes = np.array([len(x) for x in texts], np.int64)
        parts = -(-sizes // SEGMENT)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        out = np.zeros((len(self.languages), len(texts)), np.int64)
        owner = np.repeat(np.arange(len(texts)), parts)
        if len(owner) == 0 or not self.languages:
            return out
        first = np.repeat(np.cumsum(sizes) - sizes, parts) + SEGMENT * (
            np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        )
        filled = np.minimum(SEGMENT, np.repeat(np.cumsum(sizes), parts) - first)
        order = np.argsort(-filled, kind="stable")  # so that finished segments are at the end
        first, filled, owner = first[order], filled[order], owner[order]
        symbols = self.classes[points]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        count = np.zeros(state.shape, np.int64)
        for i in range(int(filled[0])):
            live = int(np.searchsorted(-filled, -i, "left"))
            symbol = symbols[first[:live] + i]
            now = state[:, :live]
            to = self.edges.find((now * self.width + symbol).astype(np.uint64).ravel()).reshape(now.shape)
            lang, where = np.nonzero(to < 0)
            again = self.begin[lang, symbol[where]]  # the phrase so far ends, the symbol begins the next
            count[lang, where] += (now[lang, where] != roots[lang, 0]).astype(np.int64) + (again < 0)
            to[lang, where] = np.where(again < 0, roots[lang, 0], again)
            state[:, :live] = to
        count += state != roots
        for row, found in zip(out, count):
            row += np.bincount(owner, found, len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language and its share of the inverse costs, for every text."""
        short = [folded(x) for x in texts]
        cost = self.phrases(short) * self.cost[:, None]
        names = [UNKNOWN] * len(texts)
        score = np.zeros(len(texts))
        if self.languages:
            inverse = 1.0 / np.maximum(cost, 1.0) ** 4
            best = np.argmin(cost, axis=0)
            share = inverse[best, np.arange(len(texts))] / inverse.sum(axis=0)
            for i, x in enumerate(short):
                if x.strip():
                    names[i], score[i] = self.languages[best[i]], share[i]
        return names, score


@lru_cache(maxsize=1)
def _model(references: tuple[tuple[str, str], ...]) -> Model:
    return Model(dict(references))


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bounds: Bounds = Bounds()) -> dict[str, str]:
    """Reference text per language: the whole folded texts of a bounded number of labelled rows.

    Which rows are drawn is decided over ids, labels and lengths; then the texts
    are read of those only. Rows without language or letters teach nothing, a row
    that repeats teaches once.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    frequent = labelled.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(bounds.languages)
    size = F.greatest(F.length(text_col), F.lit(bounds.points))
    place = Window.partitionBy(lang_col).orderBy("__size", "__hash", id_col)
    drawn = (
        labelled.select(id_col, lang_col, size.alias("__size"), F.xxhash64(id_col).alias("__hash"))
        .withColumn("__place", F.row_number().over(place))
        .where(F.col("__place") <= bounds.documents)
        .join(F.broadcast(frequent.select(lang_col)), lang_col, "left_semi")  # bounds.languages rows
    )
    rows = (
        labelled.select(id_col, lang_col, F.col(text_col).alias("__text"))
        .join(F.broadcast(drawn), [id_col, lang_col])  # bounds.documents rows per language
        .select(lang_col, "__place", "__text")
        .collect()
    )
    drawn_texts = sorted({(r[lang_col], r["__place"], r["__text"]) for r in rows})
    texts: dict[str, dict[str, None]] = {}
    for lang, _, text in drawn_texts:
        texts.setdefault(lang, {})[folded(text)] = None
    return {lang: " ".join(found) for lang, found in texts.items()}


def predict(docs: DataFrame, references: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``, from the whole text alone.

    Null texts, and texts without a letter, are ``und`` with score 0; so is all
    text if no language was learned. Of equal costs the first name wins. The
    score is the winner's share of the inverse costs, between 0 and 1.
    """
    source = docs.select(id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(references.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for batch in batches:
            for part in ch.chunked(batch, text_col, 4 << 20):
                names, score = model.predict([x or "" for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score)], [id_col, "lang_pred", "score"]
                )

    id_type = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bounds: Bounds = Bounds()) -> DataFrame:
    """Learn from all folds but one and predict every row: (id, held_out, lang_pred, score)."""
    references = learn(docs.where(remainder(id_col, folds) != held_out), id_col, text_col, lang_col, bounds)
    return predict(docs, references, id_col, text_col).select(
        id_col, (remainder(id_col, folds) == held_out).alias("held_out"), "lang_pred", "score"
    )
