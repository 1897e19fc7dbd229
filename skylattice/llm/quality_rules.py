"""Quality rules with compression bands.

A text is compressed as a whole and in fixed chunks. Text that repeats itself
compresses too well, random characters too little; what is usual depends on the
length, since a short text has no past to refer to, so each length class has its
own band. Counts of words, symbols, repeated lines and repeated word windows
give the base rule.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from skylattice.llm import chunks as ch

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Band:
    """Texts of at most ``up_to`` bytes (None: any) need ``low <= raw / compressed <= high``."""

    up_to: int | None
    low: float
    high: float


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; the bands are in rising order of length.

    A chunk is ``chunk_bytes`` of the text, the last one shorter. It is judged by
    the band of its own length if it has ``least_chunk`` bytes or more; a text
    fails when more than ``bad_share`` of the judged chunks fail.

    The lower limits lie between random printable, base64 or CJK text (at most 1.24
    at 512 to 768 bytes, 1.38 from 2 KB on) and prose (1.24 and 1.56 or more). Below
    384 bytes the two overlap, so there the limits are those of prose and some
    noise passes; up to 128 bytes zstandard tells nothing.
    """

    least_words: int = 20
    window: int = 8
    repeat_percent: int = 30
    chunk_bytes: int = 4096
    least_chunk: int = 512
    bad_share: float = 0.2
    level: int = 3
    document_bands: Sequence[Band] = (
        Band(128, 0.80, 2.2),
        Band(192, 0.95, 2.2),
        Band(256, 1.02, 2.2),
        Band(384, 1.10, 2.8),
        Band(512, 1.20, 2.8),
        Band(768, 1.25, 2.8),
        Band(1024, 1.32, 2.8),
        Band(2048, 1.37, 3.5),
        Band(4096, 1.45, 3.5),
        Band(16384, 1.45, 4.5),
        Band(None, 1.45, 6.0),
    )
    chunk_bands: Sequence[Band] = (
        Band(768, 1.25, 2.8),
        Band(1024, 1.32, 2.8),
        Band(2048, 1.37, 3.5),
        Band(None, 1.45, 3.5),
    )


def in_band(bands: Sequence[Band], raw: int, packed: int) -> bool:
    """Whether a text of ``raw`` bytes that compress to ``packed`` is in its length's band."""
    for band in bands:
        if band.up_to is None or raw <= band.up_to:
            return band.low * packed <= raw <= band.high * packed
    return True


def compression_verdict(text: bytes, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple[bool, float]:
    """Whether the ratios of ``text`` and of its chunks are in their bands; the whole ratio."""
    if not text:
        return False, 0.0
    size = len(packer.compress(text))
    ratio = len(text) / size
    if not in_band(rules.document_bands, len(text), size):
        return False, ratio
    if len(text) <= rules.chunk_bytes:
        return True, ratio
    judged = bad = 0
    for at in range(0, len(text), rules.chunk_bytes):
        part = text[at : at + rules.chunk_bytes]
        if len(part) >= rules.least_chunk:
            judged += 1
            bad += not in_band(rules.chunk_bands, len(part), len(packer.compress(part)))
    return bad <= rules.bad_share * judged, ratio


def counts(data: np.ndarray, offsets: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated windows."""
    n = len(offsets) - 1
    starts, ends, doc = ch.words(data, offsets)
    per_doc = lambda which, weights=None: np.bincount(which, weights, n).astype(np.int64)
    inside = ~ch.SPACE[data]
    points = inside & ((data & 0xC0) != 0x80)
    # lines: every document has one more than it has line feeds
    feeds = np.flatnonzero(data == 10)
    feed_doc = np.searchsorted(offsets, feeds, "right") - 1
    line_start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    line_end = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    line_doc = np.sort(np.concatenate([np.arange(n), feed_doc]), kind="stable")
    kept = ch.counts_between(inside, line_start, line_end) > 0
    line_start, line_end, line_doc = line_start[kept], line_end[kept], line_doc[kept]
    line_hashes = [ch.span_hashes(data, line_start, line_end, seed) for seed in (0, 1)]
    order = np.lexsort((*line_hashes, line_doc))
    again = np.diff(line_doc[order]) == 0
    for hashed in line_hashes:
        again &= hashed[order][1:] == hashed[order][:-1]
    first = ch.windows(doc, window)
    hashed = ch.run_hashes(ch.span_hashes(data, starts, ends), first, window)
    first = first[ch.seen_twice(doc[first], hashed)]
    repeated = ch.covered(first, first + window, len(doc))
    return {
        "n_words": per_doc(doc),
        "word_chars": ch.counts_between(points, offsets[:-1], offsets[1:]),
        "n_symbols": ch.counts_between(SYMBOLS[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": per_doc(line_doc[order][1:][again]),
        "n_repeat_words": per_doc(doc[repeated]),
    }


def judged(batch: pa.RecordBatch, text_col: str, rules: Rules) -> dict[str, np.ndarray]:
    """The counts and verdicts of a batch's texts."""
    data, offsets = ch.text_bytes(batch.column(batch.schema.get_field_index(text_col)))
    out = counts(data, offsets, rules.window)
    out["base_failed"] = (out["n_words"] < rules.least_words) | (
        100 * out["n_repeat_words"] > rules.repeat_percent * out["n_words"]
    )
    packer = zstandard.ZstdCompressor(level=rules.level)
    raw = data.tobytes()
    verdicts = [
        (False, 0.0) if failed else compression_verdict(raw[a:b], rules, packer)
        for a, b, failed in zip(offsets[:-1], offsets[1:], out["base_failed"])
    ]
    out["kept"] = np.array([v for v, _ in verdicts], bool)
    return out


REPORT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: its id, counts, base rule and final verdict.

    A null or empty text has no word and fails; repeated rows are judged alike,
    each on its own; a null id stays null; other columns are not read. An empty
    table gives an empty result. Each text is judged whole, whatever its length.
    """
    source = docs.select(id_col, text_col)
    names = [x.split()[0] for x in REPORT.split(", ")]

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ch.chunked(batch, text_col):
                found = judged(part, text_col, rules)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(found[x]) for x in names)], [id_col, *names]
                )

    id_type = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(report, f"`{id_col}` {id_type}, {REPORT}")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, without a shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ch.chunked(batch, text_col):
                yield part.filter(pa.array(judged(part, text_col, rules)["kept"]))
            ch.release()

    return docs.mapInArrow(keep, docs.schema)
