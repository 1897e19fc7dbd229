import public_tokenizers as pt
import pytest
import zstandard

import cases
import corpus_pipeline
from skylattice.llm import packing as pk
from skylattice.llm import quality_rules as qr

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents long enough for the quality rules, with copies and benchmark passages."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = cases.documents(spark, 5, 120).select(*COLUMNS)
    nulls = docs.limit(1).select(*[cases.F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    docs.unionByName(nulls).unionByName(docs.where("doc_id in (5, 9)")).write.parquet(f"{folder}/documents.parquet")
    long = next(t for t in cases.texts(5, 120)[7:] if len(cases.folded_words(t)) > 80)
    items = [(1, " ".join(cases.folded_words(long)[20:40])), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def keeps_quality(rows):
    packer = zstandard.ZstdCompressor(level=qr.Rules().level)

    def good(text):
        return not cases.base_rules(text)[-1] and qr.compression_verdict(text.encode(), qr.Rules(), packer)[0]

    return [r for r in rows if good(r["text"] or "")]


def shortens_lines(rows):
    shorter = cases.line_dedup([(r["doc_id"], r["text"]) for r in rows])
    out = []
    for r in rows:
        text = shorter[r["doc_id"]]
        changed = text != (r["text"] or "")
        out.append({**r, "text": text, "n_chars": len(text) if changed else r["n_chars"]})
    return out


def keeps_one_of_near_copies(rows):
    distinct = {(r["doc_id"], r["text"]): r for r in rows}
    ordered = sorted(distinct.values(), key=lambda r: r["doc_id"])
    marks = [cases.simhash(r["text"]) for r in ordered]
    roots = cases.groups(marks, lambda a, b: (a ^ b).bit_count() <= 3)
    return [r for i, r in enumerate(ordered) if roots[i] == i]


def drops_contaminated(rows, items):
    found = cases.contamination([(r["doc_id"], r["text"]) for r in rows], items)
    return [r for r in rows if not found[r["doc_id"]][1]]


def test_every_stage_matches_brute_force(spark, sf_dir, tmp_path):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    brute = [keeps_quality, shortens_lines, keeps_one_of_near_copies, lambda rows: drops_contaminated(rows, items)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dropped = []
    for i, ((name, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, brute)):
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == COLUMNS
        after = [r.asDict() for r in docs.collect()]
        key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text"])
        assert sorted(after, key=key) == sorted(expected(before), key=key), name
        dropped.append(len(before) - len(after))
    assert dropped[0] and dropped[2] and dropped[3]
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    encode = pk.Encoder(pt.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: len(encode([r.text])[0]) // 4 + 1 for r in docs.collect()}
    packed = {}
    for p in pieces:
        packed[p.doc_id] = packed.get(p.doc_id, 0) + p.length
    assert packed == tokens
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    facts = lambda rows: sorted((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in rows)
    assert sum(p.length for p in whole) == sum(tokens.values())
    assert {p[0] for p in facts(whole)} == set(tokens)


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_pass_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS fp", "3 AS block", "4 AS row", "5 AS items", "6 AS `odd name`")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, more, sf_dir)
        assert out.columns == more.columns and out.count() > 0
