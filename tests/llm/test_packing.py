import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as pt
import pytest

import cases
from skylattice.llm import packing as pk

FILES = (pt.path("byte_bpe_50k.json"), pt.path("byte_bpe_50k.tiktoken"), pt.PATTERN)


def check(docs, capacity=1024, **kw):
    rows = pk.pack(docs, *FILES, capacity=capacity, with_ids=True, **kw).collect()
    slow = pk.Encoder(FILES[0])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    waste = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        waste += 0 if at & (at - 1) == 0 else capacity - at
    listed = docs.select("doc_id", "text").collect()
    copies = Counter(r.doc_id for r in listed)
    for r in listed:
        want = [*np.frombuffer(slow([r.text or ""])[0], "<u4").tolist(), 0]
        if copies[r.doc_id] == 1:
            own = sorted(pieces[r.doc_id], key=lambda x: x.start)
            assert sum((list(x.ids) for x in own), []) == want
            assert [x.start for x in own] == np.cumsum([0, *[x.length for x in own]])[:-1].tolist()
            assert {x.doc_tokens for x in own} == {len(want)}
    return waste, total


def test_each_id_in_one_piece(spark):
    waste, total = check(cases.documents(spark, 1, 60))
    assert waste <= 0.1 * total
    check(cases.awkward(spark))
    check(cases.documents(spark, 1, 30), capacity=128, least_cut=16)


def test_little_padding_at_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    waste, total = check(docs)
    assert waste <= 0.02 * total


def test_both_encoders_agree():
    fast, slow = pk.Encoder(*FILES), pk.Encoder(FILES[0])
    rng = random.Random(3)
    alphabet = "ab \n\n  cD'1234.,!?ªº²½ñ×÷ÀÿĀǅʔ\t\xa0 <|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(50)) for _ in range(800)]
    texts += ["", " ", "<|endoftext|>", "a" * 5000]
    assert fast(texts) == slow(texts)


def test_added_tokens_have_the_ids_of_the_tokenizer_as_loaded(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(FILES[0])
    texts = ["end of one <|endoftext|> next", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext |>", "中 <|endoftext|>", "no mark"]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert sum(50256 in x for x in want) == 4
    for encode in (pk.Encoder(*FILES), pk.Encoder(FILES[0])):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pk.pack(docs, *FILES, with_ids=True).collect()}
    for i, ids in enumerate(want):
        ids = [*ids, 0]
        assert list(rows[i].ids) == ids and rows[i].doc_tokens == rows[i].length == len(ids)
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_empty_table(spark):
    assert pk.pack(cases.empty(spark), *FILES).count() == 0


@pytest.mark.parametrize("length", [0, 1, 127, 128, 511, 512, 1023])
def test_tail_pieces_add_up(length):
    assert sum(pk.tail_pieces(length, 1024, 128)) == length
