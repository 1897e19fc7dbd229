import random

import cases
from skylattice.llm import quality_rules as qr


def test_counts_and_base_rule_match_brute_force(spark):
    docs = cases.awkward(spark)
    expected = sorted(((d, *cases.base_rules(t)) for d, t in docs.select("doc_id", "text").collect()), key=str)
    found = qr.quality_report(docs).drop("kept").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected


def test_bands_reject_repetition_and_noise_and_keep_prose():
    import string
    import zstandard

    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    packer = zstandard.ZstdCompressor(level=3)
    verdict = lambda t: qr.compression_verdict(t, qr.Rules(), packer)[0]
    for n in (20, 100, 500, 5000, 50_000):
        assert verdict(" ".join(rng.choice(vocabulary) for _ in range(n)).encode())
    assert not verdict(b"buy now cheap " * 400)
    assert not verdict(b"")
    noise = bytes(rng.randrange(256) for _ in range(20_000))
    assert not verdict(noise)
    prose = " ".join(rng.choice(vocabulary) for _ in range(3000)).encode()
    assert not verdict(prose + noise * 2)  # the chunks show what the whole hides


def test_stage_keeps_columns_and_empty_tables(spark):
    docs = cases.documents(spark)
    kept = qr.keep_good(docs)
    assert kept.columns == docs.columns
    report = {r.doc_id for r in qr.quality_report(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == report
    assert qr.quality_report(cases.empty(spark)).count() == 0
    assert qr.keep_good(cases.empty(spark)).count() == 0


def test_long_text_is_read_whole(spark):
    text = " ".join(f"w{i}" for i in range(200_000))
    row = qr.quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 200_000 and row.word_chars == len(text) - 199_999


def test_random_text_fails_and_prose_of_the_same_length_stays():
    import base64
    import string
    import zstandard

    rng = random.Random(8)
    printable = string.ascii_letters + string.digits + string.punctuation + " "
    packer = zstandard.ZstdCompressor(level=3)
    verdict = lambda t: qr.compression_verdict(t, qr.Rules(), packer)[0]
    random_texts = {
        "base64": lambda n: base64.b64encode(rng.randbytes(n))[:n],
        "printable": lambda n: "".join(rng.choices(printable, k=n)).encode(),
        "cjk": lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n // 3)).encode(),
    }
    vocabulary = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(4000)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n // 4)).encode()[:n]
    for n in (480, 1000, 2000, 4000, 10_000, 60_000):
        assert verdict(prose(n)), n
        for kind, make in random_texts.items():
            text = make(n)
            assert text.decode() and not verdict(text), (kind, n)
    for make in random_texts.values():  # chunks that compress badly, in a text that as a whole does not
        assert not verdict(prose(40_000) + make(20_000))
        assert verdict(prose(40_000) + make(2000))


def test_different_long_lines_and_words_never_meet(spark):
    for k in (10, 11, 13):
        one, two = cases.alike_under_powers(k)
        words = [f"{w}{i}" for i in range(7) for w in "x"]
        text = "\n".join([one, two, " ".join([*words, one]), " ".join([*words, two]), one])
        row = qr.quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).drop("kept").first()
        assert tuple(row) == (1, *cases.base_rules(text))
        assert row.n_dup_lines == 1 and row.n_repeat_words == 0
