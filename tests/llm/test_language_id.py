import random
import zlib

import numpy as np
import pytest

import cases
from skylattice.llm import language_id as li
from skylattice.llm.queries import QUERIES


def parse(text, reference):
    """Phrases of ``text``: greedy longest matches with ``reference``, segment by segment."""
    count = 0
    for at in range(0, len(text), li.SEGMENT):
        part, i = text[at : at + li.SEGMENT], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i : i + n + 1] in reference and part[i] in reference:
                n += 1
            count += 1
            i += n
    return count


def test_phrases_match_brute_force():
    rng = random.Random(2)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    references = {"a": draw("abc ", 200), "b": draw("bcdé ", 150)}
    texts = [draw("abcdéz ", rng.randint(0, 60)) for _ in range(50)] + [draw("abc ", 2500), "", "a"]
    found = li.Model(references).phrases(texts)
    expected = [[parse(t, references[x]) for t in texts] for x in ("a", "b")]
    assert found.tolist() == expected


def test_folding_keeps_letters_and_one_blank():
    assert li.folded("Ab, 12 cÉ!\n\nd") == "ab cé d"
    assert li.folded("12 !") in ("", " ") and li.folded("") == ""


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, d).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = cases.documents(spark, 1, 40)
    odd = docs.withColumn("lang", (li.remainder("doc_id", 4) == 2).cast("string"))
    assert {r.lang_pred for r in li.identify(odd).collect()} <= {"false", "und"}


@pytest.mark.parametrize("column", ["lang", "text"])
def test_nulls_and_empty(spark, column):
    docs = cases.awkward(spark).withColumn(column, cases.F.lit(None).cast("string"))
    rows = li.identify(docs).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} == {"und"} and {r.score for r in rows} == {0.0}
    assert li.identify(cases.empty(spark)).count() == 0


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = {(r.doc_id, r.text): 0 for r in docs.collect()}
    found = li.identify(docs)
    assert found.count() == docs.count() >= len(rows)
    blank = docs.where("text is null or not text rlike '\\\\p{L}'").select("doc_id").distinct()
    assert found.join(blank, "doc_id").where("lang_pred != 'und'").count() == 0


def test_a_foreign_notice_before_every_text_does_no_harm(spark):
    rng = random.Random(4)
    draw = lambda letters, n: " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))
    notice = draw("theraonisdlu", 200)[:1000]
    rows = [(i, f"{notice} {draw('aeiouéèclmnrst' if i % 2 else 'aeiouäüchgdnrstb', 300)}", ["de", "fr"][i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clean = spark.createDataFrame(
        [(i, t[1001:], "xx" if i % 4 == 2 else lang) for i, t, lang in rows], "doc_id long, text string, lang string"
    )
    references = li.learn(docs)
    got = {r.doc_id: r.lang_pred for r in li.predict(clean, references).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) >= 0.95
    assert all(len(x) > 20_000 for x in references.values())  # whole texts


def test_long_texts_are_drawn_last_and_whole(spark):
    rows = [(i, "kurz " * 10 + "abcdefghij"[i] * 3, "a") for i in range(5)] + [(9, "lang " * 5000 + "ende", "a"), (8, "lang " * 5000 + "ende", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = li.learn(docs, bounds=li.Bounds(documents=4, points=1000))
    assert "lang" not in found["a"] and found["b"].endswith("lang ende") and len(found["b"]) == 25_004
    one = li.learn(docs, bounds=li.Bounds(documents=9, points=1000, languages=1))
    assert set(one) == {"a"} and one["a"].endswith("ende")


def test_table_follows_the_reference_not_the_alphabet():
    rng = random.Random(7)
    draw = lambda lo, n: "".join(chr(lo + rng.randrange(20_000)) for _ in range(n))
    references = {f"l{i}": draw(0x4E00, 20_000) for i in range(9)} | {"en": "the cat sat on a mat " * 1000}
    model = li.Model(references)
    assert model.edges.nbytes + model.begin.nbytes + model.classes.nbytes < 50 << 20
    texts = [references["l3"][500:900], "the cat", draw(0x4E00, 300)]
    assert model.predict(texts)[0][:2] == ["l3", "en"]
    assert model.phrases(texts[:1])[model.languages.index("l3")][0] == 1


def test_long_text_is_read_whole():
    model = li.Model({"a": "abab abba baab", "b": "cdcd dccd cddc"})
    names, _ = model.predict(["abba " * 10 + "cddc " * 300_000])
    assert names == ["b"]
