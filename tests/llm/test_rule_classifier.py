import zlib

import numpy as np

import cases
from skylattice.llm import chunks as ch
from skylattice.llm import rule_classifier as rc
from skylattice.llm.queries import QUERIES


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_classifier"](spark, d).collect()
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.95
    assert np.mean([s >= 0.3 for s in good]) >= 0.95


def test_rules_are_sparse_and_compile_to_columns(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i % 10 > 4)) for i in range(400)]
    stats = spark.createDataFrame(rows, "doc_id long, a double, b double, y int")
    for name in rc.STATISTICS:
        stats = stats.withColumn(name, cases.F.col("a") if name == "n_words" else cases.F.col("b"))
    model = rc.fit(stats, "y", trees=5, depth=2)
    scored = stats.withColumn("s", model.column())
    assert scored.where("y = 1").agg({"s": "min"}).first()[0] > scored.where("y = 0").agg({"s": "max"}).first()[0]
    assert 0 < len(model.weights) < 5 * 6
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = cases.documents(spark, 1, 60)
    held = rc.remainder("doc_id", 5) == 0
    a = docs.select("doc_id", (cases.F.length("text") % 2).alias("quality"))
    b = a.withColumn("quality", cases.F.when(held, 1 - cases.F.col("quality")).otherwise(cases.F.col("quality")))
    one, two = ({r.doc_id: r.score for r in rc.classify(docs, x).collect()} for x in (a, b))
    assert one == two


def test_too_few_labels(spark):
    docs = cases.awkward(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rc.classify(docs, none).collect()} == {0.5}
    ones = docs.select("doc_id", cases.F.lit(1).alias("quality"))
    rows = rc.classify(docs, ones).collect()
    assert len(rows) == docs.count() and all(r.predicted == 1 for r in rows)
    assert rc.classify(cases.empty(spark), ones).count() == 0


def test_statistics_of_odd_texts():
    import pyarrow as pa

    data, offsets = ch.text_bytes(pa.array([None, "", "Ab c!\nAb c!", "é|é"]))
    found = dict(zip(rc.STATISTICS, rc.text_statistics(data, offsets)))
    assert found["n_words"].tolist() == [0, 0, 4, 1]
    assert found["repeated_lines"].tolist() == [0, 0, 0.5, 0]
    assert found["distinct_words"].tolist() == [0, 0, 0.5, 1]
    assert found["bars"].tolist() == [0, 0, 0, 1]
    assert all(np.isfinite(x).all() for x in found.values())


def test_statistics_tell_long_words_and_lines_apart():
    for k in (10, 11, 13):
        one, two = cases.alike_under_powers(k)
        data = np.frombuffer(f"{one}\n{two}".encode(), np.uint8)
        found = dict(zip(rc.STATISTICS, rc.text_statistics(data, np.array([0, len(data)]))))
        assert found["repeated_lines"][0] == 0 and found["distinct_words"][0] == 1.0
