import cases
import compare
from skylattice.llm import line_dedup as ld
from skylattice.llm.queries import ORACLES, QUERIES


def test_same_as_brute_force(spark):
    docs = cases.documents(spark, 3, 80)
    expected = cases.line_dedup([tuple(r) for r in docs.select("doc_id", "text").collect()])
    found = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    assert found == expected


def test_nulls_repeats_and_clashing_columns(spark):
    docs = cases.awkward(spark)
    out = ld.dedup_lines(docs)
    assert set(out.columns) == {*docs.columns, "n_lines"}
    assert out.count() == docs.count()
    assert out.where("text is null").count() == 0
    twice = out.where("doc_id = 7").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert ld.dedup_lines(cases.empty(spark)).count() == 0


def test_blank_windows_stay_and_overlaps_merge(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "\n\n\n\n"), (4, "\n\n\n\n")]
    out = {r.doc_id: r for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2].text == "x\ny" and out[2].n_removed == 4
    assert out[4].text == "\n\n\n\n" and out[1].n_removed == 0


def test_many_repeats_inside_one_long_text(spark):
    text = "\n".join(["same"] * 20_000 + ["end"])
    row = ld.dedup_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.text == "same\nend" and row.n_removed == 19_999


def test_native_plan(spark):
    plan = ld.dedup_lines(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    assert compare.differences(QUERIES["op6_line_dedup"](spark, d), compare.duck(d), ORACLES["op6_line_dedup"]) == ""
