"""Typing, imputation and profiles."""

import pytest

from skylattice.operators import clean as C, profile as P, ranks as R
from pyspark.sql import functions as F


def test_one_value_does_not_decide_the_type(spark):
    df = spark.createDataFrame(
        [("3", "1", "x"), ("3.5", "2", None), ("x", "3", "y"), (None, None, None)],
        "a string, b string, c string",
    )
    assert C.infer_types(df, ["a", "b", "c"]) == {"a": "double", "b": "int"}
    assert C.infer_types(df, ["a", "b"], min_rate=1.0) == {"b": "int"}
    assert sorted(map(tuple, C.type_rates(df, batch=1).collect())) == sorted(map(tuple, C.type_rates(df).collect()))
    assert [r["a"] for r in C.typed_cast(df, {"a": "double"}).collect()] == [3.0, 3.5, None, None]


def test_means_come_from_training_rows(spark):
    rows = [(2018, 1.0, 1), (2018, 3.0, 2), (2018, None, 2), (2019, 900.0, None)]
    df = spark.createDataFrame(rows, "y int, x double, n int")
    got = C.impute_mean(df, df.filter("y < 2019"), ["x", "n"]).collect()
    assert [r["x"] for r in got] == [1.0, 3.0, 2.0, 900.0]
    assert got[3]["n"] == 1  # mean 5/3, truncated


def test_sparse_columns_are_dropped(spark):
    df = spark.range(200).select(
        "id", F.when(F.col("id") < 2, 1).alias("gone"), F.when(F.col("id") < 3, 1).alias("kept")
    )
    assert C.drop_sparse(df, 99.0).columns == ["id", "kept"]


def test_missing_counts(spark):
    df = spark.createDataFrame(
        [("", 1.0), ("None x", float("nan")), ("NULL", None), (None, 2.0)], "s string, x double"
    )
    plain = {r["column_name"]: r["n_missing"] for r in P.null_profile(df).collect()}
    marked = {
        r["column_name"]: r["n_missing"]
        for r in P.null_profile(df, treat_nan=True, sentinels=["None", "NULL"]).collect()
    }
    assert plain == {"s": 1, "x": 1} and marked == {"s": 4, "x": 2}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "x int, y string")
    got = {r["metric"]: r["value"] for r in P.duplicate_profile(df).collect()}
    assert list(got.values()) == [4, 2, 2]
    assert P.duplicate_profile(df.limit(0)).first()["value"] == 0


def test_columns_are_checked(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert P.assert_columns(df, ["x"]) is df
    with pytest.raises(ValueError, match="missing columns: y"):
        P.assert_columns(df, ["x", "y"])


def test_column_sources(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "y int, z int")
    joined = a.join(b, "y").withColumn("new", F.lit(1))
    got = {r["column_name"]: r["source"] for r in P.column_sources(joined, {"a": a, "b": b}).collect()}
    assert got == {"x": "a", "y": "a", "z": "b", "new": "created"}


def test_estimated_bytes_grow(spark):
    assert P.estimated_bytes(spark.range(1000)) < P.estimated_bytes(spark.range(100_000))


def test_dates_that_do_not_parse(spark):
    df = spark.createDataFrame([("2015-02-28",), ("2015-02-30",), ("x",)], "d string")
    assert [r[0] is not None for r in df.select(C.coerce_date(F.col("d"))).collect()] == [
        True, False, False
    ]


@pytest.mark.parametrize("cell_rows", [1, 7, 1000])
def test_running_totals_over_ranges(spark, cell_rows):
    values = [float((i * 37) % 101) for i in range(500)] + [float("nan"), None]
    rows = [("hot" if i % 3 else "cold", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = R.running_totals(df, "x", {"n": F.count(F.lit(1))}, ["g"], cell_rows).collect()
    kept = [(g, v) for g, v in rows if v is not None and v == v]
    assert len(got) == len(set(kept))
    for r in got:
        mine = [v for g, v in kept if g == r["g"]]
        assert r["n_upto"] == sum(v <= r["x"] for v in mine)
        assert r["n_all"] == len(mine)


@pytest.mark.parametrize("cell_rows", [3, 1000])
def test_quantiles_are_ranks(spark, cell_rows):
    df = spark.createDataFrame([(float(i),) for i in [5, 1, 9, 9, 2, 2, 2, 7]], "x double")
    got = R.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.75, 1.0], cell_rows=cell_rows).first()
    assert [got[f"q{i}"] for i in range(5)] == [1.0, 2.0, 2.0, 7.0, 9.0]
    assert got["n"] == 8
    assert R.exact_quantiles(df.limit(0), "x", [0.5]).collect() == []


def test_quantiles_agree_with_the_built_in(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).cast("double").alias("x"))
    probabilities = [0.1, 0.25, 0.5, 0.9]
    got = R.exact_quantiles(df, "x", probabilities, cell_rows=50).first()
    assert [got[f"q{i}"] for i in range(4)] == df.approxQuantile("x", probabilities, 0)


def test_profiles_of_an_empty_table(spark):
    from skylattice.operators import aggregates as A, evaluate as E, prep as M, stats as X

    df = spark.createDataFrame([], "y double, x double, s string, d date")
    assert [r["missing_pct"] for r in P.null_profile(df).collect()] == [None] * 4
    assert A.label_balance(df, "y").first()["positive_pct"] is None
    assert X.label_correlation(df, "y", ["x"]).first()["correlation"] is None
    assert M.class_weight(df, "y").count() == 0
    assert E.area_under_roc(df, "y", "x").first()["auc"] is None
    assert P.numeric_summary(df, ["x"]).first()["mean"] == 0.0
    assert C.infer_types(df) == {}


def test_constants_fill_columns_of_their_type(spark):
    df = spark.createDataFrame([(None, None, None), (1, 2.0, "x")], "a int, b double, s string")
    assert C.fill_missing(df, 0).first().asDict() == {"a": 0, "b": 0.0, "s": None}
    assert C.fill_missing(df, "").first().asDict() == {"a": None, "b": None, "s": ""}
    assert C.fill_missing(df, 0, ["a"]).first().asDict() == {"a": 0, "b": None, "s": None}
    assert C.fill_missing(df, {"b": 7.0}).first()["b"] == 7.0


def test_text_that_only_the_jvm_takes_for_a_number(spark):
    texts = ["3d", "4f", "1e3", "10s", " 7 ", ".5", "5.", "NaN", "-Infinity", "1e", "e3", "0x1p3", "", "--1"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = {r["t"]: r["x"] for r in C.typed_cast(df.withColumn("t", F.col("x")), {"x": "double"}).collect()}
    fine = {"1e3": 1000.0, " 7 ": 7.0, ".5": 0.5, "5.": 5.0, "-Infinity": float("-inf")}
    assert {t: v for t, v in got.items() if v is not None and v == v} == fine
    assert got["NaN"] != got["NaN"]


def test_category_tables_of_any_width(spark):
    from skylattice.operators import prep as M

    rows = [(f"v{i % 700:03d}" if i % 11 else None,) for i in range(3000)] + [("v005",)] * 3
    df = spark.createDataFrame(rows, "c string")
    labels = M.fit_category_index(df, ["c"]).labelsArray[0]
    table = {r["c"]: r["idx"] for r in M.category_table(df, "c").collect()}
    assert table == {v: float(i) for i, v in enumerate(labels)}
    numbered = M.index_by_table(df, {"c": M.category_table(df, "c")})
    assert numbered.filter("c IS NULL AND c_indexed IS NOT NULL").count() == 0
    assert numbered.count() == df.count() and numbered.filter("c = 'v005'").first()["c_indexed"] == 0.0
    with pytest.raises(ValueError):
        M.fit_category_index(df, ["c"], max_categories=699)
    assert M.fit_features(df, ["c"], [], max_categories=700) is not None
    assert M.hash_categories(df, ["c"], 16).first()["hashed"].size == 16
