"""Types found in the data: kinds of values, profiles, and documents of unknown keys."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.operators import lattice, nested

VALUES = {
    "7": 1, "-12": 1, "+5": 1, "0" * 18: 1, "9" * 19: 2, "1.5": 2, "1.": 2, "-0.25": 2, "9" * 33: 8, ".5": 8, "1e5": 8,
    "NaN": 8, "2024-02-29": 4, "2023-02-29": 8, "2024-2-9": 8, "n/a": 8, " 8 ": 1, "": 0, "None": 0, "  ": 0, None: 0,
}


def test_kind_of_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = {r.v: r.k for r in df.select("v", lattice.kind_of(lattice.present(F.col("v"))).alias("k")).collect()}
    assert got == VALUES


def test_profile_and_typed(spark):
    rows = [("1", "2024-01-31", "x", "1", None, "a"), ("-20", "2023-12-01", "10", "2.25", "None", "b"), ("3", None, "9", "30", "", "c")] * 5
    df = spark.createDataFrame(rows, "i string, d string, mixed string, n string, none string, `a.b` string").repartition(4)
    df = df.select("*", F.col("i").alias("i"))  # equal names
    profile = lattice.source_profile(df)
    got = {r.position: (r.column_name, r.n_rows, r.n_missing, r.column_type, r.min_value, r.max_value) for r in profile.collect()}
    assert got == {
        0: ("i", 15, 0, "bigint", "-20", "3"), 1: ("d", 15, 5, "date", "2023-12-01", "2024-01-31"),
        2: ("mixed", 15, 0, "string", "10", "x"), 3: ("n", 15, 0, "decimal(38,6)", "1.000000", "30.000000"),
        4: ("none", 15, 15, "string", None, None), 5: ("a.b", 15, 0, "string", "a", "c"), 6: ("i", 15, 0, "bigint", "-20", "3")}
    assert [t for _, t in lattice.typed(df, profile).dtypes] == [got[i][3] for i in range(7)]
    assert sorted({(r[0], str(r[3])) for r in lattice.typed(df, profile).collect()}) == [
        (-20, "2.250000"), (1, "1.000000"), (3, "30.000000")]


def test_profile_is_one_aggregate(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = lattice.source_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "ArrowEvalPython" not in plan


def test_profile_of_no_rows(spark):
    rows = lattice.source_profile(spark.createDataFrame([], "a string")).collect()
    assert [(r.n_rows, r.n_missing, r.column_type, r.min_value) for r in rows] == [(0, 0, "string", None)]


def documents(spark, *bodies):
    texts = spark.createDataFrame([(b, f"t{i}.json") for i, b in enumerate(bodies)], "body string, file_name string")
    return nested.parse_documents(texts, S.STATEMENT_DOC)


def test_keys_of_all_documents_become_typed_columns(spark):
    docs = documents(
        spark, '{"symbol":"A","annualReports":[{"x":"1","when":"2024-01-01"},{"x":"2","only":"1.5"}]}',
        '{"symbol":"B","annualReports":[{"x":"None","odd":"n/a","a.b":"7"},{}]}', '{"symbol":"C"}', "{cut")
    wide = nested.statements_wide(docs)
    assert dict(wide.dtypes) == {"ticker": "string", "a.b": "bigint", "odd": "string", "only": "decimal(38,6)",
                                 "when": "date", "x": "bigint"}
    got = sorted(((r.ticker, r.x, str(r.when), str(r.only), r.odd, r["a.b"]) for r in wide.collect()), key=str)
    assert got == sorted([("A", 1, "2024-01-01", "None", None, None), ("A", 2, "None", "1.500000", None, None),
                          ("B", None, "None", "None", "n/a", 7), ("B", None, "None", "None", None, None)], key=str)


def test_keys_that_are_data_fail_the_load(spark):
    many = ",".join(f'"k{i}":"1"' for i in range(12))
    docs = documents(spark, '{"symbol":"A","annualReports":[{' + many + "}]}")
    with pytest.raises(ValueError, match="more than 10"):
        nested.statements_wide(docs, most_keys=10)
    clash = documents(spark, '{"symbol":"A","annualReports":[{"Ticker":"1"}]}')
    with pytest.raises(ValueError, match="clash"):
        nested.statements_wide(clash)


def test_no_documents(spark):
    assert nested.statements_wide(documents(spark, "{}")).collect() == []
