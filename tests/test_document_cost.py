"""Filing documents: lines move once and as numbers, a text is made once and parsed once."""

import pytest

from conftest import SF0001
from ledgerlake.operators import large_documents, nested, quality
from ledgerlake.plans import proxies
from ledgerlake.plans.catalog import QUERIES
from ledgerlake import schemas as S


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


# JSON texts that a query makes and parses.
TEXTS = {"metric_coverage_documents": 1, "document_rejects": 1, "facts_top5_array": 1, "facts_explode_full": 2}


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_each_text_is_made_and_parsed_once(spark, name):
    p = optimized(QUERIES[name](spark, SF0001))
    made = p.count("to_json(") + p.count("StructsToJson") - (name == "document_rejects")  # damaged ones: an own text
    assert made == TEXTS[name] and p.count("from_json(") == TEXTS[name], p


def test_status_is_found_once(spark):
    assert optimized(QUERIES["document_rejects"](spark, SF0001)).count("try_parse_json") <= 1


def test_lines_move_as_numbers_and_are_grouped_once(spark):
    df = proxies.filing_documents(spark, SF0001)
    p = optimized(df)
    assert p.count("Aggregate [") == 1 and p.count("RepartitionByExpression") == 1
    before = p[p.index("RepartitionByExpression"):]
    assert "-01-" not in before and "date_add" not in before and "Revenues" not in before


def test_documents_of_null_and_equal_keys(spark, tmp_path):
    rows = "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_tax double, " \
           "l_returnflag string, l_linestatus string, l_shipdate timestamp"
    import datetime as dt
    day = dt.datetime(2000, 5, 1)
    lines = [(1, 9, 1, 2.0, 0.1, "A", "F", day), (1, 9, 1, 1.0, 0.1, "A", "F", day), (1, 9, 1, 1.0, 0.1, "A", "F", day),
             (1, 9, 7, 3.0, 0.1, None, "F", day), (2, 9, 1, 3.0, 0.0, "A", "F", None), (None, 9, 3, 4.0, 0.1, "R", "F", day),
             (1, None, 1, 5.0, 0.1, "N", "O", day), (1, 9, 1, 5.0, 0.1, None, "O", day), (4096, 9, 6, 5.0, None, "N", "O", day)]
    spark.createDataFrame(lines, rows).write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = nested.parse_documents(proxies.filing_documents(spark, str(tmp_path)), S.FILING_DOC)
    got = {(r.ticker, r.doc_id): r.doc for r in docs.collect()}
    assert set(got) == {("9", 0), ("9", None), (None, 0), ("9", 2)}
    facts = got[("9", 0)].facts["us-gaap"]
    assert [(f.val, f.end, f.accn) for f in facts.NetIncomeLoss.units.USD] == [
        (100, "2000-05-01", "1-1"), (100, "2000-05-01", "1-1"), (200, "2000-05-01", "1-1"), (None, None, "2-1")]
    assert facts.Liabilities is None and got[("9", 2)].facts["us-gaap"].Liabilities is None
    assert [f.val for f in got[(None, 0)].facts["us-gaap"].Liabilities.units.USD] == [500]
    covered = quality.coverage_from_filings(docs, keep=("doc_id",)).where("not missing").select("ticker", "doc_id", "metric_name", "records_found")
    assert sorted(map(str, map(tuple, covered.collect()))) == sorted(map(str, [
        ("9", 0, "NetIncomeLoss", 4), ("9", None, "StockholdersEquity", 1), (None, 0, "Liabilities", 1)]))


def test_pieces_are_cut_and_read_once(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = QUERIES["facts_top5_pieces"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # One aggregate for the documents and one for the objects, a partial and a final each.
    assert p.count("FileScan") == 1 and p.count("ReusedExchange") == 2 and p.count("collect_list(") == 4, p


def test_braces_of_pieces_are_those_outside_strings(spark):
    docs = ['{"a\\"{": {"facts": "{", "b}": "{}"}, "facts": {"us-gaap": {"x\\\\": {"units": {"{": [{"val": 1, "fp": "}{"}, {"val": 2}]}}}}}',
            '{"facts": {"us-gaap": {"M": {"units": {"USD": [{"val": 3}, {"val": 4}]}}}}, "entityName": "N{}"}',
            '{"facts": {"us-gaap": {"M": {"units": {"USD": [{"val": 5}, {"val": 6}]}}}']
    landed = spark.createDataFrame(list(enumerate(docs)), "name int, body string")
    for per_block in (1, 2, 4096):
        got = large_documents.facts(large_documents.pieces_of(landed, "name", per_block=per_block))
        assert sorted(map(tuple, got.select("doc", "company_name", "metric_name", "unit", "fact.val").collect())) == [
            (0, None, "x\\", "{", 1), (0, None, "x\\", "{", 2), (1, "N{}", "M", "USD", 3), (1, "N{}", "M", "USD", 4)]
