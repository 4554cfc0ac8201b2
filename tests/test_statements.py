"""Statement documents: S4/S5, N4, P5-P7, P11, F4, X12-X14, U1."""

import pytest
from pyspark.sql import functions as F

from fixtures import write_statements
from ledgerlake import schemas as S
from ledgerlake.operators import nested, staging
from ledgerlake.sources import files as sources


@pytest.fixture(scope="module")
def api_dir(tmp_path_factory):
    return write_statements(str(tmp_path_factory.mktemp("api")))


def test_explode_income(spark, api_dir):
    docs = sources.read_statements(spark, api_dir, "income_statement")
    assert docs.count() == 5                                  # glob keeps only income files
    rows = nested.explode_statements(docs, S.INCOME_REPORT_FIELDS).collect()
    assert len(rows) == 9                                     # AAA 8 + symbol-less 1
    assert sum(1 for r in rows if r.ticker is None) == 1


def test_stg_income_statements(spark, api_dir):
    docs = sources.read_statements(spark, api_dir, "income_statement")
    stg = staging.stg_income_statements(nested.explode_statements(docs, S.INCOME_REPORT_FIELDS))
    rows = {r.fiscal_date: r for r in stg.collect()}
    assert len(rows) == 7                                     # NULL ticker and NULL date gone
    assert rows["2022-12-31"].total_revenue is None           # 'None' sentinel
    assert rows["2021-12-31"].currency == "USD"               # missing currency
    assert rows["2021-12-31"].stockholders_equity is None     # missing field
    assert rows["20x8-12-31"].fiscal_year is None             # malformed date
    assert rows["2017-12-31"].total_revenue == 9_000_000_000_000
    assert rows["2017-12-31"].gross_profit == 4_000_000_000_000
    assert rows["2023-12-31"].gross_profit is None and rows["2023-12-31"].rd_expense is None
    assert dict(stg.dtypes)["fiscal_year"] == "int"
    assert dict(stg.dtypes)["net_income"] == "bigint"


def test_union_of_kinds(spark, api_dir):
    frames = {}
    for kind, fields in S.REPORT_FIELDS.items():
        docs = sources.read_statements(spark, api_dir, kind)
        frames[kind] = nested.explode_statements(docs, fields)
    u = nested.union_statements(frames)
    assert u.count() == 11
    assert {"totalAssets", "operatingCashflow", "totalRevenue", "kind"} <= set(u.columns)
    bs = u.filter("kind = 'balance_sheet'").collect()[0]
    assert bs.totalAssets == "5000" and bs.totalRevenue is None


def test_missing_folder_is_optional(spark, tmp_path):
    df, ok = sources.optional(spark, lambda: sources.read_statements(spark, str(tmp_path / "nope")),
                              S.STATEMENT_DOC)
    assert ok is False and df.count() == 0


def test_one_scan_over_all_kinds(spark, api_dir):
    docs = sources.read_all_statements(spark, api_dir)
    assert sorted(r.kind for r in docs.select("kind").distinct().collect()) == [
        "balance_sheet", "cash_flow", "income_statement"]
    rows = docs.select("kind", F.col("doc.symbol").alias("symbol"),
                       F.explode("doc.annualReports").alias("r"))
    def key(t):
        return tuple("" if v is None else str(v) for v in t)

    one_scan = sorted(((r.kind, r.symbol, r.r.get("fiscalDateEnding"), r.r.get("totalAssets"), r.r.get("totalRevenue"))
                       for r in rows.collect()), key=key)
    frames = {k: nested.explode_statements(sources.read_statements(spark, api_dir, k), f)
              for k, f in S.REPORT_FIELDS.items()}
    per_kind = sorted(((r.kind, r.ticker, r.fiscalDateEnding, r.totalAssets, r.totalRevenue)
                       for r in nested.union_statements(frames).collect()), key=key)
    assert one_scan == per_kind
