"""Company path: S1, P1-P4, F1-F3, X1-X5, X11, A1, A5-A8, Q3 on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from fixtures import write_company_csv
from ledgerlake.operators import clean, metrics, quality, reports, staging
from ledgerlake.sources import files as sources


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = write_company_csv(str(tmp_path_factory.mktemp("company")))
    return sources.read_company_csv(spark, path)


def test_read_keeps_quoted_comma_and_text(raw):
    names = [r.Name for r in raw.collect() if r.Symbol == "AAA"]
    assert names == ["Alpha, Inc.", "Alpha Duplicate"]
    assert raw.schema["Price"].dataType.simpleString() == "string"
    assert len(raw.columns) == 14


def test_clean_rules(raw):
    out = clean.company_clean(raw)
    tickers = sorted(r.ticker for r in out.collect())
    # CCC: no EBITDA; DDD: malformed price; EEE: NaN cap; FFF/GGG: cap <= 0; '' symbol
    assert tickers == ["AAA", "AAA", "BBB", "HHH", "III", "JJJ", "KKK"]
    assert dict(out.dtypes)["market_cap"] == "double"


def test_metrics_edge_values(raw):
    typed = clean.typed_company(raw)
    m = {r.ticker + ("2" if r.company_name == "Alpha Duplicate" else ""): r
         for r in metrics.company_metrics(typed).collect() if r.ticker}
    assert m["AAA"].ebitda_to_market_cap == 2.0
    assert m["AAA"].price_range_pct == 50.0
    assert m["AAA"].price_position_in_range == 50.0
    assert m["AAA"].company_size == "Mega Cap"
    assert m["AAA"].value_score == 24.7
    assert m["CCC"].price_position_in_range is None          # high = low
    assert m["CCC"].company_size == "Mid Cap"                # exactly 2e9
    assert m["HHH"].price_range_pct is None                  # low = 0
    assert m["KKK"].ebitda_to_market_cap == 0.13             # 0.125 -> half up
    assert m["KKK"].company_size == "Mid Cap"
    assert m["III"].company_size == "Mega Cap"               # exactly 200e9
    assert m["HHH"].company_size == "Large Cap"              # exactly 10e9
    assert m["BBB"].value_score is None                      # P/E missing


def test_sector_summary(raw):
    s = reports.sector_summary(metrics.company_metrics(clean.company_clean(raw))).collect()
    assert [r.sector for r in s] == ["Tech", "Health", "Utilities"]
    tech = s[0]
    assert tech.company_count == 5
    assert tech.avg_price == 54.2
    assert tech.avg_pe_ratio == 12.88                         # (20.5+5+5+21)/4 = 12.875


def test_stg_financials(raw):
    stg = staging.stg_financials(clean.raw_financials(raw))
    rows = {(r.ticker, r.company_name): r.has_complete_data for r in stg.collect()}
    assert len(rows) == 11                                    # no '' symbol, no empty name
    assert rows[("AAA", "Alpha, Inc.")] is True
    assert rows[("BBB", "Beta Corp")] is False                # NULL P/E
    assert rows[("EEE", "Epsilon")] is False                  # NaN cap
    assert rows[("HHH", "Eta Inc")] is False                  # negative P/E
    assert rows[("DDD", "Delta Co")] is True                  # bad price is not in the flag
    assert "pe_ratio" in stg.columns and "price_per_earnings" not in stg.columns


def test_raw_financials_normalised_names(raw):
    cols = clean.raw_financials(raw).columns
    assert cols[:4] == ["symbol", "name", "sector", "price"]
    assert "price_per_earnings" in cols and "52_week_low" in cols


def test_charts(raw):
    stg = staging.stg_financials(clean.raw_financials(raw))
    dist = {r.sector: (r.company_count, r.share_pct)
            for r in reports.sector_distribution(stg).collect()}
    assert sum(c for c, _ in dist.values()) == 11
    assert dist["Energy"] == (3, 27.27)
    cap = {r.sector: r.avg_market_cap for r in reports.avg_market_cap_by_sector(stg).collect()}
    assert cap["Utilities"] == 8e9
    pe = {r.sector: r.avg_pe_ratio for r in reports.avg_pe_by_sector(stg).collect()}
    assert pe["Tech"] == 15.5                                 # (20.5+5+21)/3, NULL skipped
    assert reports.ebitda_vs_market_cap(stg).columns == ["ticker", "sector", "ebitda", "market_cap"]


def test_clean_counts_single_pass(raw):
    r = quality.clean_counts(clean.typed_company(raw)).collect()[0]
    assert r.rows_in == 13
    assert r.null_ticker == 1 and r.null_ebitda == 1 and r.null_stock_price == 1
    assert r.null_market_cap == 1
    assert r.rows_non_positive_cap == 2
    assert r.rows_out == 7
    assert r.rows_incomplete + r.rows_non_positive_cap + r.rows_out == r.rows_in


def test_required_columns_parameter(raw):
    typed = clean.typed_company(raw)
    three = clean.drop_incomplete(typed, ["ticker", "market_cap", "ebitda"])
    assert three.filter(F.col("ticker") == "DDD").count() == 1  # bad price kept


def test_reordered_header_is_rejected(spark, tmp_path):
    from fixtures import COMPANY_HEADER, COMPANY_ROWS
    cols = COMPANY_HEADER.split(",")
    swapped = ",".join([cols[1], cols[0]] + cols[2:])
    path = tmp_path / "swapped.csv"
    path.write_text(swapped + "\n" + COMPANY_ROWS[1] + "\n")
    with pytest.raises(Exception):
        sources.read_company_csv(spark, str(path)).collect()


def test_parse_rejects_counts_malformed_only(raw):
    r = quality.parse_rejects(raw).collect()[0]
    assert r.rows_in == 13
    assert r.rejected_stock_price == 1                        # 'abc'
    assert r.rejected_market_cap == 1                         # 'NaN'
    assert r.rejected_ebitda == 0 and r.rejected_pe_ratio == 0  # empty fields are not rejects
    assert r.rows_with_rejects == 2


def test_header_with_byte_order_mark(spark, tmp_path):
    from fixtures import COMPANY_HEADER, COMPANY_ROWS
    path = tmp_path / "bom.csv"
    path.write_text(COMPANY_HEADER + "\n" + "\n".join(COMPANY_ROWS) + "\n", encoding="utf-8-sig")
    rows = sources.read_company_csv(spark, str(path)).collect()
    assert len(rows) == 13 and rows[0].Symbol == "AAA"
