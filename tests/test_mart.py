"""Mart: J1, J2, P9, P10, X6-X10, X15, X16, F8, O2."""

from ledgerlake.operators import mart

INCOME = ("ticker string, fiscal_year int, total_revenue bigint, net_income bigint, "
          "operating_income bigint, stockholders_equity bigint, gross_profit bigint, "
          "ebitda bigint, rd_expense bigint")
SEC = ("ticker string, company_name string, fiscal_year int, net_income bigint, revenue bigint, "
       "total_assets bigint, total_liabilities bigint, stockholders_equity bigint, "
       "operating_income bigint")
COMP = ("ticker string, company_name string, sector string, stock_price double, market_cap double, "
        "pe_ratio double, ps_ratio double, pb_ratio double, eps double, week_52_low double, "
        "week_52_high double")


def frames(spark):
    income = spark.createDataFrame([
        ("A", 2023, 1000, 125, 1, 9, 400, None, None),
        ("A", 2022, 800, -100, 1, 9, None, None, None),
        ("A", 2021, 0, 5, 1, 9, None, None, None),          # F8: zero revenue
        ("A", 2020, None, 5, 1, 9, None, None, None),       # F8: NULL revenue
        ("B", 2023, 300, 1, 1, 9, None, None, None),        # no facts, no company
        (None, None, 50, 1, 1, 9, None, None, None),        # NULL keys
    ], INCOME)
    sec = spark.createDataFrame([
        ("A", "Alpha", 2023, 0, 0, 8000, 6000, 0, 0),       # zero equity -> NULL ROE
        ("A", "Alpha", 2022, 0, 0, 0, 10, 300, 0),          # zero assets -> NULL ROA/debt
    ], SEC)
    comp = spark.createDataFrame([
        ("A", "Alpha", "Tech", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0),
        ("A", "Alpha Dup", "Tech", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0),
    ], COMP)
    return income, sec, comp


def test_combined_keeps_left_rows(spark):
    income, sec, _ = frames(spark)
    c = mart.combine(income, sec)
    assert c.count() == 6
    assert c.columns == mart.COMBINED_COLUMNS


def test_ratios(spark):
    income, sec, _ = frames(spark)
    r = {(x.ticker, x.fiscal_year): x for x in mart.ratios(mart.combine(income, sec)).collect()}
    assert set(r) == {("A", 2023), ("A", 2022), ("B", 2023), (None, None)}
    a23 = r[("A", 2023)]
    assert a23.gross_margin_pct == 40.0
    assert a23.net_profit_margin_pct == 12.5
    assert a23.return_on_assets_pct == 1.56                  # 125/8000 = 1.5625 -> 1.56
    assert a23.return_on_equity_pct is None                  # equity 0
    assert a23.debt_ratio_pct == 75.0
    a22 = r[("A", 2022)]
    assert a22.net_profit_margin_pct == -12.5
    assert a22.return_on_assets_pct is None and a22.debt_ratio_pct is None
    assert a22.return_on_equity_pct == -33.33
    assert r[("B", 2023)].total_assets is None


def test_mart_fan_out_and_order(spark):
    income, sec, comp = frames(spark)
    rows = mart.mart(income, sec, comp).collect()
    assert len(rows) == 6                                    # A 2023/2022 doubled by duplicate
    assert [(r.ticker, r.fiscal_year) for r in rows][:5] == [
        ("A", 2023), ("A", 2023), ("A", 2022), ("A", 2022), ("B", 2023)]
    assert rows[-1].ticker is None                           # NULLs last on ticker
    assert len(rows[0].asDict()) == 24
    assert rows[4].company_name is None                      # no company row for B


def test_m12_two_name_spellings_fan_out(spark):
    from ledgerlake.operators import staging
    facts = spark.createDataFrame([
        ("A", "Alpha Inc", "Assets", "2023-12-31", 10, "10-K", "USD"),
        ("A", "ALPHA INC.", "Assets", "2023-06-30", 20, "10-K", "USD"),
        ("A", "Alpha Inc", "NetIncomeLoss", "2023-12-31", 1, "10-K", "USD"),
    ], "ticker string, company_name string, metric_name string, period_end string, "
       "value bigint, form string, currency string")
    sec = staging.stg_sec_facts(facts)
    assert sec.count() == 2                                  # one row per spelling
    income, _, comp = frames(spark)
    combined = mart.combine(income.filter("ticker = 'A' AND fiscal_year = 2023"), sec)
    assert sorted(r.total_assets for r in combined.collect()) == [10, 20]


def test_m17_size_class_of_null_cap(spark):
    from pyspark.sql import functions as F

    from ledgerlake.functions import size_class
    df = spark.createDataFrame([(None,)], "m double")
    assert df.select(size_class(F.col("m")).alias("s")).collect()[0].s == "Small Cap"
