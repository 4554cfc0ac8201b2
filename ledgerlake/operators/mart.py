"""The wide mart: statements x facts (J1), ratios (X6-X10, F8), x companies.

Both joins are LEFT equi-joins on column names with no hint. The planner broadcasts a side
whose estimated size is below `spark.sql.autoBroadcastJoinThreshold` (an estimate from file
sizes, which compressed files can undercut); AQE replans with measured sizes, and splits a
skewed (hot-ticker) partition of a sort-merge join. Deployments that cannot trust the
estimate set that threshold to -1 and keep the adaptive one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import pct

COMBINED_COLUMNS = [
    "ticker", "fiscal_year", "total_revenue", "gross_profit", "api_net_income", "api_ebitda",
    "api_operating_income", "rd_expense", "sec_net_income", "total_assets",
    "total_liabilities", "stockholders_equity", "sec_revenue",
]

RATIO_COLUMNS = [
    "gross_margin_pct", "net_profit_margin_pct", "return_on_assets_pct",
    "return_on_equity_pct", "debt_ratio_pct",
]

MART_COLUMNS = [
    "ticker", "company_name", "sector", "fiscal_year", "stock_price", "market_cap",
    "pe_ratio", "ps_ratio", "pb_ratio", "eps", "week_52_low", "week_52_high",
    "total_revenue", "gross_profit", "net_income", "ebitda", "total_assets",
    "total_liabilities", "stockholders_equity", *RATIO_COLUMNS,
]


def mart_order() -> list[Column]:
    """O2. A tie (a company listed twice) is broken by name, so that exports agree."""
    return [F.col("ticker").asc_nulls_last(), F.col("fiscal_year").desc_nulls_first(),
            F.col("company_name").asc_nulls_last()]


def combine(income: DataFrame, sec: DataFrame) -> DataFrame:
    """J1 + P9: statements LEFT JOIN pivoted facts on (ticker, fiscal_year)."""
    reported = income.withColumnsRenamed(
        {"net_income": "api_net_income", "ebitda": "api_ebitda", "operating_income": "api_operating_income"})
    filed = sec.withColumnsRenamed({"net_income": "sec_net_income", "revenue": "sec_revenue"})
    filed = filed.select("ticker", "fiscal_year", *[c for c in COMBINED_COLUMNS if c in filed.columns
                                                    and c not in ("ticker", "fiscal_year")])
    own = [c for c in COMBINED_COLUMNS if c not in filed.columns or c in ("ticker", "fiscal_year")]
    # The statements' own equity is not part of the mart: the filed one is.
    return reported.select(*own).join(filed, ["ticker", "fiscal_year"], "left").select(*COMBINED_COLUMNS)


def ratios(combined: DataFrame) -> DataFrame:
    """F8 + X6-X10: positive-revenue rows with five percentage ratios (NULL on /0)."""
    return (combined
            .filter(F.col("total_revenue").isNotNull() & (F.col("total_revenue") > 0))
            .select(
                "ticker", "fiscal_year", "total_revenue", "gross_profit",
                F.col("api_net_income").alias("net_income"),
                F.col("api_ebitda").alias("ebitda"),
                "total_assets", "total_liabilities", "stockholders_equity",
                pct("gross_profit", "total_revenue").alias("gross_margin_pct"),
                pct("api_net_income", "total_revenue").alias("net_profit_margin_pct"),
                pct("api_net_income", "total_assets").alias("return_on_assets_pct"),
                pct("api_net_income", "stockholders_equity").alias("return_on_equity_pct"),
                pct("total_liabilities", "total_assets").alias("debt_ratio_pct"),
            ))


def mart_financials(ratio_rows: DataFrame, companies: DataFrame, ordered: bool = True) -> DataFrame:
    """J2 + P10 (+ O2): ratios LEFT JOIN company staging on ticker, 24 columns.

    The company side is not de-duplicated: a ticker listed twice yields two rows.
    `ordered` gives `ticker ASC NULLS LAST, fiscal_year DESC NULLS FIRST`.
    """
    wanted = ["ticker", *[c for c in MART_COLUMNS if c not in ratio_rows.columns]]
    out = ratio_rows.join(companies.select(*wanted), "ticker", "left").select(*MART_COLUMNS)
    if ordered:
        out = out.orderBy(*mart_order())
    return out


def mart(income: DataFrame, sec: DataFrame, companies: DataFrame, ordered: bool = True) -> DataFrame:
    """G5 in one logical plan: Catalyst prunes the columns later steps drop."""
    return mart_financials(ratios(combine(income, sec)), companies, ordered)
