"""Staging relations: one source each, clean + rename (+ the facts pivot A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake.functions import complete_flag, safe_bigint, year_of


def stg_financials(raw_fin: DataFrame) -> DataFrame:
    """P4, F3, X11 over the loaded company table (normalised headers, typed)."""
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in S.NORMALISED_TO_CANONICAL.items()]
    flag = complete_flag("market_cap", "ebitda", "price_per_earnings").alias("has_complete_data")
    return (raw_fin
            .filter(F.col("symbol").isNotNull() & F.col("name").isNotNull())
            .select(*cols, flag))


def _optional_amount(df: DataFrame, field: str):
    """A source field that may be absent from the documents -> bigint or NULL."""
    if field in df.columns:
        return safe_bigint(field)
    return F.lit(None).cast("bigint")


def _optional_text(df: DataFrame, field: str):
    return F.col(field) if field in df.columns else F.lit(None).cast("string")


def stg_income_statements(raw_income: DataFrame) -> DataFrame:
    """P5, P6, F4, X12-X14 over flattened statement rows.

    Only `ticker` and `fiscalDateEnding` must exist (F4 filters on them); any other
    report field may be absent from the documents and is then NULL (P11)."""
    return (raw_income
            .filter(F.col("ticker").isNotNull() & F.col("fiscalDateEnding").isNotNull())
            .select(
                F.col("ticker"),
                F.col("fiscalDateEnding").alias("fiscal_date"),
                year_of("fiscalDateEnding").alias("fiscal_year"),
                _optional_amount(raw_income, "totalRevenue").alias("total_revenue"),
                _optional_amount(raw_income, "netIncome").alias("net_income"),
                _optional_amount(raw_income, "operatingIncome").alias("operating_income"),
                _optional_amount(raw_income, "stockholdersEquity").alias("stockholders_equity"),
                _optional_amount(raw_income, "grossProfit").alias("gross_profit"),
                _optional_amount(raw_income, "ebitda").alias("ebitda"),
                _optional_amount(raw_income, "researchAndDevelopment").alias("rd_expense"),
                F.coalesce(_optional_text(raw_income, "reportedCurrency"),
                           F.lit(S.DEFAULT_CURRENCY)).alias("currency"),
            ))


def pivot_metrics(cleaned: DataFrame, keys: list[str]) -> DataFrame:
    """A2: long facts -> one column per metric, MAX per key (largest value wins).

    Written as MAX(CASE ...) so the plan is a single partial/final hash aggregate:
    a hot key collapses map-side before the shuffle.
    """
    aggs = [F.max(F.when(F.col("metric_name") == m, F.col("value"))).alias(c)
            for m, c in S.METRIC_COLUMNS.items()]
    return cleaned.groupBy(*keys).agg(*aggs)


def stg_sec_facts(raw_facts: DataFrame, ordered: bool = False) -> DataFrame:
    """F5, X13, A2 over long facts; grouped by (ticker, company_name, fiscal_year).

    O3: the source orders this view by ticker and latest year; a sort inside a view
    does not reach its consumers, so it is off unless asked for."""
    cleaned = (raw_facts
               .filter(F.col("value").isNotNull() & F.col("ticker").isNotNull())
               .select("ticker", "company_name", "metric_name",
                       year_of("period_end").alias("fiscal_year"), "value"))
    out = pivot_metrics(cleaned, ["ticker", "company_name", "fiscal_year"])
    if ordered:
        out = out.orderBy(F.col("ticker").asc_nulls_last(), F.col("fiscal_year").desc_nulls_first())
    return out
